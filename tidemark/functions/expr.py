"""Column expressions shared by the models.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType

# NUMERIC money. decimal(20,9) rather than (38,9): sums, rounding and
# ratios keep 9 fractional digits without hitting the 38-digit ceiling
# that makes Spark drop scale to 6.
MONEY = DecimalType(20, 9)

# Wide enough for sums of sums of money: 21 integer digits.
WIDE_MONEY = DecimalType(30, 9)

# Characters the warehouse TRIM removes (all Unicode white
# space): ASCII, next line, no-break space and the separators.
WHITESPACE = (" \t\n\r\f\v\u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
              + "\u2028\u2029\u202f\u205f\u3000")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: str | Column) -> Column:
    """lower(trim(c)) with whitespace-trim semantics."""
    return F.lower(F.btrim(col(c), F.lit(WHITESPACE)))


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false: a NULL condition is false."""
    return F.coalesce(cond, F.lit(False))


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def dec(value: str | int) -> Column:
    """Exact decimal literal (a Python float would turn money into double)."""
    return F.lit(Decimal(str(value)))


def least_strict(x: Column, cap: Column | int | str) -> Column:
    """least(x, cap) that is NULL when x is NULL.

    Spark's ``least`` skips NULL arguments; the warehouse returns NULL.
    """
    cap_col = cap if isinstance(cap, Column) else dec(cap)
    return F.when(x.isNotNull(), F.least(x, cap_col))


def as_of_date(as_of: dt.date | None) -> Column:
    """The run's 'current date' (pinned in tests, today otherwise)."""
    return F.current_date() if as_of is None else F.lit(as_of)


def run_timestamp(run_ts: dt.datetime | None) -> Column:
    """The build's instant. A value without a zone is UTC, whatever the
    driver's own zone (a bare literal would be read in that one)."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=dt.timezone.utc)).cast("timestamp")


def whole(df: DataFrame, name: str) -> Column:
    """The column as a whole number; a fractional one is rounded, half away
    from zero (a plain cast would cut it off). Whole ones are left as they are
    by ``round``, which the stored views write for any type: one expression in
    both lets Spark see equal plans."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, NumericType):
        c = F.round(c)
    return c.cast("long")


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Whole elapsed units between two instants, NULL if either is NULL."""
    return F.when(end.isNotNull() & start.isNotNull(),
                  F.timestamp_diff(unit, start, end))


def round2(c: Column) -> Column:
    return F.round(c, 2)


def exact_ratio(num: Column, den: Column, times: int = 1) -> Column:
    """round(num / den * times, 2) of money, rounded once, for den > 0.

    A decimal quotient keeps few digits of wide operands, and rounding it
    again is a double rounding. So the nearest number of hundredths is
    counted instead: (200 * times * num + den) divided by (2 * den) with
    the remainder taken off first, which is exact for 21 integer digits.
    """
    n, d = F.abs(num.cast(WIDE_MONEY)), den.cast(WIDE_MONEY)
    twice, over = n * dec(200 * times) + d, d * dec(2)
    hundredths = ((twice - twice % over) / over).cast("decimal(30,0)")
    return (F.when(num < 0, -hundredths).otherwise(hundredths) / dec(100)).cast("decimal(32,2)")


def money_pct(num: Column, den: Column) -> Column:
    """round(num / den * 100, 2) for money."""
    return exact_ratio(num, den, 100)


def count_when(cond: Column) -> Column:
    """countif: counts rows where cond is true (NULL is not counted)."""
    return F.count_if(cond)
