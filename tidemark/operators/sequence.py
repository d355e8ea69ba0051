"""Running frames over the rows of a key, balanced however large a key is.

A window over a key puts all its rows into one task. Here the rows are cut into
chunks first: ranges of (key, order) with sampled cut points, so all chunks have
about the same number of rows, and a key with a third of the table, be it on one
day or at one instant, is spread over a third of the chunks. Then a prefix sum in
two levels: running values inside each (key, chunk); the chunks' totals, one row
each, summed in order; and, where every row is asked for, the totals before its
chunk added to it. Rows move twice: into their ranges, then by (key, chunk).

``order`` must be total within a key up to rows that are equal in all columns
read (which of those comes first is open). NULLs come first, in a key's order as
among keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written

#: Number of a row's chunk; rises along (key, order).
CHUNK = "_chunk"


def chunked(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` cut into ranges of (key, order), with the range's number in ``CHUNK``."""
    return df.repartitionByRange(key, *order).withColumn(CHUNK, F.spark_partition_id())


def last_of(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            totals: Mapping[str, Column], carried: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the aggregates ``totals`` over all its rows in
    ``order`` and the columns ``carried`` of its last row.

    Written as window values of which the last row is kept, so values of any
    type (a text, a struct) cost no sort-based aggregation beside the sort that
    the order needs anyway. The frame is the whole key: its values are made once
    a key, not once a row.
    """
    inside = Window.partitionBy(*keys).orderBy(*order)
    all_rows = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (df.select(*keys, *carried, F.lead(F.lit(1)).over(inside).isNull().alias("_end"),
                      *[c.over(all_rows).alias(n) for n, c in totals.items()])
            .where("_end").drop("_end"))


def with_previous(df: DataFrame, key: str, order: Sequence[str], flag: str, out: str) -> DataFrame:
    """``df`` (chunked) with the flag of the row before, within the chunk."""
    return df.withColumn(out, F.lag(flag).over(Window.partitionBy(key, CHUNK).orderBy(*order)))


def running_frame(df: DataFrame, key: str, order: Sequence[str], sums: Mapping[str, Column],
                  number: str | None = None, previous: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with running columns over all rows of a key up to and including each row.

    ``sums``: name -> number to be summed (NULL counts as 0); ``number``: name of
    the row's place from 1; ``previous``: name -> column whose value in the row
    before is wanted (NULL at a key's first row). Rows are evaluated once, into
    the shared folder, and meet their chunk's offsets in a join of two written
    tables.
    """
    previous = dict(previous or {})
    counted = dict(sums) | ({number: F.lit(1)} if number else {})
    totals = {n: F.sum(F.coalesce(c, F.lit(0))) for n, c in counted.items()}
    inside = Window.partitionBy(key, CHUNK).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = written(chunked(df, key, order).withColumns(
        {n: c.over(so_far) for n, c in totals.items()}
        | {n: F.lag(c).over(inside) for n, c in previous.items()}
        | {"_starts": F.lag(F.lit(1)).over(inside).isNull(), "_ends": F.lead(F.lit(1)).over(inside).isNull()}),
        "running")
    chunks = Window.partitionBy(key).orderBy(CHUNK)
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.where("_ends").select(
        F.col(key).alias("_of"), F.col(CHUNK).alias("_at"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in totals],
        *[F.lag(c).over(chunks).alias(f"_before_{n}") for n, c in previous.items()]))
    met = rows.join(offsets, rows[key].eqNullSafe(offsets["_of"]) & (rows[CHUNK] == offsets["_at"]))
    return met.select(
        *df.columns, *[(F.col(n) + F.col(f"_before_{n}")).alias(n) for n in totals],
        *[F.when(F.col("_starts"), F.col(f"_before_{n}")).otherwise(F.col(n)).alias(n) for n in previous])


def adjacent_flag_pairs(df: DataFrame, key: str, chunk: str | None, order: Sequence[str], flag: str,
                        out: str = "pairs") -> DataFrame:
    """Per ``key``: number of rows whose flag and predecessor's flag are true.

    ``chunk``: a column that never falls along ``order`` and keeps the rows of a
    key apart well enough; None cuts equal ranges.
    """
    rows = df.select(key, *([chunk] if chunk else []), *order, flag)
    rows = rows.withColumn(CHUNK, F.col(chunk)) if chunk else chunked(rows, key, order)
    return pairs_of(last_of(with_previous(rows, key, order, flag, "_previous"), (key, CHUNK), order,
                            pair_columns(flag, "_previous"), carried=(flag,)), key, flag, out)


def pair_columns(flag: str, previous: str) -> dict[str, Column]:
    """Totals per chunk: pairs inside it and its first flag."""
    return {"_inner": F.count_if(F.col(flag) & F.col(previous)), "_first": F.first(flag)}


def across_chunks(per_chunk: DataFrame, key: str, flag: str) -> DataFrame:
    """One row per chunk, with ``flag`` of its last row -> ``_pairs``: its pairs,
    with the one it may make with the chunk before."""
    before = F.lag(flag).over(Window.partitionBy(key).orderBy(CHUNK))
    return per_chunk.withColumn("_pairs", F.col("_inner")
                                + F.coalesce((F.col("_first") & before).cast("long"), F.lit(0)))


def pairs_of(per_chunk: DataFrame, key: str, flag: str, out: str) -> DataFrame:
    return across_chunks(per_chunk, key, flag).groupBy(key).agg(F.sum("_pairs").alias(out))
