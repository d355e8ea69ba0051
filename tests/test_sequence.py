"""Running frames: every row against DuckDB's window, hot keys, spread, edges."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import intermediate as I
from tidemark.operators.sequence import CHUNK, adjacent_flag_pairs, chunked, last_of, running_frame

SCHEMA = "key string, t timestamp, id string, f boolean, n long"


@pytest.fixture()
def many_chunks(spark):
    """Small tables are not put together into one range."""
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("false", "23")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def payments(n, seed=1, hot_day=True):
    """A third of all rows in one account: on one day, some at one instant or without a time."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        hot = rnd.random() < 0.4
        at = pd.Timestamp("2001-05-05") + pd.Timedelta(seconds=rnd.randrange(50 if hot and hot_day else 10**7))
        out.append(("hot" if hot else rnd.choice([None, *[f"k{k}" for k in range(60)]]),
                    None if rnd.random() < 0.1 else at.to_pydatetime(), f"p{rnd.random():.9f}", rnd.random() < 0.4,
                    rnd.choice([None, 1, 5, -2])))
    return out


def windowed(rows):
    frame = pd.DataFrame(rows, columns=["key", "t", "id", "f", "n"]).astype({"n": "Int64"})  # noqa: F841
    return duckdb.sql("""
        SELECT id, row_number() OVER w, sum(CASE WHEN f THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING),
               sum(coalesce(n, 0)) OVER (w ROWS UNBOUNDED PRECEDING), lag(f) OVER w, lag(n) OVER w
        FROM frame WINDOW w AS (PARTITION BY key ORDER BY t NULLS FIRST, id)""").fetchall()


def framed(df):
    return running_frame(df, "key", ("t", "id"), {"failures": F.col("f").cast("long"), "total": F.col("n")},
                         number="place", previous={"f_before": "f", "n_before": "n"})


def test_every_row_equals_the_window(spark, many_chunks):
    rows = payments(4000)
    df = framed(spark.createDataFrame(rows, SCHEMA))
    got = [(r["id"], r["place"], r["failures"], r["total"], r["f_before"], r["n_before"]) for r in df.collect()]
    assert sorted(got) == sorted(tuple(map(lambda v: int(v) if not isinstance(v, (str, bool)) and v is not None else v, r))
                                 for r in windowed(rows))
    assert df.columns == ["key", "t", "id", "f", "n", "failures", "total", "place", "f_before", "n_before"]


def test_a_hot_account_on_one_day_stays_spread(spark, many_chunks):
    rows = payments(6000)
    sizes = (chunked(spark.createDataFrame(rows, SCHEMA), "key", ("t", "id"))
             .groupBy("key", CHUNK).count().where("key = 'hot'").collect())
    n_hot = sum(r[0] == "hot" for r in rows)
    assert len(sizes) >= 8 and sum(r["count"] for r in sizes) == n_hot
    assert max(r["count"] for r in sizes) < n_hot / 4
    # chunks rise along the order
    spans = (chunked(spark.createDataFrame(rows, SCHEMA), "key", ("t", "id")).where("key = 'hot'")
             .groupBy(CHUNK).agg(F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi"))
             .orderBy(CHUNK).collect())
    ends = [(x is not None, x, i) for r in spans for x, i in (r["lo"], r["hi"])]
    assert [e[0] for e in ends] == sorted(e[0] for e in ends)                       # without a time first
    assert [e[1:] for e in ends if e[0]] == sorted(e[1:] for e in ends if e[0])


def test_pairs_with_own_ranges(spark, many_chunks):
    rows = payments(3000, seed=5)
    got = {r["key"]: r["pairs"] for r in
           adjacent_flag_pairs(spark.createDataFrame(rows, SCHEMA), "key", None, ["t", "id"], "f").collect()}
    want = {}
    for key in {r[0] for r in rows}:
        flags = [r[3] for r in sorted((r for r in rows if r[0] == key),
                                      key=lambda r: (r[1] is not None, r[1] or pd.Timestamp(0), r[2]))]
        want[key] = sum(a and b for a, b in zip(flags, flags[1:]))
    assert got == want


def test_rollup_of_a_hot_account(spark, many_chunks):
    """payment_rollup's order-dependent columns equal a plain walk, whatever the chunks."""
    rows = [(k, t, i, f, "reason " + i if f and n != 5 else None, n) for k, t, i, f, n in payments(3000, seed=8)]
    df = spark.createDataFrame(rows, "account_id string, created_at timestamp, payment_id string, is_failed boolean, "
                                     "failure_reason string, amount long")
    df = df.select("*", F.to_date("created_at").alias("payment_date"), (~F.col("is_failed")).alias("is_successful"),
                   F.lit(False).alias("is_repeat_failure")).withColumn("amount", F.col("amount").cast("decimal(20,9)"))
    got = {r["account_id"]: r for r in I.payment_rollup(df).collect()}
    assert None not in got and set(got) == {r[0] for r in rows} - {None}
    for key, r in got.items():
        mine = sorted((x for x in rows if x[0] == key), key=lambda x: (x[1] is not None, x[1] or pd.Timestamp(0), x[2]))
        failed = [x for x in mine if x[3]]
        assert (r["total_payments"], r["failed_payments"], r["total_cumulative_failures"]) == (
            len(mine), len(failed), len(failed))
        assert r["consecutive_failure_count"] == sum(a[3] and b[3] for a, b in zip(mine, mine[1:]))
        assert (r["last_failure"] and r["last_failure"]["failure_reason"]) == (failed[-1][4] if failed else None)
        assert r["total_payment_amount"] == sum(x[5] or 0 for x in mine if not x[3])


def test_empty_and_single_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert framed(empty).count() == 0
    assert adjacent_flag_pairs(empty, "key", None, ["t", "id"], "f").count() == 0
    one = framed(spark.createDataFrame([(None, None, "x", None, None)], SCHEMA)).first()
    assert (one["place"], one["failures"], one["total"], one["f_before"]) == (1, 0, 0, None)


def test_totals_of_a_key_are_made_once(spark):
    """No running frame: the values of a key come from one frame over all its rows."""
    df = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("b", 1, True)], "key string, t int, f boolean")
    out = last_of(df, ("key",), ("t",), {"n": F.count("t"), "last": F.last("f")}, carried=("f",))
    assert sorted(map(tuple, out.collect())) == [("a", False, 2, False), ("b", True, 1, True)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "unboundedfollowing$()" in plan and "currentrow$()" not in plan


def test_leads_move_while_they_are_narrow(spark):
    """The campaign, with the most columns, is joined after both moves of the leads."""
    from conftest import SF_SMALL
    from tidemark.plans.registry import warehouse

    plan = warehouse(spark, SF_SMALL).model("int_leads_with_campaigns")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]  # outermost first
    assert len(joins) == 3
    assert "_key" in joins[0] and "lead_id" in joins[1] and "_key" in joins[2]
