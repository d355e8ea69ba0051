"""Mixing: SQL parity, targets against step-by-step resharing, edge cases."""

import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from tidemark.llm import mixing

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_matches_sql(spark):
    result = compare(mixing.op10_mixing(spark, SF), mixing.OP10_SQL, duck(SF))
    assert result["match"], result


def reshared(sizes, weights, share=1.5, repeats=2):
    """Give by weight, cap, and share the excess again until none is above."""
    budget = share * sum(sizes)
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while True:
        left = budget - sum(repeats * sizes[i] for i in range(len(sizes)) if i not in open_)
        total = sum(weights[i] for i in open_)
        for i in open_:
            target[i] = left * weights[i] / total
        above = {i for i in open_ if target[i] > repeats * sizes[i]}
        if not above:
            return target
        for i in above:
            target[i] = repeats * sizes[i]
        open_ -= above
        if not open_:
            return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 50, 7, 7, 3], [0, 5, 0, 9], [100]])
def test_targets_are_the_resharing_fixed_point(spark, sizes):
    rows = [(f"s{i:02d}", n) for i, n in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).orderBy("source").collect()
    want = reshared(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert [r["target"] for r in got] == pytest.approx(want)


def test_edge_rows(spark):
    rows = [(1, "a b c", "en", None, 5), (2, None, None, "x", None), (3, "", "en", "x", 0),
            (4, "w " * 50, "en", "x", 100), (4, "w " * 50, "en", "x", 100), (None, "q r", "en", "y", 3),
            (5, "t", "en", "y", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("rank", F.lit(7))
    plan = mixing.schedule(docs)
    assert plan.count() == len(rows)
    got = {(r["doc_id"], r["source"]): r for r in plan.collect()}
    assert got[(2, "x")]["size"] == 0 and got[(1, None)]["rank"] == 3
    assert all(0 <= r["copies"] <= 2 for r in got.values())
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert out.count() == plan.agg(F.sum("copies")).head()[0]
    assert mixing.schedule(docs.limit(0)).count() == 0


def test_close_to_target_and_repeatable(spark):
    rows = [(i, "w " * (1 + i * 7 % 13), "en", "hot" if i % 3 else f"s{i % 5}", 0) for i in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    first = {r["doc_id"]: r["copies"] for r in mixing.schedule(docs).collect()}
    again = {r["doc_id"]: r["copies"] for r in mixing.schedule(docs.repartition(7)).collect()}
    assert first == again
    for r in (mixing.schedule(docs).groupBy("source", "target")
              .agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()):
        assert abs(r["taken"] - r["target"]) <= 13


def test_repeated_rows_are_cut_between(spark):
    """A row repeated 1,800 times is spread over its source: every source ends within one row of its target."""
    rows = [(k, "word " * 20, "en", f"s{k % 3}", k) for k in range(9000)]
    rows += [(2, "word " * 20, "en", "s2", -k) for k in range(1800)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.schedule(docs).cache()
    for r in (plan.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()):
        assert abs(r["taken"] - r["target"]) <= 20, r
    hot = plan.where("doc_id = 2").groupBy("copies").count().collect()
    assert sum(r["count"] for r in hot) == 1801 and len(hot) == 2      # some once more than others
    out = mixing.mix(docs.repartition(5))
    assert out.count() == plan.agg(F.sum("copies")).head()[0]
    taken = {r["n_chars"]: r["count"] for r in out.where("doc_id = 2").groupBy("n_chars").count().collect()}
    want = sorted(r["copies"] for r in plan.where("doc_id = 2").select("copies").collect() if r["copies"])
    assert sorted(taken.values()) == want       # each of the like rows as often as its number says
    plan.unpersist()


def test_repeats_match_sql(spark, tmp_path):
    import duckdb

    rows = [(k // 3 if k % 5 else None, "w " * (1 + k % 4) if k % 7 else None, "en", f"s{k % 4}" if k % 11 else None, 0)
            for k in range(600)]
    spark.createDataFrame(rows * 3, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in mixing.op10_mixing(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(mixing.OP10_SQL).fetchall()
    names = [d[0] for d in con.description]
    order = [names.index(n) for n in ("doc_id", "size", "source_size", "target", "taken")]
    assert got == sorted((tuple(r[i] for i in order) for r in want), key=str)


def test_any_column_names(spark):
    rows = [(k, "w " * 5, "s", 1, 2, 3) for k in range(30)] * 2
    docs = spark.createDataFrame(rows, "`doc.id` long, __id string, row string, key long, copies long, `a.b` long")
    out = mixing.mix(docs, id_col="doc.id", text_col="__id", source_col="row")
    assert out.columns == docs.columns and out.count() == 90
