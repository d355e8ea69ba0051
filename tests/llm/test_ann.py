"""Nearest neighbours: recall and exact scores against brute force, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann

SF = "/root/testdata/sf0.1"


def brute(ids, x, query):
    q = x[query]
    score = (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[query]][:ann.NEAREST]
    return [(int(ids[i]), float(score[i])) for i in order]


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    got = collected(ann.op3_ann(spark, SF))
    queries = np.flatnonzero(ids % 50 == 0)
    assert set(got) == set(ids[queries].tolist())
    hits = total = 0
    for q in queries:
        want = brute(ids, x, q)
        mine = got[int(ids[q])]
        assert [r for r, _, _ in mine] == list(range(1, ann.NEAREST + 1))
        for _, v, s in mine:
            i = np.flatnonzero(ids == v)[0]
            assert s == pytest.approx(x[i] @ x[q] / np.linalg.norm(x[i]) / np.linalg.norm(x[q]), abs=1e-12)
        hits += len({v for _, v, _ in mine} & {v for v, _ in want})
        total += len(want)
    assert hits / total >= 0.9


def test_probes_come_in_order_of_success():
    rnd = np.random.default_rng(0)
    units = ann._units(rnd.normal(size=(300, 32)))
    near = ann._units(units + rnd.normal(size=units.shape) * 0.12)
    buckets = ann.probed_buckets(units, 0, 60)
    a, b = ann._projections(32, 0)
    assert (buckets[:, 0] == ann._bucket(np.floor((units @ a + b) / ann.WIDTH))).mean() > 0.6
    home = ann._bucket(np.floor((near @ a + b) / ann.WIDTH))
    place = [np.flatnonzero(buckets[i] == home[i]) for i in range(300)]
    place = np.array([p[0] if len(p) else 60 for p in place])
    assert (place < 10).mean() > ((place >= 10) & (place < 20)).mean()
    assert (place < 60).mean() > 0.95


@pytest.mark.parametrize("group", [20_000, 10])
def test_copies_ties_and_bad_rows(spark, monkeypatch, group):
    monkeypatch.setattr(ann, "GROUP_VECTORS", group)
    monkeypatch.setattr(ann, "HELD_ROWS", 40)
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(30, 6)).astype(np.float32).astype(float)
    rows = [(i, base[i % 30].tolist()) for i in range(60)]               # copies
    rows += [(100 + i, base[0].tolist()) for i in range(90)]             # many copies
    rows += [(100, base[0].tolist()), (300, None), (350, []), (400, [0.0] * 6), (450, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (500, [float("nan")] * 6), (550, [float("inf")] + [1.0] * 5), (None, base[1].tolist()),
             (600, [1.0, 2.0]), (601, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("bucket", F.lit("clash"))
    got = collected(ann.search(df, F.col("id") % 50 == 0))
    assert set(got) == {0, 50, 100, 150, 600}
    assert [v for _, v, _ in got[600]] == [601]
    ids = np.array([i for i, v in dict(rows[:150]).items()])
    x = np.array([v for v in dict(rows[:150]).values()])
    for q in (0, 50, 100, 150):
        want = brute(ids, x, int(np.flatnonzero(ids == q)[0]))
        assert [v for _, v, _ in got[q]][:2] == [v for v, _ in want][:2]
        assert [s for _, _, s in got[q]] == sorted((s for _, _, s in got[q]), reverse=True)
    assert [v for _, v, _ in got[100]] == [0, 30, 101, 102, 103]
    assert ann.search(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_few_vectors_are_all_found(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, -0.1])]
    got = collected(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") == 0))
    assert [v for _, v, _ in got[0]] == [2, 3, 1]
