"""Quality: held-out accuracy, gradients, block-wise scoring, edge rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in quality.op5_quality(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(got[i]["predicted"], q) for i, q in labels.items() if got[i]["held_out"]]
    assert len(held) > 500
    for label in (0, 1):
        right = [p == q for p, q in held if q == label]
        assert np.mean(right) > 0.97


def plain_score(parameters, text):
    """The module's formula, passage by passage, with numbers of double precision."""
    p = {k: v.astype(np.float64) for k, v in parameters.items()}
    data = text.encode()
    x = quality.passage_inputs(data).astype(np.float64)
    h = [np.tanh(row @ p["W"] + p["b"]) for row in x]
    logit = [float(np.sum(p["w"] * np.tanh(v @ p["V"]) / (1 + np.exp(-(v @ p["U"]))))) for v in h]
    weight = [np.exp(e - max(logit)) for e in logit]
    z = sum(w * v for w, v in zip(weight, h)) / sum(weight)
    return float(1 / (1 + np.exp(-(z @ p["c"] + p["d"][0]))))


def test_query_by_the_formula(spark):
    """Every row of the query against the formula, the model learned as the query learns it."""
    small = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    model = quality.learned(spark, spark.read.parquet(f"{small}/documents.parquet"), small)
    got = quality.op5_quality(spark, small).collect()
    assert len(got) == len(docs) and model.parameters is not None
    for r in got:
        want = plain_score(model.parameters, docs[r["doc_id"]] or "")
        assert r["score"] == pytest.approx(want, abs=1e-3) and r["predicted"] == int(r["score"] >= 0.5)


def test_learns_from_every_passage(spark):
    """Long texts whose last passage alone tells the label."""
    plain = "some plain words that all of them share " * 2560   # 100 KB
    end = {1: "a quiet end of the words " * 40, 0: "$$$ *** ### 000 " * 60}
    rows = [(i, plain[:len(plain) if i < 4 else 3000] + end[i % 2]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    taken = quality.sampled_rows(docs, labels)
    (bags,) = [list(quality.bags_of([taken.where("id = 2").toPandas()]))]
    x = np.frombuffer(bags[0]["x"][0], dtype=np.float16).reshape(-1, quality.N_INPUTS)
    data = rows[2][1].encode()
    assert len(x) == -(-len(data) // quality.PASSAGE_BYTES) > 200
    assert np.allclose(x, quality.passage_inputs(data), atol=1e-3)
    model = quality.train(docs, labels)
    good, bad = (model.scores([t for i, t in rows if i % 2 == k and i >= 4]) for k in (1, 0))
    assert bad.max() < 0.5 < good.min()


def test_sample_is_bounded_and_whole(spark):
    rows = [(i, "words " * 100 * (i % 3 + 1)) for i in range(50)] + [(7, "words " * 200)] * 500 + [(None, "x")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, quality int")
    every = quality.sampled_rows(docs, labels).collect()
    assert sorted(r["id"] for r in every) == list(range(50))
    assert sorted(r["id"] for r in quality.sampled_rows(docs, labels, max_docs=20).collect()) == sorted(
        r["id"] for r in quality.sampled_rows(docs.repartition(5), labels.repartition(3), max_docs=20).collect())
    few = quality.sampled_rows(docs, labels, max_passages=30).collect()
    n = [-(-len(r["text"]) // quality.PASSAGE_BYTES) for r in few]
    assert 25 <= sum(n) <= 30 and all(r["text"] == dict(rows)[r["id"]] for r in few)


def test_gradients():
    rnd = np.random.default_rng(0)
    p = {"W": rnd.normal(size=(quality.N_INPUTS, 3)), "b": rnd.normal(size=3), "V": rnd.normal(size=(3, 2)),
         "U": rnd.normal(size=(3, 2)), "w": rnd.normal(size=2), "c": rnd.normal(size=3), "d": rnd.normal(size=1)}
    x, bag, label = rnd.random((7, quality.N_INPUTS)), np.array([0, 0, 1, 1, 1, 2, 2]), np.array([1.0, 0, 1])
    _, grads = quality._gradients(p, x, bag, 3, label)
    for name, g in grads.items():
        for at in [tuple(rnd.integers(0, n) for n in p[name].shape) for _ in range(4)]:
            kept = p[name][at]
            losses = []
            for e in (1e-6, -1e-6):
                p[name][at] = kept + e
                losses.append(quality._gradients(p, x, bag, 3, label)[0])
            p[name][at] = kept
            assert g[at] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-5)


def small_model():
    rnd = np.random.default_rng(1)
    texts = [("plain words in a row " * rnd.integers(1, 90), 1) for _ in range(60)]
    texts += [("$$$ *** ### " * rnd.integers(1, 90), 0) for _ in range(60)]
    return quality.fit([quality.passage_inputs(t.encode()) for t, _ in texts], np.array([y for _, y in texts]))


def test_blocks_do_not_matter(monkeypatch):
    model, text = small_model(), "plain words é " * 3000 + "$$$ " * 400
    whole = model.scores([text])
    monkeypatch.setattr(quality, "BLOCK_PASSAGES", 3)
    assert model.scores([text]) == pytest.approx(whole, abs=1e-4)  # float32 encoder
    bad, good = model.scores(["### $$$ " * 20, "some plain words " * 20])
    assert bad < 0.5 < good


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "ok words"), (3, "ok words"), (None, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    out = docs.withColumn("s", quality.score_column(spark, small_model(), F.col("text"))).collect()
    assert all(0 <= r["s"] <= 1 for r in out) and out[0]["s"] == out[1]["s"] and out[2]["s"] == out[3]["s"]
    labels = spark.createDataFrame([(3, 1), (3, None), (None, 0), (99, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert model.parameters is None and model.scores(["any", None]).tolist() == [1.0, 1.0]
    assert quality.train(docs.limit(0), labels.limit(0)).scores([""]).tolist() == [0.5]
