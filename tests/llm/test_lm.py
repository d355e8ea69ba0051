"""LM scoring: Elias-Fano look-ups, the formula by dictionaries, edge rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lm
from tidemark.llm.eliasfano import EliasFano

SF = "/root/testdata/sf0.001"


def plain_tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [""]


def plain_model(texts, word_share=lm.WORD_SHARE, share=lm.SHARE):
    docs = [plain_tokens(t) for t in texts]
    c1 = Counter(w for d in docs for w in d)
    c2 = Counter(p for d in docs for p in zip(d, d[1:]))
    c3 = Counter(p for d in docs for p in zip(d, d[1:], d[2:]))
    n, v = sum(c1.values()), len(c1)
    in_trie = {w for w, c in c1.items() if c >= max(lm.MIN_COUNT, word_share * n)}
    least = max(lm.MIN_COUNT, math.ceil(share * n))
    kept2 = {p: c for p, c in c2.items() if c >= least and set(p) <= in_trie}
    kept3 = {p: c for p, c in c3.items() if c >= least and p[:2] in kept2 and p[1:] in kept2}
    left1 = {w: 1 - sum(c - lm.DISCOUNT for p, c in kept2.items() if p[0] == w) / c1[w] for w in in_trie}
    left2 = {}
    for p, c in kept3.items():
        left2[p[:2]] = left2.get(p[:2], 1) - (c - lm.DISCOUNT) / kept2[p[:2]]

    def p1(w):
        return (c1[w] + 0.5) / (n + 0.5 * (v + 1))

    def p2(w, u):
        if u not in in_trie:
            return p1(w)
        return max(kept2.get((u, w), 0) - lm.DISCOUNT, 0) / c1[u] + left1[u] * p1(w)

    def p3(w, t, u):
        if (t, u) not in kept2:
            return p2(w, u)
        return max(kept3.get((t, u, w), 0) - lm.DISCOUNT, 0) / kept2[t, u] + left2.get((t, u), 1) * p2(w, u)

    def score(text):
        d = plain_tokens(text)
        total = 0.0
        for i, w in enumerate(d):
            total += math.log10(p1(w) if i == 0 else p2(w, d[0]) if i == 1 else p3(w, d[i - 2], d[i - 1]))
        return total

    return c1, n, v, score, p3


def test_elias_fano():
    rnd = np.random.default_rng(0)
    for trial in range(120):
        n = int(rnd.integers(0, 200))
        universe = int(rnd.integers(n + 1, 10 ** int(rnd.integers(3, 13))))
        values = np.unique(rnd.integers(0, universe, n))
        if trial % 4 == 0 and len(values):
            values = np.sort(np.r_[values, values[:5]])
        ef = EliasFano.build(values, universe)
        asked = np.r_[rnd.integers(0, universe, 50), values[:50]]
        assert ef.successor(asked).tolist() == np.searchsorted(values, asked).tolist()
        assert ((ef.find(asked) >= 0) == np.isin(asked, values)).all()
        if len(values):
            assert (ef[np.arange(len(values))] == values).all()


def test_query_against_plain_model(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in rows}
    c1, n, v, score, _ = plain_model([r["text"] for r in rows if not held[r["doc_id"]]])
    got = {r["doc_id"]: r for r in lm.op7_lm(spark, SF).collect()}
    assert len(got) == len(rows)
    better = 0
    for r in rows:
        tokens, g = plain_tokens(r["text"]), got[r["doc_id"]]
        assert g["held_out"] == held[r["doc_id"]] and g["train_tokens"] == n
        assert g["n_tokens"] == len(tokens) and g["n_known"] == sum(c1[t] > 0 for t in tokens)
        base = sum(math.log10((c1[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        assert g["base_score"] == pytest.approx(base, rel=1e-9)
        assert g["score"] == pytest.approx(score(r["text"]), abs=0.01 * (len(tokens) + 1))  # quantised
        better += g["score"] > g["base_score"]
    assert better > 0.9 * len(rows)


def test_sums_to_one():
    texts = ["a b c a b d", "a b c", "b c a b", "x y a b c"]
    c1, n, v, _, p3 = plain_model(texts)
    for context in (("a", "b"), ("x", "y"), ("q", "a")):
        assert sum(p3(w, *context) for w in c1) + p3("unseen", *context) == pytest.approx(1)


def test_small_blocks_and_rare_words(spark, monkeypatch):
    for name, value in (("FLUSH_WORDS", 3), ("FLUSH_TOKENS", 4), ("SCORE_TOKENS", 5)):
        monkeypatch.setattr(lm, name, value)
    texts = ["a b c a b d e", "A B c", "b c a b f", None, "", "x y a b c", "a b c a b d e"] * 2 + ["é g"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, _, _, score, _ = plain_model(texts, word_share=0.05, share=0.02)
    model = lm.train(docs, word_share=0.05, share=0.02)
    for r in lm.score(docs, model).collect():
        assert r["score"] == pytest.approx(score(texts[r["doc_id"]]), rel=1e-4)  # few values: exact


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "w " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rare", F.lit("clash"))
    out = lm.score(docs, lm.train(docs)).collect()
    assert sorted(r["n_tokens"] for r in out) == [1, 1, 3, 3, 50_001]
    assert all(r["n_known"] == r["n_tokens"] and r["score"] <= 0 for r in out)
    nothing = lm.train(docs.limit(0))
    out = lm.score(docs, nothing).collect()
    assert (nothing.n_tokens, nothing.n_types) == (0, 0)
    assert all(r["base_score"] == pytest.approx(0) and r["n_known"] == 0 for r in out)
    assert lm.score(docs.limit(0), nothing).count() == 0


def test_repeats_are_kept_at_every_size(spark, monkeypatch):
    """A phrase of count 2 keeps its score when 2.5 M tokens of other text come in, over many shards."""
    monkeypatch.setattr(lm, "SHARD_GRAMS", 3)
    phrase = ["alpha beta gamma delta", "alpha beta gamma delta"]
    texts = phrase + ["one two three one two four", "two three one two"] + ["w " * 125_000] * 20
    assert lm.WORD_SHARE * 2.5e6 < 2 and lm.SHARE * 2.5e7 < 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, _, _, score, _ = plain_model(texts)
    model = lm.train(docs)
    assert all(len(names) > 2 for names in model.files[:3])
    got = {r["doc_id"]: r for r in lm.score(docs, model).collect()}
    for i in range(4):
        assert got[i]["score"] == pytest.approx(score(texts[i]), rel=1e-4)
        assert got[i]["score"] > got[i]["base_score"] + 3


def test_look_ups_are_shared_and_bounded(monkeypatch):
    """Equal neighbours and those of one high part are looked up once, in pieces of bounded size."""
    values = np.arange(0, 2_000_000, 2)
    ef, sizes = EliasFano.build(values, 1 << 40), []
    starts = EliasFano._starts
    monkeypatch.setattr(EliasFano, "_starts", lambda self, top: sizes.append(len(top)) or starts(self, top))
    asked = np.repeat(values[:100_000], 3)
    assert (ef.find(asked) == asked // 2).all() and (ef.find(asked + 1) == -1).all()
    assert sum(sizes) < 1_000  # before: one or two for each of 600,000
    sizes.clear()
    assert (ef.find(values[::-1]) == values[::-1] // 2).all() and max(sizes) <= 1 << 15
    assert (ef.successor(asked + 1) == asked // 2 + 1).all() and (ef[np.arange(len(values))] == values).all()


def test_counts_reach_the_shuffle_by_bucket(spark, monkeypatch):
    """One row for each bucket, not each n-gram, and the same trie for one bucket or many."""
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(200)) for i in range(60)] + ["w1 w2 " * 3_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shuffled, seen = lm._count_grams, []

    def watched(files, order, n_buckets):
        run = shuffled(files, order, n_buckets)
        seen.append((docs.select("text").mapInPandas(run, "bucket long, keys binary, many binary").count(), n_buckets))
        return run

    monkeypatch.setattr(lm, "_count_grams", watched)
    got = []
    for tokens in (1_000_000, 500):
        monkeypatch.setattr(lm, "BUCKET_TOKENS", tokens)
        got.append({r["doc_id"]: r["score"] for r in lm.score(docs, lm.train(docs)).collect()})
    parts = docs.rdd.getNumPartitions()
    assert got[0] == got[1] and all(rows <= parts * n for rows, n in seen)
    assert [n for _, n in seen] == [1, 1, 37, 37]
    _, _, _, score, _ = plain_model(texts)
    assert all(got[1][i] == pytest.approx(score(t), abs=0.01 * (len(plain_tokens(t)) + 1)) for i, t in enumerate(texts))


def test_packed_numbers():
    for numbers in (np.zeros(0, dtype=np.int64), np.array([0, 1, 255, 256, 2**62, -1]), np.arange(1000)):
        assert (lm.unpacked(lm.packed(numbers)) == numbers).all()
    many = np.bincount(lm.bucket_of(np.arange(100_000) + 7 * 10**12, 37), minlength=37)
    assert len(many) == 37 and many.max() < 1.2 * many.mean()
