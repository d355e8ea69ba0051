"""Language identification: the formula by dictionaries, normalisation,
held-out accuracy, edge rows."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid

SF = "/root/testdata/sf0.1"
TEXTS = [(i, t, lang) for i, (t, lang) in enumerate(
    [("the cat sat on the mat and the dog", "en"), ("a cat and a dog met", "en"), ("le chat est sur la table", "fr"),
     ("la table et le chat été", "fr"), ("The end of the cat!", "en"), ("un chat, une table", "fr")] * 3)]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string")
    return langid.train(docs, sample_chars=10**9)


@pytest.fixture(scope="module")
def kept(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string")
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language sample")), F.lit(1 << 30))
    return [tuple(r) for r in docs.where(h % langid.CALIBRATION != 0).select("text", "lang").collect()]


def letters(text):
    return "".join(map(chr, langid.letters_of(text)))


def by_hand(texts, alphabet):
    """p(character | context) of one language, from string counts."""
    raw = {n: Counter() for n in range(1, langid.ORDER + 1)}
    for t in texts:
        s = letters(t)
        for n in raw:
            for i in range(max(n - 1, 1), len(s)):
                raw[n][s[i - n + 1:i + 1]] += 1
    counts = {langid.ORDER: raw[langid.ORDER]}
    for n in range(langid.ORDER - 1, 0, -1):
        before = {}
        for gram in raw[n + 1]:
            before.setdefault(gram[1:], set()).add(gram[0])
        counts[n] = {g: max(1, len(before.get(g, ()))) for g in raw[n]}
    discount = {}
    for n, c in counts.items():
        ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        discount[n] = min(0.9, max(0.1, ones / max(ones + 2 * twos, 1)))

    def p(char, context):
        n = len(context) + 1
        after = {g: v for g, v in counts[n].items() if g[:-1] == context}
        lower = p(char, context[1:]) if n > 1 else 1 / alphabet
        if not after:
            return lower
        total = sum(after.values())
        return (max(after.get(context + char, 0) - discount[n], 0) / total
                + discount[n] * len(after) / total * lower)

    return p


def test_probabilities(model, kept):
    alphabet = max(2, len({c for t, _ in kept for c in letters(t)[1:]}) + 1)
    for column, lang in enumerate(model.languages):
        p = by_hand([t for t, x in kept if x == lang], alphabet)
        for text in ("the cat", "table chat a", "un dog"):
            s = letters(text)
            want = sum(np.log10(p(s[i], s[max(0, i - langid.ORDER + 1):i])) for i in range(1, len(s)))
            (entropy, n), = model.entropies([text])
            assert n == len(s) - 1
            assert -entropy[column] * n == pytest.approx(want, rel=1e-4)


def test_sums_to_one(model):
    chars = sorted({c for t, _ in [(x[1], 0) for x in TEXTS] for c in letters(t)})
    unseen = 10.0 ** model.floor
    for context in ("th", " ", "the ca", "zq"):
        n = len(context) + 1
        logs = [model.log_probs(np.array([ord(x) for x in context + c], dtype=np.uint32), np.arange(n),
                                np.zeros(n, dtype=int), 1, np.array([n - 1]))[0] for c in chars]
        assert np.all(np.sum(10.0 ** np.array(logs), axis=0) <= 1 + 1e-4)
    assert 0 < unseen < 1


def test_blocks_do_not_matter(model, monkeypatch):
    texts = ["the cat sat on the table " * 9, None, "été", "", "la table et le chat " * 7]
    whole = model.predict(texts)
    monkeypatch.setattr(langid, "BLOCK_CHARS", 11)
    for a, b in zip(model.predict(texts), whole):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1]) and a[3] == b[3]


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in langid.op2_langid(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    held = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in docs)
    assert len(held) > 1000 and np.mean(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_query_by_the_formula(spark, tmp_path):
    """Every row of the query against models from string counts: the winner, its entropy and its score."""
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", F.substring(
        "text", 1, 120).alias("text"))
    small.write.parquet(f"{tmp_path}/documents.parquet")
    rows = small.collect()
    learn = small.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).where("lang is not null")
    model = langid.train(learn)
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language sample")), F.lit(1 << 30))
    hashed = learn.where("text is not null").withColumn("h", h).collect()
    least = {lang: min(r["h"] for r in hashed if r["lang"] == lang and r["text"]) for lang in model.languages}
    counted = [(r["text"], r["lang"]) for r in hashed if r["h"] % langid.CALIBRATION or r["h"] == least[r["lang"]]]
    alphabet = max(2, len({c for t, _ in counted for c in letters(t)[1:]}) + 1)
    p = [by_hand([t for t, x in counted if x == lang], alphabet) for lang in model.languages]
    got = {r["doc_id"]: r for r in langid.op2_langid(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for r in rows[::7] + [r for r in rows if not r["text"]]:   # the plain counts are slow
        s, row = letters(r["text"] or ""), got[r["doc_id"]]
        if len(s) < 2:
            assert row["lang_pred"] == "und" and row["score"] == 0
            continue
        entropy = np.array([-sum(np.log10(q(s[i], s[max(0, i - langid.ORDER + 1):i])) for i in range(1, len(s)))
                            / (len(s) - 1) for q in p])
        weight = np.exp(-(entropy - entropy.min()) * min(len(s) - 1, langid.SPAN) / model.temperature)
        assert row["lang_pred"] == model.languages[int(entropy.argmin())]
        assert row["entropy"] == pytest.approx(entropy.min() / np.log10(2), rel=1e-3)
        assert row["score"] == pytest.approx(weight.max() / weight.sum(), abs=5e-3)


def test_every_language_has_counts(spark):
    """One document a language, and a language whose only documents are above the sample's size."""
    words = {"aa": "bada gada ", "bb": "zilo mixu ", "cc": "threnk splort "}
    for base in range(0, 40, 8):   # whatever their hashes
        rows = [(base + i, words[lang] * (5000 if lang == "cc" else 20), lang) for i, lang in enumerate(words)]
        model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_chars=500)
        assert [r[0] for r in model.predict([w * 3 for w in words.values()])] == list(words)


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.train(none).predict(["words", None]) == [("und", 0.0, None, False)] * 2
    assert none.withColumn("p", langid.predictions(spark, langid.train(none), F.col("text"))).count() == 0


def test_edge_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "123 ... !!"), (4, "the cat"), (4, "the cat"), (None, "le chat " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    out = [r["p"] for r in docs.withColumn("p", langid.predictions(spark, model, F.col("text"))).collect()]
    assert [r["lang_pred"] for r in out] == ["und"] * 3 + ["en", "en", "fr"]
    assert [r["score"] for r in out[:3]] == [0.0] * 3 and out[3] == out[4]
    nothing = langid.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert nothing.predict(["words"]) == [("und", 0.0, None, False)]


def test_rejects_what_no_language_explains(spark):
    real = langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert [r[3] for r in real.predict(["xqzw vvkk jjxq zzpw " * 5, "the and of that in " * 5])] == [True, False]
