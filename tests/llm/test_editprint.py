"""Edit fingerprints: step-by-step walks, the next-document order, likeness."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import editprint

SF = "/root/testdata/sf0.001"


def plain_digits(text):
    chars, at, step, out = [int(c) for c in editprint._characters(text)], 0, 0, []
    while chars[at]:
        out.append(chars[at])
        at += (chars[at] * int(editprint._turns(step, 1)[0]) & 0xFFFFFFFF) >> 31
        step += 1
    if not out:
        return [0] * editprint.SAMPLES
    return [(out[max(p for p in places.tolist() if p < len(out))] * int(d) & 0xFFFFFFFF) >> 28
            for places, d in zip(editprint.POSITIONS, editprint._DIGIT)]


def test_walks_side_by_side(monkeypatch):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abc dé\U0001f600") for _ in range(rnd.choice([0, 1, 5, 70, 400]))) for _ in range(90)]
    want = [plain_digits(t) for t in texts]
    assert editprint.digits_of(texts).tolist() == want
    monkeypatch.setattr(editprint, "LANES", 7)
    monkeypatch.setattr(editprint, "FEW_LANES", 2)
    assert editprint.digits_of(texts).tolist() == want


def test_query_against_plain_order(spark, monkeypatch):
    monkeypatch.setattr(editprint, "CHARS_PER_BUCKET", 30_000)
    rows = sorted(((r["doc_id"], r["text"]) for r in
                   spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    got = {r["doc_id"]: r for r in editprint.op8_editprint(spark, SF).collect()}
    assert len(got) == len(rows)
    closer = 0
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = (np.array(d) for d in editprint.digits_of([text, changed, following]))
        assert r["fingerprint"] == editprint.shown(a) and r["edited_fingerprint"] == editprint.shown(b)
        assert r["near_edited"] == pytest.approx(float(editprint.likeness(a, b)))
        assert r["near_next"] == pytest.approx(float(editprint.likeness(a, c)))
        closer += r["near_edited"] > r["near_next"]
    assert closer > 0.95 * len(rows)


def test_likeness_falls_with_edits():
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abcdefghij klmno") for _ in range(1500)) for _ in range(40)]

    def noisy(text, n):
        chars = list(text)
        for _ in range(n):
            i = rnd.randrange(len(chars))
            chars[i:i + rnd.randint(0, 1)] = rnd.choice(["", "x", "xy"])
        return "".join(chars)

    base = editprint.digits_of(texts)
    mean = [editprint.likeness(base, editprint.digits_of([noisy(t, n) for t in texts])).mean() for n in (0, 2, 15, 150)]
    assert mean[0] == 1 and mean[0] > mean[1] > mean[2] > mean[3] and mean[1] > 0.9 > 0.5 > mean[3]


@pytest.mark.parametrize("group", [2000, 4])
def test_near_texts(spark, monkeypatch, group):
    monkeypatch.setattr(editprint, "GROUP_TEXTS", group)
    rnd = random.Random(9)
    texts = [" ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(300)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(10 + 3 * i + k, t[:50] + "xy" * k + t[51:]) for i, t in enumerate(texts) for k in range(2)]
    rows += [(100, texts[0]), (None, texts[1]), (101, None), (102, "")]
    got = {r["doc_id"]: r["component_id"] for r in
           editprint.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert all(got[10 + 3 * i + k] == i for i in range(6) for k in range(2))
    assert got[100] == 0 and got[None] == 1 and got[101] == got[102] == 101


def test_edge_rows(spark):
    rows = [(4, None), (9, ""), (7, "abc def"), (7, "abc dee"), (None, "no id"), (2, "x" * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("clash"))
    out = editprint.fingerprints_with_next(docs).collect()
    assert len(out) == len(rows)
    by_id = {(r["doc_id"], r["n_chars"]): r for r in out}
    assert by_id[(4, 0)]["fingerprint"] == by_id[(9, 0)]["fingerprint"] == "0" * editprint.SAMPLES
    # order: 9, 7 (texts descending), 4, 2, none; the last is followed by the first
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(r["edited_sha256"] for r in out if r["doc_id"] == 7) == sorted([sha("abc abc"), sha("abc ")])
    assert by_id[(2, 60_000)]["edited_sha256"] == sha("x" * 30_000 + "no id")
    assert by_id[(None, 5)]["edited_sha256"] == sha("no ")
    one = editprint.fingerprints_with_next(docs.where("doc_id = 2")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert editprint.fingerprints_with_next(docs.limit(0)).count() == 0


def test_query_finds_near_texts(spark, tmp_path):
    rnd = random.Random(12)
    texts = [" ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(300)) for _ in range(8)]
    rows = list(enumerate(texts)) + [(50 - i, t[:80] + "xy" + t[82:]) for i, t in enumerate(texts[:3])] + [(None, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["component_id"], r["component_docs"])
           for r in editprint.op8_editprint(spark, str(tmp_path)).collect()}
    assert got == ({i: (i, 2 if i < 3 or i == 7 else 1) for i in range(8)}
                   | {50 - i: (i, 2) for i in range(3)} | {None: (7, 2)})


def test_packed_digits():
    rnd = np.random.default_rng(3)
    digits = rnd.integers(0, 16, (50, editprint.SAMPLES), dtype=np.uint8)
    digits[25:, :40] = digits[:25, :40]
    prints = [editprint.packed(d).tobytes() for d in digits]
    assert (editprint.unpacked(prints) == digits).all()
    assert editprint.shown(digits[0]) == "".join("0123456789abcdef"[d] for d in digits[0])
    words = np.frombuffer(b"".join(prints), dtype=np.uint64).reshape(50, -1)
    assert (editprint.differing(words[:, None], words[None]) == (digits[:, None] != digits[None]).sum(axis=-1)).all()


def test_band_shape_follows_the_number_of_prints():
    agree = editprint.NEAR * 15 / 16 + 1 / 16
    before = 0
    for n in (0, 1, 10_000, 250_000, 4_000_000, 10**9, 10**12):
        digits, bands = editprint.band_shape(n)
        assert 1 - (1 - agree ** digits) ** bands >= editprint.CAUGHT and digits >= before
        assert n * bands * editprint.CHANCE ** digits <= editprint.CANDIDATES
        before = digits


def test_neighbours_over_batches():
    import pyarrow as pa

    rnd = random.Random(3)
    for _ in range(100):
        keys = sorted(rnd.randrange(30) for _ in range(rnd.randrange(40)))
        cuts = sorted(rnd.randrange(len(keys) + 1) for _ in range(4))
        batches = [pa.RecordBatch.from_pydict({"key": pa.array(keys[a:b], pa.int64()), "number": pa.array(range(a, b), pa.int64())})
                   for a, b in zip([0, *cuts], [*cuts, len(keys)])]
        got = [n for out in editprint._with_neighbours(batches) for n in out.column("number").to_pylist()]
        assert got == [i for i, k in enumerate(keys) if keys.count(k) > 1 or i in (0, len(keys) - 1)]


def test_link_recall_on_documents(spark):
    """Of all pairs of distinct fingerprints of likeness NEAR or more, nearly all end in one component."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = editprint.near_texts(docs).toPandas().drop_duplicates("fingerprint")
    digits = editprint.unpacked([bytes.fromhex(p) for p in got["fingerprint"]])
    component = got["component_id"].to_numpy()
    found = total = 0
    for k in range(0, len(digits), 64):
        near = editprint.likeness(digits[k:k + 64, None], digits[None]) >= editprint.NEAR
        a, b = np.nonzero(near)
        keep = b > a + k
        total += keep.sum()
        found += (component[a[keep] + k] == component[b[keep]]).sum()
    assert total > 50 and found >= 0.95 * total
    # unrelated texts stay apart
    assert len(set(component)) > 0.5 * len(component)
