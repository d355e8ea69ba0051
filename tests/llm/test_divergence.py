"""Divergence audit: SQL parity, the pointer sort, a plain version, edge rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from oracle_compare import compare, duck
from tidemark.llm import divergence

SF = "/root/testdata/sf0.01"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return ["".join(c.lower() if c < "\x80" else c for c in t) for t in TERM.findall(text or "")]


def plain(rows, min_docs=10, top=10):
    """(lang, source, text) rows -> the audit's rows, with whole dictionaries."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = terms_of(text)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)
        p = {}
        for s in sources:
            size = sum(counts[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 2) // (size + 2 * v) for t in kept}
        total = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        size = sum(total.values())
        q = {t: 1 + 10**9 * (total[t] + 2) // (size + 2 * v) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            word = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", i, -x, r) for r, (x, _, i) in enumerate(sorted(pair), 1)]
            out += [(lang, s, "term", i, -x, r) for r, (x, _, i) in enumerate(sorted(word)[:top], 1)]
    return sorted(out)


def audited(spark, rows, **settings):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    got = divergence.audit(df, **settings)
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got.collect())


def test_matches_sql(spark):
    result = compare(divergence.op13_divergence(spark, SF), divergence.OP13_SQL, duck(SF))
    assert result["match"], result


def sample(n, seed, sources=6):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéß漢") for _ in range(rnd.choice([1, 2, 7, 8, 9, 15, 16, 17, 30])))
                  for _ in range(60)]
    return [(rnd.choice(["x", "y", None]), rnd.choice([f"s{k}" for k in range(sources)] + [None]),
             rnd.choice([" ", "1", "\n", "_"]).join(rnd.choice(vocabulary[:1 + rnd.randrange(60)]).title()
                                                   for _ in range(rnd.randrange(30)))) for _ in range(n)]


@pytest.mark.parametrize("small,piece", [(1 << 15, 8 << 20), (4, 8 << 20), (4, 40)])
def test_shards_equal_plain_counts(small, piece, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "SMALL", small)
    monkeypatch.setattr(divergence, "PIECE_BYTES", piece)   # the last: most texts count as long
    rows = [(a or "", b or "", t) for a, b, t in sample(200, 4)] + [("z", "z", "")]
    want = Counter()
    for lang, source, text in rows:
        for term, n in Counter(terms_of(text)).items():
            want[lang, source, term, "n"] += n
            want[lang, source, term, "docs"] += 1
    got = Counter()
    batch = pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows)], ["lang", "source", "text"])
    for out in divergence.shard_counts([batch.slice(0, 90), batch.slice(90), batch.slice(0, 0)]):
        out.validate(full=True)
        for r in out.to_pylist():
            got[r["lang"], r["source"], r["term"], "n"] += r["n"]
            got[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
    assert got == want


def test_pointer_sort_orders_slices(monkeypatch):
    monkeypatch.setattr(divergence, "SMALL", 8)
    data = np.frombuffer(" ".join(t for _, _, t in sample(80, 9)).lower().encode(), dtype=np.uint8)
    starts, lengths = divergence.term_pointers(data, np.array([0, len(data)]))
    found = divergence.PointerSort(data, starts, lengths)
    raw = data.tobytes()
    slices = [raw[starts[k]:starts[k] + lengths[k]] for k in found.order]
    assert slices == sorted(slices)
    assert [slices[k] for k in found.runs] == sorted(set(slices))


def test_random_rows(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_ENTRIES", 40)   # many chunks, blocks and matrix steps
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", 3)
    monkeypatch.setattr(divergence, "CELLS", 30)
    rows = sample(300, 2, sources=9)
    assert audited(spark, rows, min_docs=4) == plain(rows, 4)


def test_edges(spark):
    rows = [("a", "s", "word " * 3), ("a", "t", None), ("a", "u", ""), ("b", "only", "word")] + [
        ("a", "s", "word")] * 10 + [("c", None, "never often enough"), (None, "s", "\x00\x01"), (None, None, "é")]
    assert audited(spark, rows) == plain(rows)
    assert audited(spark, rows[:0]) == []
    assert audited(spark, [("a", "s", None)]) == []


def test_very_large_counts_stay_exact(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000 // 3, 9_000_000_000_000_000_000 // 2, 5)],
                               "n long, size long, terms long")
    n, size, v, got = df.selectExpr("n", "size", "terms", divergence._share("n", "size") + " as p").first()
    assert got == 1 + 10**9 * (n + 2) // (size + 2 * v)


def test_extra_columns_are_ignored(spark):
    rows = sample(60, 5)
    df = spark.createDataFrame([(*r, 1, "a", "b") for r in rows],
                               "lang string, source string, text string, n long, term string, `a.b` string")
    got = sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank"))
                 for r in divergence.audit(df, min_docs=3).collect())
    assert got == plain(rows, 3)
