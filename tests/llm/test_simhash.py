"""SimHash: bit-by-bit fingerprints, trie join and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.trie_join import linked

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(items, near):
    up = {x: x for x in items}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in items:
        for b in items:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {x: find(x) for x in items}


def expected(rows):
    codes = {}
    for i, text in rows:
        codes.setdefault(plain_fingerprint(text), []).append(i)
    roots = plain_roots(list(codes), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for code, ids in codes.items():
        least[roots[code]] = min(least.get(roots[code], 1 << 62), *ids)
    return {i: (f"{code:016x}", least[roots[code]]) for code, ids in codes.items() for i in ids}


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op9_simhash(spark, SF).collect()}
    assert got == expected(rows)


def test_spark_hash_is_the_same(spark):
    text = "one two three four"
    want = spark.range(1).select(F.xxhash64(F.lit(text))).head()[0]
    assert np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)) == np.int64(want).view(np.uint64)


def clustered(seed, n):
    rnd = np.random.default_rng(seed)
    codes = rnd.integers(0, 2**63, 5, dtype=np.uint64)[rnd.integers(0, 5, n)]
    for _ in range(rnd.integers(0, 9)):
        codes = codes ^ (np.uint64(1) << rnd.integers(0, 64, n).astype(np.uint64)) * (rnd.random(n) < .5)
    return codes


@pytest.mark.parametrize("seed", range(12))
def test_trie_join(seed):
    codes = clustered(seed, 40)
    groups = np.random.default_rng(seed).integers(0, 2, len(codes))
    order = np.lexsort((codes, groups))
    codes, groups = codes[order], groups[order]
    for budget in (0, 1, 2, 4):
        want = plain_roots(range(len(codes)), lambda a, b: groups[a] == groups[b]
                           and int(codes[a] ^ codes[b]).bit_count() <= budget)
        assert linked(codes, groups, budget).tolist() == list(want.values())


@pytest.mark.parametrize("group_codes,key_codes", [(50_000, 64), (8, 64), (50_000, 1e-6)])
def test_links_whatever_the_groups(spark, monkeypatch, group_codes, key_codes):
    monkeypatch.setattr(simhash, "GROUP_CODES", group_codes)
    monkeypatch.setattr(simhash, "KEY_CODES", key_codes)
    monkeypatch.setattr(simhash, "BUFFER_CODES", 50)
    codes = sorted(set(np.concatenate([clustered(s, 60) for s in range(3)]).view(np.int64).tolist()))
    df = spark.createDataFrame([(c,) for c in codes], "code long")
    roots = dict(components(simhash.links(df)).collect())
    want = plain_roots(codes, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    assert {c: roots.get(c, c) for c in codes} == want


def test_components_of_chains(spark):
    rnd = random.Random(2)
    names = rnd.sample(range(-500, 500), 60)
    edges = list(zip(names[:39], names[1:40])) + [(names[50], n) for n in names[40:50]] + [(names[55], names[55])]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    want = {n: min(names[:40]) for n in names[:40]} | {n: min(names[40:51]) for n in names[40:51]}
    assert got == {n: r for n, r in want.items() if n != r}


def test_edge_rows(spark):
    rows = [(5, None), (3, ""), (9, " \t\n"), (4, "one two"), (4, "one two"), (8, "ONE  two"),
            (None, "one two"), (7, "x " * 20000), (6, "other words here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("code", F.lit("clash"))
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert len(got) == len(rows)
    by_id = {i: (f, c) for i, f, c in got}
    assert by_id[5] == by_id[3] == by_id[9] == ("0" * 16, 3)
    assert by_id[8][1] == by_id[4][1] == by_id[None][1] == 4
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 6, 7]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_component(spark):
    a, b, c, d = ("alpha beta gamma delta epsilon", "one two three four five six", "red green blue black white",
                  "north south east west up down")
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (8, c), (9, a), (3, "x y z"), (4, "x y z"),
            (4, "p q r s t"), (5, "p q r s t"), (None, "z z top of all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__n", F.lit(0))
    got = [(r["doc_id"], r["text"]) for r in simhash.drop_near_duplicates(docs).collect()]
    # (4, "x y z") goes although another row with id 4 is the least of its own component
    want = [(9, a), (None, b), (7, c), (7, d), (3, "x y z"), (4, "p q r s t"), (None, "z z top of all")]
    assert sorted(got, key=str) == sorted(want, key=str)
    null_first = [(None, "x", "p"), (None, "p", "x"), (None, None, "x"), (None, "x", None)]
    docs = spark.createDataFrame(null_first, "doc_id long, text string, lang string")
    assert sorted(str(r["text"]) for r in simhash.drop_near_duplicates(docs).collect()) == ["None", "p", "x"]


def test_dropping_keeps_any_column_names(spark):
    rows = [(k, "five words of one text " * 3 + "x" * (k % 2), 1, 2, 3) for k in range(6)]
    docs = spark.createDataFrame(rows, "`doc.id` long, row string, __h1 long, code long, best long")
    out = simhash.drop_near_duplicates(docs, id_col="doc.id", text_col="row")
    assert out.columns == docs.columns and [r[0] for r in out.collect()][0] == 0
