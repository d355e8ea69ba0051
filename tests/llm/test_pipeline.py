"""The pipeline against a plain version of every stage, and on edge rows."""

import hashlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_simhash import plain_fingerprint, plain_roots
from tidemark.llm import bpe, mixing, quality, secrets
from tidemark.llm.common import crc_remainder

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_mix(docs):
    """Copies of each (id, source, text) by one sorted list."""
    items = {}
    for d in docs:
        key = hashlib.md5((d["text"] or "").encode()).hexdigest()
        name = (d["doc_id"], d["source"], hashlib.md5(f"mix:{d['doc_id'] if d['doc_id'] is not None else ''}:{key}".encode()).hexdigest())
        n = len((d["text"] or "").encode().split())
        items[name] = items.get(name, 0) + n
    sources = sorted({s for _, s, _ in items}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for (_, x, _), n in items.items() if x == s) for s in sources}
    budget, target, open_ = 1.5 * sum(size.values()), {}, set(sources)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    while True:
        left = budget - sum(2 * size[s] for s in sources if s not in open_)
        for s in open_:
            target[s] = left * weight[s] / sum(weight[x] for x in open_)
        above = {s for s in open_ if target[s] > 2 * size[s]}
        target |= {s: 2 * size[s] for s in above}
        open_ -= above
        if not above or not open_:
            break
    queue = []
    for s in sources:
        served = 0
        for name in sorted((k for k in items if k[1] == s), key=lambda k: k[2]):
            served += items[name]
            if target[s]:
                queue += [((served + size[s] * c) / target[s], sources.index(s), name) for c in range(2)]
    copies, total = {}, 0
    for _, _, name in sorted(queue, key=lambda q: (q[0], q[1], q[2][2])):
        total += items[name]
        if total > budget:
            break
        copies[name] = copies.get(name, 0) + 1
    return copies


def test_against_plain_stages(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [r.asDict() for r in table.collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(crc_remainder(F.col("doc_id"), 3) != 1)
    model = quality.train(table, labels)
    docs = [d for d, s in zip(docs, model.scores([d["text"] for d in docs])) if s >= 0.5]
    codes = {d["doc_id"]: plain_fingerprint(d["text"]) for d in docs}
    distinct = sorted(set(codes.values()))
    roots = plain_roots(distinct, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, c in codes.items():
        least[roots[c]] = min(least.get(roots[c], i), i)
    docs = [d for d in docs if d["doc_id"] in set(least.values())]
    for d in docs:
        d["text"] = secrets.redacted(d["text"])
    copies = plain_mix(docs)
    library = Tokenizer.from_file(bpe.vocabulary_path())
    want = []
    for d in docs:
        n = sum(c for (i, _, _), c in copies.items() if i == d["doc_id"])
        ids = library.encode(d["text"], add_special_tokens=False).ids
        want += [(d["doc_id"], d["lang"], d["source"], len(ids), tuple(ids), True)] * n
    got = [(r["doc_id"], r["lang"], r["source"], r["n_tokens"], tuple(r["ids"]), r["exact"])
           for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(got) > 50


def test_stages_keep_columns_and_edge_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "token = abcdefgh1234", "en", "a", 20),
            (3, "token = abcdefgh1234", "en", "a", 20), (None, "no id here at all", "fr", None, 17),
            (5, "long words " * 20_000, "en", "b", 220_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == COLUMNS and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType, name
        assert out.count() <= 2 * len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0
    clean = {r["doc_id"]: r for r in corpus_pipeline.secrets_stage(spark, docs, SF).collect()}
    assert clean[3]["text"] == "<assign>" and clean[3]["n_chars"] == 8 and clean[1]["n_chars"] is None
    out = corpus_pipeline.tokens_stage(spark, docs, SF).collect()
    assert len(out) == len(rows) and all(r["exact"] for r in out)
    assert np.sum([r["n_tokens"] for r in out]) == sum(len(r["ids"]) for r in out)


def test_secrets_stage_edge_rows(spark):
    rows = [(1, "password=abcdefgh x", 19, "p"), (2, None, None, "q"), (2, None, None, "q"), (3, "", 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, `a.b` string")
    out = corpus_pipeline.secrets_stage(spark, docs, "")
    assert out.schema.names == docs.schema.names
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "<assign> x", 10, "p"), *rows[1:]]
    assert corpus_pipeline.secrets_stage(spark, docs.limit(0), "").count() == 0


def test_clashing_columns(spark):
    """Names that stages use themselves, and one with a dot, pass through with their values."""
    extra = ["id", "label", "place", "hash", "score", "row", "code", "root", "h1", "key", "__id", "__key", "copies",
             "result", "size", "a.b"]
    texts = {1: "plain words of a document that says something", 2: None, 3: "", 4: "api_key=abcdef123456 and more words",
             5: "other words entirely, on a subject of their own " * 3}
    rows = [(i, t, "en", "ab"[i % 2], len(t or "")) + tuple(f"{c}{i}" for c in extra) for i, t in texts.items()]
    names = COLUMNS + extra
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(
        f"`{c}` string" for c in extra)
    docs = spark.createDataFrame(rows + rows[:1], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == names, name
        got = out.collect()
        for r in got:
            assert tuple(r)[5:] == tuple(f"{c}{r['doc_id']}" for c in extra), name
        ids = [r["doc_id"] for r in got]
        if name == "near_dups":
            assert sorted(ids) == [1, 2, 4, 5]   # null and empty texts are near duplicates
        if name == "secrets":
            assert sorted(ids) == [1, 1, 2, 3, 4, 5]
        assert stage(spark, docs.limit(0), SF).columns == names
    assert corpus_pipeline.tokens_stage(spark, docs, SF).count() == 6
