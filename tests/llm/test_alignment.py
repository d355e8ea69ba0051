"""Cross-tokenizer alignment: a plain version over dictionaries, matrices, edge rows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    t.no_truncation()
    t.no_padding()
    return t, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def both():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, \
            open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
        return alignment.Tokenizers(f.read(), g.read())


def spans(libraries, text):
    """[(id, start, end)] of both tokenizers, or None."""
    from tidemark.llm.bpe import byte_alphabet

    t, p = libraries
    back = {c: b for b, c in byte_alphabet().items()}
    a = [(i, bytes(back[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode())
         for i in p.encode(text)]
    raw = (" " + text).encode()
    if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return None
    out = []
    for tokens in (a, b):
        at, found = 0, []
        for i, x in tokens:
            found.append((i, at, at + len(x)))
            at += len(x)
        out.append(found)
    return out


def plain(libraries, rows):
    """The contract's rows by nested loops over tokens."""
    links, shape, docs_of = [], [], Counter()
    for _, text in rows:
        cut = spans(libraries, text or "")
        if cut is None:
            links.append([])
            shape.append((0, 0, 0, 0, ""))
            continue
        a, b = cut
        linked, k = [], 0
        for i, s, e in a:
            while b[k][2] <= s:
                k += 1
            j = k
            while j < len(b) and b[j][1] < e:
                linked.append((i, b[j][0]))
                j += 1
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, group_links, lo = [], 0, 0
        for hi in ends:
            inside = [[str(i) for i, s, e in x if lo <= s and e <= hi] for x in (a, b)]
            groups.append("|".join(",".join(x) for x in inside))
            group_links += len(inside[0]) * len(inside[1])
            lo = hi
        links.append(linked)
        shape.append((len(a), len(b), len(ends), group_links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        docs_of.update(set(linked))
    most = defaultdict(int)
    for (i, _), n in docs_of.items():
        most[i] = max(most[i], n)
    return [(doc, *s[:3], len(found), sum(docs_of[x] == most[x[0]] for x in found), sum(docs_of[x] for x in found),
             s[4], s[3]) for (doc, _), found, s in zip(rows, links, shape)]


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


TEXTS = ["plain words", None, "", "<|endoftext|> </s> <s>", "café naïve ß", "中文字 mixed \U0001f600",
         "two  spaces\n\nand\ttabs ", "▁ piece mark", "ﬁ ligature", "a" * 300, "\x00\x1c\x85\xa0", " lead",
         "plain words", "1234567 1.5e3", "<0x41>", "é"]


def test_query_matches_plain_loops(spark, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(d, t) for d, t in rows]
    same(alignment.op12_alignment(spark, SF).collect(), plain(libraries, rows))


@pytest.mark.parametrize("frequent", [1_000_000, 40, 1])
def test_edges_and_both_ways_of_counting(spark, libraries, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)   # all, some, none of the pairs are frequent
    rows = [(k % 12 or None, t) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows],
                               "doc_id long, text string, row long, doc string, `a.b` string")
    got = alignment.align(df).select("doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                     "groups_sha256", "n_group_links").collect()
    same(got, plain(libraries, rows))
    assert alignment.align(df.limit(0)).count() == 0


def test_tokens_links_and_groups_of_the_operator(spark, libraries):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in alignment.aligned_tokens(df).collect():
        cut = spans(libraries, TEXTS[r["doc"]] or "")
        if cut is None:
            assert (r["groups"], r["a_ids"], r["link_a"], r["group_a"]) == ("", [], [], [])
            continue
        a, b = cut
        assert r["a_ids"] == [x[0] for x in a] and r["b_ids"] == [x[0] for x in b]
        want = [(i, j, min(x[2], y[2]) - max(x[1], y[1])) for i, x in enumerate(a) for j, y in enumerate(b)
                if x[1] < y[2] and y[1] < x[2]]
        assert list(zip(r["link_a"], r["link_b"], r["link_bytes"])) == want
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        of = lambda x: int(np.searchsorted(ends, x[2]))
        assert list(zip(r["group_a"], r["group_b"])) == [(i, j) for i, x in enumerate(a) for j, y in enumerate(b)
                                                         if of(x) == of(y)]


def test_row_products_equal_dense_products():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        n, k, m = rnd.integers(1, 9, 3)
        dense = [rnd.integers(0, 2, (n, k)), rnd.integers(0, 2, (k, m))]
        a, b = (alignment.Incidence(np.append(0, np.cumsum(x.sum(axis=1))), np.nonzero(x)[1], x.shape[1]) for x in dense)
        got = np.zeros((n, m), dtype=int)
        for rows, columns, value in a.times(b, block=3):
            got[rows, columns] += value
        assert (got == dense[0] @ dense[1]).all()
        assert (np.diff(a.transposed().starts) == dense[0].sum(axis=0)).all()


def test_ranks_and_file_agree_on_random_texts(both):
    rnd = random.Random(7)
    pool = list(" \t\n\r\x0b\x0c\x00\x1b\x7f\x85\xa0\xad ab'sdretmlABC019\xdf\xe9\xb5\xb2ſİǅ.,!?-=_&#") + [
        "'re", "  ", "aaaa", "the", "ing", "<|endoftext|>"]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(1, 60))) for _ in range(4000)]
    slow = both.file.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
    for text, fast, want in zip(texts, both.a_ids(texts), slow):
        assert fast.tolist() == want.ids, text


def test_blocks_do_not_change_results(both):
    texts = [t for t in TEXTS if t] * 3 + ["word another中 " * 400]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc", "text"])
    rows = [sum((b.to_pylist() for b in alignment.digested([batch], both, size)), []) for size in (1 << 20, 50)]
    assert rows[0] == rows[1]
