"""Operator 12: cross-tokenizer alignment.

Two tokenizers cut the same bytes; which of their tokens belong together?
Tokens and bytes make incidence matrices in compressed sparse rows, built here
by hand: A has a row for each token of the one tokenizer with ones at its bytes,
B likewise for the other. Row i of the product A Bᵀ (Gustavson's way: for each
byte of token i, add the row of Bᵀ that the byte names) holds the tokens that
overlap token i, and how many bytes they share: the overlap links. Offsets
where tokens of both end cut the text into groups; the token-group matrices'
product gives the shared-group links, and its row sizes alone, the product's
symbolic phase, give their number without writing them out.

The corpus part counts, for every pair of ids, the documents that hold it
linked. Each document is encoded once and written as its distinct linked pairs
with their repeats. A pair in more than one of ``FREQUENT`` pair entries is
frequent; there are fewer than ``FREQUENT`` of these whatever the input, so they
go to every task as sorted arrays. The rest meet their counts in a join whose
keys each hold fewer than that share of the rows. Both ways give the same sums.

A is the byte-level BPE file, read with space + text; texts of Latin letters go
through the same vocabulary as ranks (several times faster, same ids), all
others through the file itself. B is the piece model, which adds the space.

Defined results: texts that are null, empty, or whose tokens' bytes are not
those of space + text have no tokens: zeros, '' and no links. Rows are documents
of their own, whatever their ids. Strings of special tokens are plain text. A
text is encoded whole; its incidence is worked on in blocks of ``BLOCK_BYTES``
by rows. An empty table gives an empty result; columns beside id and text are
not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.bpe import byte_alphabet
from tidemark.llm.common import bounded_batches, table, texts_of, written

BLOCK_BYTES = 1 << 20     # bytes of text whose incidence is multiplied at a time
FREQUENT = 1_000_000      # a pair in more than one of so many pair entries is frequent

# Characters beyond which the engines of file and ranks may class characters differently.
OTHER_CHARACTERS = re.compile("[^\x00-\x1b\x20-ɏ]")


class Incidence(NamedTuple):
    """A 0/1 matrix in compressed sparse rows."""
    starts: np.ndarray   # row i holds columns[starts[i]:starts[i + 1]]
    columns: np.ndarray
    width: int

    @classmethod
    def of_spans(cls, ends: np.ndarray) -> Incidence:
        """Rows are consecutive spans that end at ``ends``, columns the positions in them."""
        n = int(ends[-1]) if len(ends) else 0
        return cls(np.append(0, ends), np.arange(n, dtype=np.int32), n)

    @classmethod
    def of_labels(cls, labels: np.ndarray, width: int) -> Incidence:
        """Rows hold a single one, at their label."""
        return cls(np.arange(len(labels) + 1), labels, width)

    def transposed(self) -> Incidence:
        rows = np.repeat(np.arange(len(self.starts) - 1, dtype=np.int32), np.diff(self.starts))
        by = np.argsort(self.columns, kind="stable")
        starts = np.append(0, np.cumsum(np.bincount(self.columns, minlength=self.width)))
        return Incidence(starts, rows[by], len(self.starts) - 1)

    def row_sizes(self, other: Incidence) -> np.ndarray:
        """Symbolic phase for rows without repeats (each row names disjoint rows of
        ``other``): the number of entries in each row of the product."""
        sizes = np.append(0, np.cumsum(np.diff(other.starts)[self.columns]))
        return np.diff(sizes[self.starts])

    def times(self, other: Incidence, block: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row products with ``other``, some rows at a time: (row, column, value), sorted."""
        work = np.append(0, np.cumsum(np.diff(other.starts)[self.columns]))[self.starts]   # before each row
        lo, n = 0, len(self.starts) - 1
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(work, work[lo] + block, side="right")) - 1)
            yield self._rows(other, lo, hi)
            lo = hi

    def _rows(self, other: Incidence, lo: int, hi: int):
        named = self.columns[self.starts[lo]:self.starts[hi]]
        rows = np.repeat(np.arange(lo, hi, dtype=np.int32), np.diff(self.starts[lo:hi + 1]))
        first, size = other.starts[named], np.diff(other.starts)[named]
        if len(size) and size.min() == 1 == size.max():   # each names a row of one entry
            columns = other.columns[first]
        else:
            ends = np.cumsum(size)
            at = np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
            rows, columns = np.repeat(rows, size), other.columns[at]
        # add up equal (row, column)
        same = rows[1:] == rows[:-1]
        if np.any(same & (columns[1:] < columns[:-1])):
            cells, value = np.unique(rows.astype(np.int64) * other.width + columns, return_counts=True)
            return cells // other.width, cells % other.width, value
        heads = np.append(0, np.flatnonzero(~same | (columns[1:] != columns[:-1])) + 1)[:len(rows)]
        return rows[heads], columns[heads], np.diff(np.append(heads, len(rows)))


class Cut(NamedTuple):
    """Texts cut by both tokenizers, in one row of bytes; tokens are numbered through."""
    a: np.ndarray        # ids
    b: np.ndarray
    a_ends: np.ndarray   # byte offsets where tokens end
    b_ends: np.ndarray
    group_ends: np.ndarray

    @classmethod
    def of(cls, a, b, a_ends, b_ends) -> Cut:
        return cls(a, b, a_ends, b_ends, np.intersect1d(a_ends, b_ends, assume_unique=True))

    def overlaps(self, block: int = BLOCK_BYTES):
        """(A token, B token, bytes shared) of every overlapping pair, in blocks of rows."""
        return Incidence.of_spans(self.a_ends).times(Incidence.of_spans(self.b_ends).transposed(), block)

    def group_matrices(self) -> tuple[Incidence, Incidence]:
        n = len(self.group_ends)
        return (Incidence.of_labels(np.searchsorted(self.group_ends, self.a_ends), n),
                Incidence.of_labels(np.searchsorted(self.group_ends, self.b_ends), n))

    def shared_groups(self, block: int = BLOCK_BYTES):
        """(A token, B token, 1) of every pair in one group, in blocks of rows."""
        of_a, of_b = self.group_matrices()
        return of_a.times(of_b.transposed(), block)

    def group_text(self) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3;`` as bytes, each group with a semicolon after it,
        and where the groups end in it."""
        of_a, of_b = (m.columns for m in self.group_matrices())
        n = len(self.group_ends)
        a_after, b_after = (np.cumsum(np.bincount(x, minlength=n)) for x in (of_a, of_b))
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        mark = np.full(len(order), ord(","), dtype=np.uint8)
        order[np.arange(len(self.a)) + np.append(0, b_after)[of_a]] = self.a
        order[np.arange(len(self.b)) + a_after[of_b]] = self.b
        mark[a_after - 1 + np.append(0, b_after)[:n]] = ord("|")
        mark[a_after + b_after - 1] = ord(";")
        digits = _decimals(int(order.max()) if len(order) else 0)[order]
        digits[:, -1] = mark
        shown = digits != 0
        ends = np.cumsum(shown.sum(axis=1))
        return digits[shown], ends[a_after + b_after - 1]


_DECIMALS: dict[int, np.ndarray] = {}


def _decimals(most: int) -> np.ndarray:
    """Row i: the decimal digits of i, zero bytes, and a place for a mark."""
    width = len(str(most))
    if width not in _DECIMALS:
        numbers = np.char.encode(np.arange(10 ** width).astype(str), "ascii")
        rows = np.zeros((10 ** width, width + 1), dtype=np.uint8)
        rows[:, :width] = numbers.astype(f"S{width}").view(np.uint8).reshape(-1, width)
        _DECIMALS[width] = rows
    return _DECIMALS[width]


def _table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte string of all tokens and their offsets in it."""
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))


class Tokenizers:
    """Both tokenizers, from the contents of their files."""

    def __init__(self, file_text: str, piece_model: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.file = Tokenizer.from_str(file_text)
        self.file.encode_special_tokens = True
        self.file.no_truncation()
        self.file.no_padding()
        vocabulary = json.loads(file_text)["model"]["vocab"]
        back = {c: b for b, c in byte_alphabet().items()}
        bytes_of = {i: bytes(back[c] for c in token) for token, i in vocabulary.items()}
        self.n_a = max(bytes_of) + 1
        self.a_table = _table([bytes_of.get(i, b"") for i in range(self.n_a)])
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
            mergeable_ranks=_as_ranks(json.loads(file_text)["model"], bytes_of, vocabulary), special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        p = self.pieces
        self.n_b = p.get_piece_size()
        self.b_table = _table([
            b"" if p.is_control(i) or p.is_unknown(i) else bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i)
            else p.id_to_piece(i).replace("▁", " ").encode() for i in range(self.n_b)])

    def a_ids(self, texts: list[str]) -> list[np.ndarray]:
        odd = [k for k, t in enumerate(texts) if OTHER_CHARACTERS.search(t)]
        slow = iter(self.file.encode_batch_fast([" " + texts[k] for k in odd], add_special_tokens=False) if odd else [])
        is_odd = set(odd)
        return [np.array(next(slow).ids, dtype=np.int64) if k in is_odd
                else self.ranks.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64)
                for k, t in enumerate(texts)]

    def b_ids(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1)

    def cut(self, texts: list[str]) -> tuple[Cut, np.ndarray, np.ndarray, np.ndarray]:
        """The texts' cut, and for each text its bytes, A and B tokens (0 where it has none)."""
        full = [k for k, t in enumerate(texts) if t]
        a_ids = self.a_ids([texts[k] for k in full])
        b_ids = self.b_ids([texts[k] for k in full])
        n_bytes, n_a, n_b = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
        a_good, b_good = [], []
        for k, a, b in zip(full, a_ids, b_ids):
            b = np.array(b, dtype=np.int64)
            raw = (" " + texts[k]).encode("utf-8", "replace")
            if self._bytes(self.a_table, a) == raw == self._bytes(self.b_table, b):
                n_bytes[k], n_a[k], n_b[k] = len(raw), len(a), len(b)
                a_good.append(a)
                b_good.append(b)
        a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (a_good, b_good))
        a_ends, b_ends = (np.cumsum(np.diff(t[1])[x]) for t, x in ((self.a_table, a), (self.b_table, b)))
        return Cut.of(a, b, a_ends, b_ends), n_bytes, n_a, n_b

    @staticmethod
    def _bytes(of: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> bytes:
        blob, offsets = of
        sizes = np.diff(offsets)[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(offsets[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return blob[at].tobytes()


def _as_ranks(model: dict, bytes_of: dict[int, bytes], vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Token bytes -> id, where ids rise in the order of the merges (as they do in the file)."""
    order = []
    for pair in model["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        order.append(vocabulary[left + right])
    if order != sorted(order):
        raise ValueError("ids do not follow the order of merges")
    singles = {bytes_of[i]: i for i in vocabulary.values() if len(bytes_of[i]) == 1}
    return singles | {bytes_of[i]: i for i in order}


_LOADED: dict[bytes, Tokenizers] = {}


def _loaded(file_text: str, piece_model: bytes) -> Tokenizers:
    key = hashlib.sha1(file_text.encode() + piece_model).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizers(file_text, piece_model)
    return _LOADED[key]


def _broadcast(spark: SparkSession, a_path: str | None, b_path: str | None):
    """The contents of both files, sent to every worker once; their size is the files'."""
    import public_tokenizers

    with open(a_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        a = f.read()
    with open(b_path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        b = f.read()
    return spark.sparkContext.broadcast((a, b))


def _blocks(texts: list[str], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters; a longer text is alone."""
    lo, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > most:
            yield lo, k
            lo, size = k, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, pa.int64()))


def _columns(batch: pa.RecordBatch, block: tuple[int, int], columns: dict) -> pa.RecordBatch:
    lo, hi = block
    return pa.RecordBatch.from_arrays([batch.column("doc").slice(lo, hi - lo), *columns.values()],
                                      ["doc", *columns])


def _tokens_schema(doc_type) -> StructType:
    longs = ArrayType(LongType())
    return StructType([StructField("doc", doc_type), StructField("groups", StringType()),
                       *[StructField(n, longs) for n in ("a_ids", "b_ids", "link_a", "link_b", "link_bytes",
                                                         "group_a", "group_b")]])


def aligned_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document: doc, groups, both tokenizers' ids, the overlap links (places of
    the A and B token, bytes shared) and the shared-group links (places)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    files = _broadcast(spark, a_path, b_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _loaded(*files.value)
        for batch in batches:
            texts = texts_of(batch.column("text").to_pylist())
            for k, t in enumerate(texts):
                cut, _, _, _ = both.cut([t])
                links = [np.concatenate(x) for x in zip(*cut.overlaps())] or [cut.a] * 3
                shared = [np.concatenate(x) for x in zip(*cut.shared_groups())] or [cut.a] * 3
                text = cut.group_text()[0].tobytes()[:-1].decode()
                lists = [cut.a, cut.b, *links, *shared[:2]]
                yield _columns(batch, (k, k + 1), {"groups": pa.array([text], pa.string())} | {
                    n: _lists(np.array([len(x)]), x) for n, x in zip(
                        ("a_ids", "b_ids", "link_a", "link_b", "link_bytes", "group_a", "group_b"), lists)})

    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.mapInArrow(work, _tokens_schema(rows.schema["doc"].dataType))


def _digest_schema(doc_type) -> StructType:
    return StructType([StructField("doc", doc_type),
                       *[StructField(n, LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_group_links")],
                       StructField("groups_sha256", StringType()),
                       StructField("pairs", ArrayType(LongType())), StructField("times", ArrayType(LongType()))])


def digested(batches: Iterator[pa.RecordBatch], both: Tokenizers, block_bytes: int = BLOCK_BYTES):
    """(doc, text) batches -> rows of ``_digest_schema``: counts, the digest of the
    groups, and the distinct linked id pairs (A id * B ids + B id) with their repeats."""
    n_pairs = both.n_a * both.n_b
    for batch in batches:
        texts = texts_of(batch.column("text").to_pylist())
        for lo, hi in _blocks(texts, block_bytes):
            cut, n_bytes, n_a, n_b = both.cut(texts[lo:hi])
            byte_ends, a_ends = np.cumsum(n_bytes), np.cumsum(n_a)
            group_last = np.searchsorted(cut.group_ends, byte_ends, side="right")
            n_groups = np.diff(np.append(0, group_last))
            of_a, of_b = cut.group_matrices()
            in_group = np.append(0, np.cumsum(of_a.row_sizes(of_b.transposed())))
            n_links, cells, times = np.zeros(hi - lo, dtype=np.int64), [], []
            for rows, columns, _ in cut.overlaps(block_bytes):
                doc = np.searchsorted(a_ends, rows, side="right")
                n_links += np.bincount(doc, minlength=hi - lo)
                found, n = np.unique(doc * n_pairs + cut.a[rows] * both.n_b + cut.b[columns], return_counts=True)
                cells.append(found)
                times.append(n)
            cell, n = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (cells, times))
            if len(cells) > 1:
                cell, where = np.unique(cell, return_inverse=True)
                n = np.bincount(where, weights=n).astype(np.int64)
            shown, group_stop = cut.group_text()
            raw, digests = shown.tobytes(), []
            stops = np.append(0, group_stop)[group_last]
            for k in range(hi - lo):
                start = stops[k - 1] if k else 0
                digests.append(hashlib.sha256(raw[start:stops[k] - 1]).hexdigest() if n_a[k] else "")
            distinct = np.bincount(cell // n_pairs, minlength=hi - lo)
            longs = lambda x: pa.array(x, pa.int64())
            yield _columns(batch, (lo, hi), {
                "n_a": longs(n_a), "n_b": longs(n_b), "n_groups": longs(n_groups), "n_links": longs(n_links),
                "n_group_links": longs(np.diff(np.append(0, in_group[a_ends]))),
                "groups_sha256": pa.array(digests, pa.string()),
                "pairs": _lists(distinct, cell % n_pairs), "times": _lists(distinct, n)})


def pair_counts(linked: DataFrame, n_b: int) -> DataFrame:
    """pair, docs (documents that hold it linked), best (no pair of its A id has more)."""
    counts = written(linked.select(F.explode("pairs").alias("pair")).groupBy("pair")
                     .agg(F.count(F.lit(1)).alias("docs")), "pair-docs").withColumn("a", F.expr(f"pair div {n_b}"))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return written(counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")),
                   "pair-counts")


def _scored_schema() -> StructType:
    return StructType([StructField("row", LongType()), StructField("sum", LongType()), StructField("hits", LongType()),
                       StructField("pairs", ArrayType(LongType())), StructField("times", ArrayType(LongType()))])


def _with_frequent(batches: Iterator[pa.RecordBatch], pair: np.ndarray, docs: np.ndarray, best: np.ndarray):
    """Sums over a document's frequent pairs; its other pairs are handed on."""
    for batch in batches:
        pairs, times = batch.column("pairs"), batch.column("times")
        of = np.repeat(np.arange(len(pairs)), np.diff(pairs.offsets.to_numpy()))
        code, n = pairs.flatten().to_numpy(), times.flatten().to_numpy()
        at = np.minimum(np.searchsorted(pair, code), max(len(pair) - 1, 0))
        hit = pair[at] == code if len(pair) else np.zeros(len(code), dtype=bool)
        total, hits = (np.zeros(len(pairs), dtype=np.int64) for _ in range(2))
        np.add.at(total, of[hit], docs[at[hit]] * n[hit])
        np.add.at(hits, of[hit], best[at[hit]] * n[hit])
        rest = np.bincount(of[~hit], minlength=len(pairs))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(total), pa.array(hits), _lists(rest, code[~hit]), _lists(rest, n[~hit])],
            ["row", "sum", "hits", "pairs", "times"])


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document: doc, n_a, n_b, n_groups, n_links, n_group_links, groups_sha256,
    n_best and count_sum (over its overlap links, by the corpus-wide pair counts)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    files = _broadcast(spark, a_path, b_path)
    n_b = _loaded(*files.value).n_b
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    linked = written(rows.mapInArrow(lambda batches: digested(batches, _loaded(*files.value)),
                                     _digest_schema(rows.schema["doc"].dataType))
                     .withColumn("row", F.monotonically_increasing_id()), "linked")

    counts = pair_counts(linked, n_b)
    entries = counts.agg(F.sum("docs")).first()[0] or 0
    common = counts.where(F.col("docs") * FREQUENT > entries)   # fewer than FREQUENT rows
    top = common.toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast([top.column("pair").to_numpy(), top.column("docs").to_numpy(),
                                         top.column("best").to_numpy().astype(np.int64)])
    scored = written(linked.select("row", "pairs", "times")
                     .mapInArrow(lambda batches: _with_frequent(batches, *sent.value), _scored_schema()), "scored")
    rare = (scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("at"))
            .select("row", F.col("at.pairs").alias("pair"), F.col("at.times").alias("times"))
            .join(counts.where(F.col("docs") * FREQUENT <= entries), "pair")
            .select("row", (F.col("times") * F.col("docs")).alias("sum"),
                    (F.col("times") * F.col("best").cast("long")).alias("hits")))
    sums = (scored.select("row", "sum", "hits").unionByName(rare)
            .groupBy("row").agg(F.sum("sum").alias("count_sum"), F.sum("hits").alias("n_best")))
    return linked.drop("pairs", "times").join(sums, "row").drop("row")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (align(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select(F.col("doc").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                    "groups_sha256", "n_group_links"))
