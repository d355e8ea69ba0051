"""Operator 13: source divergence audit.

How far the sources of a language lie apart in their use of words, and which
words set a source off from its language.

Terms are counted by a token-start pointer sort. A task takes the bytes of an
Arrow text buffer as they are, marks where terms start, and sorts pointers to
those starts by the slices they point at: a multikey quicksort whose character
is eight bytes. A slice of pointers is split three ways by a pivot; the equal
part goes on eight bytes deeper or, where its terms end, is one run of equal
terms. Small slices are sorted by key at once, and only their ties go deeper.
Runs keep the order of the text, so a run's documents and sources are counted
in one walk. Each shard gives one row per (lang, source, term), and Spark adds
the shards up.

Probabilities are whole numbers of 1e-9 and all sums are exact. The term part
is a join and a ranked window (cut per task to the ranks asked for before the
shuffle). The pair part sums over all kept terms of a language, zeros included:
terms are dealt into chunks of about ``CHUNK_ENTRIES`` counts and sources into
blocks of ``SOURCE_BLOCK``, each chunk is laid out as a dense matrix a few terms
at a time, and a task returns one sum per pair of sources. So neither a hot
language nor a hot source is held by one task.

Defined results: a null text, lang or source is ''; rows are documents of their
own, whatever their ids; a language without kept terms has pairs of value 0 and
no term rows; a group alone in its language has no pairs; ties go by the item's
UTF-8 bytes; an empty table gives an empty result; columns beside the three are
not read. A text longer than ``PIECE_BYTES`` is sorted in pieces; its distinct
terms are held in memory.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table, written

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
PIECE_BYTES = 8 << 20     # bytes whose pointers are sorted together
SMALL = 1 << 15           # pointers that are sorted by key without a pivot
CHUNK_ENTRIES = 200_000   # non-zero counts of a pair task
SOURCE_BLOCK = 256        # sources a pair task compares with all others
CELLS = 1 << 20           # cells of a dense matrix held at a time

# Bytes of a term: ASCII letters and every byte of other characters.
TERM_BYTE = np.ones(256, dtype=bool)
TERM_BYTE[:0x41] = TERM_BYTE[0x5B:0x61] = TERM_BYTE[0x7B:0x80] = False
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 32
# First k bytes of a big-endian word.
LEADING = np.array([0] + [(0xFFFFFFFFFFFFFFFF << (64 - 8 * k)) & 0xFFFFFFFFFFFFFFFF for k in range(1, 9)],
                   dtype=np.uint64)


def term_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of all terms; ``offsets`` are the texts' bounds, which no term crosses."""
    inside = TERM_BYTE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    first[bounds] = inside[bounds]
    last[bounds - 1] = inside[bounds - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


class PointerSort:
    """Sorts pointers by the slices they point at: ``order``, and ``runs``, the
    positions in it where a run of equal slices begins."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        self.windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
        self.starts, self.lengths = starts, lengths
        self.order = np.arange(len(starts))
        self.begins: list[np.ndarray] = []
        self._sort()
        self.runs = np.sort(np.concatenate(self.begins)) if self.begins else np.zeros(0, dtype=np.int64)

    def _keys(self, pointers: np.ndarray, depth: int) -> np.ndarray:
        """Eight bytes of each slice from ``depth`` on, zero beyond its end (no term holds a zero byte)."""
        left = np.clip(self.lengths[pointers] - depth, 0, 8)
        words = np.ascontiguousarray(self.windows[self.starts[pointers] + depth]).view(">u8").ravel()
        return words.astype(np.uint64) & LEADING[left]

    def _sort(self) -> None:
        stack = [(0, len(self.order), 0, None)] if len(self.order) else []
        while stack:
            lo, hi, depth, keys = stack.pop()
            if hi - lo <= SMALL:
                self._finish(lo, hi, depth, keys)
                continue
            part = self.order[lo:hi].copy()
            if keys is None:
                keys = self._keys(part, depth)
            some = np.sort(keys[:: max(1, len(keys) // 9)])
            pivot = some[len(some) // 2]
            less, more = keys < pivot, keys > pivot
            same = ~(less | more)
            n_less, n_same = int(less.sum()), int(same.sum())
            self.order[lo:lo + n_less] = part[less]
            self.order[lo + n_less:lo + n_less + n_same] = part[same]
            self.order[lo + n_less + n_same:hi] = part[more]
            if n_less:
                stack.append((lo, lo + n_less, depth, keys[less]))
            if lo + n_less + n_same < hi:
                stack.append((lo + n_less + n_same, hi, depth, keys[more]))
            if int(pivot) & 0xFF:
                stack.append((lo + n_less, lo + n_less + n_same, depth + 8, None))
            else:   # the terms end within these eight bytes
                self.begins.append(np.array([lo + n_less]))

    def _finish(self, lo: int, hi: int, depth: int, keys: np.ndarray | None) -> None:
        at = np.arange(lo, hi)                      # places still open, a tie after the other
        tie = np.zeros(hi - lo, dtype=np.int64)
        while len(at):
            pointers = self.order[at]
            if keys is None:
                keys = self._keys(pointers, depth)
            by = np.lexsort((keys, tie)) if tie[-1] else np.argsort(keys, kind="stable")
            pointers, keys = pointers[by], keys[by]
            self.order[at] = pointers
            begin = np.ones(len(at), dtype=bool)
            begin[1:] = (keys[1:] != keys[:-1]) | (tie[1:] != tie[:-1])
            firsts = np.flatnonzero(begin)
            sizes = np.diff(np.append(firsts, len(at)))
            done = ((keys[firsts] & np.uint64(0xFF)) == 0) | (sizes == 1)
            self.begins.append(at[firsts[done]])
            still = np.repeat(~done, sizes)
            tie = np.repeat(np.cumsum(~done), sizes)[still]
            at, keys, depth = at[still], None, depth + 8


def run_counts(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray, n_groups: int):
    """Terms of some texts: (term bytes, term offsets, run, group, count, docs).

    ``groups`` numbers each text's group; run, group, count and docs are the
    occurrences and texts of a term in a group.
    """
    data = LOWERED[data]
    starts, lengths = term_pointers(data, offsets)
    found = PointerSort(data, starts, lengths)
    order, runs = found.order, found.runs
    run = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(order))))
    doc = (np.searchsorted(offsets, starts, side="right") - 1)[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(order)))
    cells, cell = np.unique(run[heads] * n_groups + groups[doc[heads]], return_inverse=True)
    count = np.bincount(cell, weights=times, minlength=len(cells)).astype(np.int64)
    docs = np.bincount(cell, minlength=len(cells))
    of = order[runs]
    sizes = lengths[of]
    ends = np.cumsum(sizes)
    at = np.repeat(starts[of] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    return data[at], np.append(0, ends), cells // n_groups, cells % n_groups, count, docs


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string array's bytes and offsets."""
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(bounds, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _long_text(data: np.ndarray) -> Counter:
    """Term (bytes) -> occurrences in one long text, sorted in pieces that end between terms."""
    found: Counter = Counter()
    lo = 0
    while lo < len(data):
        hi = min(lo + PIECE_BYTES, len(data))
        while hi < len(data) and TERM_BYTE[data[hi]] and TERM_BYTE[data[hi - 1]]:
            hi += 1
        blob, bounds, run, _, count, _ = run_counts(data[lo:hi], np.array([0, hi - lo]), np.zeros(1, np.int64), 1)
        raw = blob.tobytes()
        for k, n in zip(run.tolist(), count.tolist()):
            found[raw[bounds[k]:bounds[k + 1]]] += n
        lo = hi
    return found


SHARD = "lang string, source string, term string, n long, docs long"


def shard_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) batches -> rows of SHARD, one per group and term of a batch."""
    names = ["lang", "source", "term", "n", "docs"]
    for batch in batches:
        if not batch.num_rows:
            continue
        langs, sources = (batch.column(n).cast(pa.string()) for n in ("lang", "source"))
        data, offsets = _buffer(batch.column("text"))
        group, firsts = pd.factorize(pd.MultiIndex.from_arrays([langs.to_pandas(), sources.to_pandas()]))
        group_lang = pa.array(firsts.get_level_values(0), pa.string())
        group_source = pa.array(firsts.get_level_values(1), pa.string())
        long = np.flatnonzero(np.diff(offsets) > PIECE_BYTES)
        for d in long:
            terms = _long_text(data[offsets[d]:offsets[d + 1]])
            blob = np.frombuffer(b"".join(terms), dtype=np.uint8)
            bounds = np.append(0, np.cumsum([len(t) for t in terms])).astype(np.int64)
            n = len(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(langs[int(d)], n), pa.repeat(sources[int(d)], n), _strings(blob, bounds),
                 pa.array(list(terms.values()), pa.int64()), pa.array(np.ones(n, np.int64))], names)
        # the texts between the long ones, together
        edges = [-1, *long.tolist(), len(langs)]
        for a, b in zip(edges[:-1], edges[1:]):
            lo, hi = offsets[a + 1], offsets[b]
            if lo >= hi:
                continue
            blob, bounds, run, cell, count, docs = run_counts(
                data[lo:hi], offsets[a + 1:b + 1] - lo, group[a + 1:b].astype(np.int64), len(firsts))
            if len(run):
                yield pa.RecordBatch.from_arrays(
                    [group_lang.take(pa.array(cell)), group_source.take(pa.array(cell)),
                     _strings(blob, bounds).take(pa.array(run)), pa.array(count), pa.array(docs.astype(np.int64))], names)


def _share(count: str, size: str) -> str:
    """SQL of 1 + floor(SCALE * (count + 2) / (size + 2 * terms)), exact at any size."""
    return (f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0)) "
            f"div cast({size} + 2 * terms as decimal(20,0)))")


def _pair_sums(key, left: pd.DataFrame, meta: pd.DataFrame) -> pd.DataFrame:
    """One chunk of a language's terms: the sum over it for every pair (a before b) of a block of sources."""
    meta = meta.sort_values("place", kind="stable")
    base = meta["p0"].to_numpy(dtype=np.int64)
    names = meta["name"].to_numpy()
    size, block = len(base), int(meta["block"].iloc[0])
    rows = range(block * SOURCE_BLOCK, min((block + 1) * SOURCE_BLOCK, size))
    sums = np.zeros((len(rows), size), dtype=np.int64)
    term, terms = pd.factorize(left["term"])
    by = np.argsort(term, kind="stable")
    term, idx, p = term[by], left["idx"].to_numpy()[by], left["p"].to_numpy(dtype=np.int64)[by]
    step = max(1, CELLS // max(size, 1))
    for t in range(0, len(terms), step):
        lo, hi = np.searchsorted(term, [t, t + step])
        dense = np.repeat(base[:, None], min(step, len(terms) - t), axis=1)
        dense[idx[lo:hi], term[lo:hi] - t] = p[lo:hi]
        for k, a in enumerate(rows):
            apart = dense[a + 1:] - dense[a]
            sums[k, a + 1:] += (apart * apart // (dense[a + 1:] + dense[a])).sum(axis=1)
    first, second = np.nonzero(np.arange(size)[None, :] > np.array(rows)[:, None])
    return pd.DataFrame({"lang": meta["of"].iloc[0], "a": names[first + rows.start], "b": names[second],
                         "value": sums[first, second]})


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    bounded_batches(docs.sparkSession)
    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = written(named.mapInArrow(shard_counts, SHARD).groupBy("lang", "source", "term")
                     .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = written(counts.withColumn("lang_docs", F.sum("docs").over(of_term))
                   .withColumn("lang_n", F.sum("n").over(of_term))
                   .where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n"), "kept-terms")

    # one row per group, with its language's figures
    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("entries"))
    langs = per_group.groupBy("lang").agg(F.sum("size").alias("lang_size"), F.sum("entries").alias("lang_entries"))
    vocab = kept.groupBy("lang").agg(F.count_distinct("term").alias("terms"))
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = written(
        named.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs"))
        .join(per_group, ["lang", "source"], "left").join(langs, "lang", "left").join(vocab, "lang", "left")
        .fillna(0, ["size", "entries", "lang_size", "lang_entries", "terms"])
        .withColumn("idx", F.row_number().over(by_source) - 1)
        .withColumn("n_sources", F.count(F.lit(1)).over(Window.partitionBy("lang"))), "groups")

    counted = (kept.join(groups.select("lang", "source", "size", "lang_size", "terms", "idx", "n_sources",
                                       "lang_entries"), ["lang", "source"])
               .withColumn("p", F.expr(_share("n", "size"))))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("lang_entries") / F.lit(CHUNK_ENTRIES))).cast("int")
    blocks = F.ceil(F.col("n_sources") / F.lit(SOURCE_BLOCK)).cast("int")
    block = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")
    left = counted.where("n_sources > 1").select("lang", F.pmod(F.xxhash64("term"), chunks).cast("int").alias("chunk"), block,
                          "term", "idx", "p")
    meta = (groups.where("n_sources > 1")
            .withColumn("p0", F.when(F.col("terms") > 0, F.expr(_share("0", "size"))).otherwise(F.lit(1).cast("long")))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .select(F.col("lang").alias("of"), F.col("source").alias("name"), F.col("idx").alias("place"), "p0",
                    F.col("chunk").alias("of_chunk"), block))
    pairs = (left.groupBy("lang", "chunk", "block").cogroup(meta.groupBy("of", "of_chunk", "block"))
             .applyInPandas(_pair_sums, "lang string, a string, b string, value long")
             .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
             .select("lang", "value", F.explode(F.array(
                 F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                 F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way"))
             .select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    apart = (counted.withColumn("q", F.expr(_share("lang_n", "lang_size"))).where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     F.expr("(p - q) * (p - q) div (p + q)").alias("value")))
    return (pairs.withColumn("rank", F.row_number().over(ranked))
            .unionByName(apart.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


OP13_SQL = """
WITH docs AS (SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     coalesce(text, '') AS text FROM documents),
tokens AS (SELECT row_no, lang, source, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
           FROM (SELECT row_no, lang, source,
                        unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs)),
vocab AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS lang_n FROM tokens GROUP BY lang, term
          HAVING count(DISTINCT row_no) >= 10),
sources AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS n FROM tokens GROUP BY lang, source, term),
grid AS (SELECT s.lang, s.source, v.term, v.lang_n, CAST(coalesce(f.n, 0) AS HUGEINT) AS n
         FROM sources s JOIN vocab v ON s.lang = v.lang
         LEFT JOIN found f ON f.lang = s.lang AND f.source = s.source AND f.term = v.term),
shares AS (SELECT lang, source, term, n,
                  1 + (1000000000 * (n + 2)) // (sum(n) OVER g + 2 * count(*) OVER g) AS p,
                  1 + (1000000000 * (lang_n + 2)) // (sum(lang_n) OVER g + 2 * count(*) OVER g) AS q
           FROM grid WINDOW g AS (PARTITION BY lang, source)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
         GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
          FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value
          FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
