"""Operator 9: SimHash near-duplicates by a binary trie self-join.

Fingerprints: XXH64 of every 4-word shingle of the whole text, and a bit is
set where more than half of the hashes have it. Texts of equal fingerprint
are one class; only distinct fingerprints are joined.

The join finds every two fingerprints at a distance of at most ``max_bits``.
The 64 bits are cut into m blocks; two fingerprints within the distance
agree in all but ``max_bits`` blocks, so for each choice of m - max_bits
blocks the fingerprints are dealt out by those bits. These keys are the top
levels of one trie per choice; below each key a pair descent over the other
bits (``trie_join``) finds the links. m grows with the number of
fingerprints, so that a key keeps few of them, and every m is exact. A key
with more than ``GROUP_CODES`` fingerprints is cut by hash into chunks, and
every two chunks meet in a group of their own. Tasks return spanning links,
never all pairs; ``components`` joins them across groups.

Defined results: a null or empty text, or one of white space, has the
fingerprint zero and is linked like any other; rows of one doc_id are rows
of their own with equal component; the component is the least non-null
doc_id (null if it has none); an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table, texts_of, written
from tidemark.llm.components import components
from tidemark.llm.groups import cut_hot_groups, whole_groups
from tidemark.llm.trie_join import linked

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCK_SHINGLES = 1 << 16   # hashes whose bits are counted at a time
KEY_CODES = 64             # fingerprints per key aimed at when m is chosen
GROUP_CODES = 50_000       # fingerprints descended together at most
BUFFER_CODES = 200_000     # fingerprints a task holds before it descends them


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The text's SimHash as an unsigned 64-bit integer."""
    words = text.encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    width = min(shingle_words, len(words))
    first = np.r_[0, ends[:-1]][:len(words) - width + 1].tolist()
    last = (ends[width - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(first), BLOCK_SHINGLES):
        hashes = np.array([digest(joined[a:b], seed) for a, b in
                           zip(first[k:k + BLOCK_SHINGLES], last[k:k + BLOCK_SHINGLES])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long of the same 64 bits."""
    @F.pandas_udf("long")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            codes = np.array([fingerprint(t, shingle_words) for t in texts_of(batch)], dtype=np.uint64)
            yield pd.Series(codes.view(np.int64))

    return compute(text)


def _blocks(n_codes: int, max_bits: int) -> list[tuple[int, ...]]:
    """Bit widths of the blocks: as few as leave about KEY_CODES codes a key."""
    m = max_bits + 1
    while m < 2 * max_bits + 1 and n_codes > KEY_CODES * 2.0 ** (64 * (m - max_bits) / m):
        m += 1
    edges = [round(64 * i / m) for i in range(m + 1)]
    return [(edges[i], edges[i + 1]) for i in range(m)]


def _take_bits(codes: np.ndarray, blocks) -> np.ndarray:
    """The given bit ranges of the codes, one after the other."""
    out = np.zeros_like(codes)
    for low, high in blocks:
        out = (out << np.uint64(high - low)) | ((codes >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1))
    return out


def links(codes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Spanning links (u, v) between distinct codes (column ``code``, long)
    that differ in at most ``max_bits`` bits."""
    codes = codes.select("code")
    blocks = _blocks(codes.count(), max_bits)
    choices = list(itertools.combinations(range(len(blocks)), len(blocks) - max_bits))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = batch["code"].to_numpy(np.int64).view(np.uint64)
            for choice, kept in enumerate(choices):
                key = _take_bits(raw, [blocks[i] for i in kept])
                yield pd.DataFrame({"choice": np.int32(choice), "key": key.view(np.int64),
                                    "code": raw.view(np.int64)})

    dealt = codes.mapInPandas(deal, "choice int, key long, code long")
    dealt = cut_hot_groups(dealt, ["choice", "key"], "code", GROUP_CODES)
    rest = [[b for i, b in enumerate(blocks) if i not in kept] for kept in choices]
    low_bits = [sum(high - low for low, high in r) for r in rest]

    def spanning(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Links of whole groups, choice by choice."""
        for choice, part in frame.groupby("choice", sort=False):
            raw = part["code"].to_numpy(np.int64).view(np.uint64)
            code = _take_bits(raw, rest[choice])
            group = pd.MultiIndex.from_frame(part[["key", "chunks"]]).factorize()[0]
            order = np.lexsort((code, group))
            raw, code, group = raw[order], code[order], group[order]
            root = linked(code, group, max_bits, low_bits[choice])
            tied = root != np.arange(len(root))
            yield pd.DataFrame({"u": raw[tied].view(np.int64), "v": raw[root[tied]].view(np.int64)})

    return (dealt.repartition("choice", "key", "chunks").sortWithinPartitions("choice", "key", "chunks")
            .mapInPandas(whole_groups(["choice", "key", "chunks"], spanning, BUFFER_CODES), "u long, v long"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id reachable over links."""
    bounded_batches(docs.sparkSession)
    prints = written(docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                                 fingerprint_column(F.col(f"`{text_col}`"), shingle_words).alias("code")), "simhash")
    rooted = _rooted(prints, max_bits)
    smallest = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    member = written(rooted.join(smallest, "root").select("code", "component_id"), "simhash-members")
    return (prints.join(member, "code")
            .select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"))


def _rooted(prints: DataFrame, max_bits: int) -> DataFrame:
    """(code, least, root) of each distinct code of ``prints`` (doc_id, code):
    its smallest doc_id, and a code that names its component."""
    classes = written(prints.groupBy("code").agg(F.min("doc_id").alias("least")), "simhash-classes")
    found = components(written(links(classes, max_bits), "simhash-links"))
    return written(classes.join(found.withColumnRenamed("node", "code"), "code", "left")
                   .withColumn("root", F.coalesce("root", "code")), "simhash-roots")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest id, rows
    without one last, and among equal ids of the least hash of the whole row."""
    bounded_batches(docs.sparkSession)
    # 128 bits of all values and of which are null, as hashes pass over nulls
    values = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    hashes = [F.xxhash64(*values).alias("h1"), F.xxhash64(F.lit(1), *values).alias("h2")]
    prints = written(docs.select(F.col(f"`{id_col}`").alias("doc_id"), *hashes,
                                 fingerprint_column(F.col(f"`{text_col}`"), shingle_words).alias("code")), "simhash")
    roots = _rooted(prints, max_bits).select("code", "root")
    # rows of the same values, so of one root, are counted first
    rows = written(prints.groupBy("doc_id", "h1", "h2", "code").agg(F.count(F.lit(1)).alias("n")), "simhash-rows")
    keep = written(rows.join(roots, "code").groupBy("root")
                   .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h1", "h2", "n")).alias("best"))
                   .select("best.h1", "best.h2", "best.n"), "simhash-keep")
    kept = docs.select(F.struct("*").alias("row"), *hashes).join(keep.select("h1", "h2"), ["h1", "h2"], "left_semi")
    if keep.where("n > 1").head() is not None:
        kept = kept.dropDuplicates(["h1", "h2"])
    return kept.select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
