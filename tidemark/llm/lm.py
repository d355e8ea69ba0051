"""Operator 7: language-model scoring with an Elias-Fano n-gram trie.

Tokens are the words of a text (ASCII letters in lower case) and one end. The
model is an interpolated trigram over training counts c:

    p1(w)      = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p2(w | v)  = (c(vw) - D) / c(v) [kept vw] + g(v) p1(w)
    p3(w | uv) = (c(uvw) - D) / c(uv) [kept uvw] + g(uv) p2(w | v)

g(.) is the mass that the kept successors leave, so every context's
probabilities sum to one, unknown words together counting as one. All counts
are taken over the whole corpus by Spark; kept are words and n-grams with a
count of at least ``MIN_COUNT``, the same at every size. All other words,
however many, keep their exact counts: they are joined to the documents by Spark.

The trie has three levels. A word's number is the rank of its 64-bit hash, so
no task holds the words themselves (two words of one hash, of odds below 1e-4
at 1e8 words, would count as one). A node of level 2 is the position of its
pair. Level 2 holds for each word its successors, level 3 for each pair uv its
successors w, given by the position of vw among the successors of v rather
than by w. A level is an Elias-Fano sequence: successors are shifted by the
start of their context's range, so the whole level ascends. Starts are monotone
pointers, Elias-Fano too. To look a word up is a successor search in the
context's range.

All levels are cut into shards: ranges of word hashes, of first words and of
pairs, with about ``SHARD_GRAMS`` words or n-grams each. Spark tasks build them,
each from the rows of its range; the driver gathers totals, cuts and names only.
Probabilities and weights of contexts are quantised to 256 values a shard.
Each shard is a file that Spark ships to the executors; workers map the files
into memory and send every look-up to its shard.

Defined results: a null text counts as empty and is one end; a null id is not
held out; repeated rows count and are scored each; without training rows N
and V are 0.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, crc_remainder, shared_path, table, texts_of, written
from tidemark.llm.eliasfano import EliasFano

WORD_SHARE = 0.0      # least share of all training tokens of words in the trie: no cut but MIN_COUNT
SHARE = 0.0           # and of n-grams of two and three words
MIN_COUNT = 2
SHARD_GRAMS = 2_000_000   # n-grams (or words) of a shard, about
DISCOUNT = 0.75
LEVELS = 256
FLUSH_WORDS = 1_500_000   # words that a task counts together, about
FLUSH_TOKENS = 2_000_000  # tokens whose n-grams a counting task holds
BUCKET_TOKENS = 1_000_000  # training tokens for each bucket of n-grams, which a task sums up together
SCORE_TOKENS = 500_000    # tokens scored together, about
CHARS_A_TOKEN = 6         # which is how much text holds so many tokens, about


def words_of(texts: list[str]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(each token's place among the distinct words, these, tokens of each text).
    Letters are lower-cased and words split in ASCII only; every text has an end."""
    low = pc.ascii_trim_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    # a space behind the last word leaves an empty string there, which is the end
    space, none = (pa.scalar(t, pa.large_string()) for t in (" ", ""))
    ended = pc.if_else(pc.equal(low, none), low, pc.binary_join_element_wise(low, space, none))
    words = pc.ascii_split_whitespace(ended)
    coded = words.flatten().dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.diff(words.offsets.to_numpy())


def _together(texts: Iterable[str], tokens: int) -> Iterator[list[str]]:
    """Consecutive whole texts of about so many tokens in all."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text) + 1
        if n >= tokens * CHARS_A_TOKEN:
            yield held
            held, n = [], 0
    if held:
        yield held


# ------------------------------------------------------------------ file
def file_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """The arrays one after the other, 64-byte aligned, behind a JSON header."""
    header, at = {}, 0
    for name, a in arrays.items():
        header[name] = [at, a.dtype.str, list(a.shape)]
        at += -(-a.nbytes // 64) * 64
    head = json.dumps(header).encode()
    head += b" " * (-(len(head) + 8) % 64)
    return b"".join([len(head).to_bytes(8, "little"), head,
                     *(a.tobytes() + b"\0" * (-a.nbytes % 64) for a in arrays.values())])


def map_file(path: str) -> dict[str, np.ndarray]:
    with open(path, "rb") as f:
        size = int.from_bytes(f.read(8), "little")
        header = json.loads(f.read(size))
    data = np.asarray(np.memmap(path, dtype=np.uint8, mode="r", offset=0))  # plain views are quicker
    out = {}
    for name, (at, dtype, shape) in header.items():
        n = int(np.prod(shape)) * np.dtype(dtype).itemsize
        out[name] = data[8 + size + at:8 + size + at + n].view(dtype).reshape(shape)
    return out


# ------------------------------------------------------------------ trie
def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, code book) of least squared error: values belong to the nearest
    entry and an entry is the mean of its values, repeated from a start with
    half of the entries evenly spaced and half at quantiles."""
    if not len(values):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.float32)
    ordered = np.sort(values)
    sums = np.concatenate([[0.0], np.cumsum(ordered)])
    book = np.unique(np.concatenate([np.linspace(ordered[0], ordered[-1], LEVELS // 2),
                                     np.quantile(ordered, np.linspace(0, 1, LEVELS // 2))]))
    for _ in range(25):
        edge = np.concatenate([[0], np.searchsorted(ordered, (book[1:] + book[:-1]) / 2), [len(ordered)]])
        used = np.diff(edge) > 0
        book = (np.diff(sums[edge])[used] / np.diff(edge)[used])
    codes = np.searchsorted((book[1:] + book[:-1]) / 2, values).astype(np.uint8)
    return codes, book.astype(np.float32)


def _with_codes(arrays: dict[str, np.ndarray], **values: np.ndarray) -> dict[str, np.ndarray]:
    for name, v in values.items():
        arrays[f"{name}.code"], arrays[f"{name}.book"] = quantised(np.log10(np.maximum(v, 1e-12)))
    return arrays


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes, signed."""
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False).view(np.int64)


def word_shard_of(hashes: np.ndarray, n_shards: int) -> np.ndarray:
    """Shards of equal ranges of hashes, in their order."""
    high = (hashes.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)
    return (high * np.uint64(n_shards) >> np.uint64(32)).astype(np.int32)


def word_shard(shard: int, hashes: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    return {"shard": np.array([shard]), "hashes": hashes, "n": counts.astype(np.min_scalar_type(counts.max()))}


def pair_shard(trie: Trie, low: int, high: int, pairs: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Level 2 of the first words ``low`` to ``high``; ``pairs``: u * F + v ascending."""
    size = trie.size
    first, last = pairs // size - low, pairs % size
    taken = (counts - DISCOUNT) / trie.counts(np.arange(low, high))[first]
    left1 = 1 - np.bincount(first, taken, minlength=high - low)
    p2 = taken + left1[first] * 10 ** trie.log_p1(last)
    starts = np.searchsorted(first, np.arange(high - low + 1))
    del first, last, taken
    out = {"range": np.array([low, high, len(pairs)]), "n": counts.astype(np.min_scalar_type(counts.max()))}
    out |= EliasFano.build(pairs - low * size, (high - low) * size).arrays("level")
    out |= EliasFano.build(starts, len(pairs) + 1).arrays("starts")
    return _with_codes(out, p=p2, left=left1)


def triple_shard(trie: Trie, low: int, high: int, triples: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Level 3 of the pairs at nodes ``low`` to ``high``; ``triples``: node of uv * F + w
    ascending, vw among the pairs."""
    at_pair = triples // trie.size - low
    last, pair_counts = trie.pairs_at(np.arange(low, high))
    # each pair's range is as long as its second word's successors
    ranges = np.concatenate([[0], np.cumsum(trie.starts2(last, 1) - trie.starts2(last))])
    values, p3 = np.zeros(len(triples), dtype=np.int64), np.zeros(len(triples))
    for at in range(0, len(triples), SCORE_TOKENS):  # look-ups in blocks, which bounds their memory
        block = slice(at, at + SCORE_TOKENS)
        second = last[at_pair[block]]
        back = trie.pair_nodes(second, triples[block] % trie.size)                  # position of vw
        values[block] = ranges[at_pair[block]] + (back - trie.starts2(second))      # among the successors of v
        p3[block] = 10 ** trie.value2("p", back)
    taken = (counts - DISCOUNT) / pair_counts[at_pair]
    left2 = 1 - np.bincount(at_pair, taken, minlength=high - low)
    p3 *= left2[at_pair]
    p3 += taken
    del at_pair, taken, last, pair_counts
    order = np.argsort(values, kind="stable")
    values, p3 = values[order], p3[order]
    del order
    out = {"range": np.array([low, high, len(triples)])}
    out |= EliasFano.build(values, int(ranges[-1]) + 1).arrays("level")
    out |= EliasFano.build(ranges, int(ranges[-1]) + 1).arrays("starts")
    del values, ranges
    return _with_codes(out, p=p3, left=left2)


class Shard:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.low, self.high, self.n = (int(v) for v in arrays["range"])
        self.level, self.starts = EliasFano.of(arrays, "level"), EliasFano.of(arrays, "starts")
        self.counts = arrays.get("n")
        self.codes = {n: (arrays[f"{n}.code"], np.asarray(arrays[f"{n}.book"], dtype=np.float64))
                      for n in ("p", "left")}

    def value(self, name: str, at: np.ndarray) -> np.ndarray:
        code, book = self.codes[name]
        return book[code[at]]


def _parts(edges: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(k, places of the keys from edges[k] to below edges[k + 1], by key)."""
    order = np.arange(len(keys)) if (keys[1:] >= keys[:-1]).all() else np.argsort(keys)
    cuts = np.searchsorted(keys[order], edges)
    for k in np.flatnonzero(np.diff(cuts)):
        yield int(k), order[cuts[k]:cuts[k + 1]]


class Trie:
    """The shards of words and of levels 2 and 3 there are so far. Ranges
    without n-grams have no shard: nothing is found and all mass is left there."""

    def __init__(self, words: list[dict], shards2: list[dict], shards3: list[dict], n_tokens: int, n_types: int):
        words = sorted(words, key=lambda w: int(w["shard"][0]))
        self.words = [(w["hashes"], w["n"]) for w in words]
        self.firsts = np.array([h[0] for h, _ in self.words], dtype=np.int64)
        self.bases = np.cumsum([0, *(len(h) for h, _ in self.words)])  # first word's number of each shard
        self.size = int(self.bases[-1])
        self.log_unit = float(np.log10(n_tokens + 0.5 * (n_types + 1)))
        self.two, self.three = (sorted(map(Shard, shards), key=lambda s: s.low) for shards in (shards2, shards3))
        self.nodes = np.cumsum([0, *(s.n for s in self.two)])  # first node of each shard

    def counts(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), dtype=np.int64)
        for k, at in _parts(self.bases, words):
            out[at] = self.words[k][1][words[at] - self.bases[k]]
        return out

    def log_p1(self, words: np.ndarray) -> np.ndarray:
        return np.log10(self.counts(words) + 0.5) - self.log_unit

    def _by_range(self, shards: list[Shard], keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(shard's place, places of the keys in its range)."""
        if not shards:
            return
        for k, at in _parts(np.array([*(s.low for s in shards), shards[-1].high]), keys):
            yield k, at[keys[at] < shards[k].high]

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Trie numbers of words (-1: not in the trie)."""
        out = np.full(len(words), -1)
        wanted = word_hashes(words)
        order = np.argsort(wanted)
        cuts = np.append(np.searchsorted(wanted[order], self.firsts), len(order))
        for k, (hashes, _) in enumerate(self.words):
            at = order[cuts[k]:cuts[k + 1]]
            found = np.minimum(np.searchsorted(hashes, wanted[at]), len(hashes) - 1)
            out[at] = np.where(hashes[found] == wanted[at], found + self.bases[k], -1)
        return out

    def pair_nodes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Level-2 nodes of word pairs (-1: none, or a word not in the trie)."""
        out = np.full(len(first), -1)
        places, nodes = self.kept_pairs(first, last)
        out[places] = nodes
        return out

    def kept_pairs(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the kept pairs, their nodes), by node. Pairs are looked up in
        ascending order, so the look-ups go through the mapped files once."""
        known = np.flatnonzero((first >= 0) & (last >= 0))
        known = known[np.argsort(first[known] * self.size + last[known])]
        places, nodes = [known[:0]], [known[:0]]
        for k, at in self._by_range(self.two, first[known]):
            at = known[at]
            found = self.two[k].level.find((first[at] - self.two[k].low) * self.size + last[at])
            places.append(at[found >= 0])
            nodes.append(found[found >= 0] + self.nodes[k])
        return np.concatenate(places), np.concatenate(nodes)

    def pairs_at(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Second words and counts of the pairs at the nodes."""
        last, counts = np.zeros(len(nodes), dtype=np.int64), np.zeros(len(nodes), dtype=np.int64)
        for k, at in _parts(self.nodes, nodes):
            inside = nodes[at] - self.nodes[k]
            last[at] = self.two[k].level[inside] % self.size
            counts[at] = self.two[k].counts[inside]
        return last, counts

    def starts2(self, words: np.ndarray, after: int = 0) -> np.ndarray:
        """First nodes of the words' successors (``after`` 1: first nodes after them)."""
        out = np.zeros(len(words), dtype=np.int64)
        for k, at in self._by_range(self.two, words):
            out[at] = self.two[k].starts[words[at] - self.two[k].low + after] + self.nodes[k]
        return out

    def value2(self, name: str, nodes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(nodes))
        for k, at in _parts(self.nodes, nodes):
            out[at] = self.two[k].value(name, nodes[at] - self.nodes[k])
        return out

    def left(self, shards: list[Shard], contexts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(contexts))
        for k, at in self._by_range(shards, contexts):
            out[at] = shards[k].value("left", contexts[at] - shards[k].low)
        return out

    def triple_values(self, pair: np.ndarray, relative: np.ndarray) -> np.ndarray:
        """log10 of p3 (NaN: not kept) from the nodes of uv and the places of vw among v's successors."""
        out = np.full(len(pair), np.nan)
        for k, at in self._by_range(self.three, pair):
            shard = self.three[k]
            found = shard.level.find(shard.starts[pair[at] - shard.low] + relative[at])
            out[at[found >= 0]] = shard.value("p", found[found >= 0])
        return out

    def log_probs(self, numbers: np.ndarray, word: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of p1 of each token, and of its probability given the two before it
        in its text. ``numbers``: of the distinct words, ``word``: each token's place
        among them, ``place``: its position in the text. A word not in the trie is
        without its own p1, which is added where its count is known."""
        known = numbers >= 0
        p1, left, starts = np.zeros(len(numbers)), np.zeros(len(numbers)), np.zeros(len(numbers), dtype=np.int64)
        p1[known], left[known] = self.log_p1(numbers[known]), self.left(self.two, numbers[known])
        starts[known] = self.starts2(numbers[known])
        tokens, alone = numbers[word], p1[word]
        out = alone.copy()
        out[1:] += np.where(place[1:] > 0, left[word[:-1]], 0.0)
        first = np.where(place[1:] > 0, tokens[:-1], -1)
        at, node = self.kept_pairs(first, tokens[1:])
        out[at + 1] = self.value2("p", node)
        nodes = np.full(len(tokens), -1)
        nodes[at + 1] = node
        third = at + 2
        inside = np.flatnonzero(third < len(tokens))
        inside = inside[place[third[inside]] > 1]
        third, node = third[inside], node[inside]              # by node, as the pairs are
        out[third] += self.left(self.three, node)
        both = np.flatnonzero(nodes[third] >= 0)
        third, node = third[both], node[both]
        triple = self.triple_values(node, nodes[third] - starts[word[third - 1]])
        found = np.flatnonzero(~np.isnan(triple))
        out[third[found]] = triple[found]
        return alone, out


#: Names of the shards of words, level 2 and level 3; tokens and different words in all.
Files = tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...], int, int]


@functools.lru_cache(maxsize=1)
def _mapped(files: Files) -> Trie:
    return Trie(*([map_file(SparkFiles.get(name)) for name in names] for names in files[:3]), *files[3:])


def _shipped(contents: DataFrame) -> tuple[str, ...]:
    """Writes each row's ``content`` as a file to the shared folder and has Spark hand
    the files to every executor, present and later ones; their names there."""
    spark = contents.sparkSession
    path = shared_path(spark, "lm-trie")
    # bytes as they are, and a line end
    contents.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(path)
    files = [r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .where("length > 0").select("path").collect()]
    for file in files:
        spark.sparkContext.addFile(file)
    return tuple(sorted(file.rsplit("/", 1)[-1] for file in files))


def _edges(grams: DataFrame, size: int, n_contexts: int) -> np.ndarray:
    """Ranges of contexts (key / size) with about SHARD_GRAMS n-grams, and at most
    as many contexts, each."""
    n = grams.count()
    n_shards = n // SHARD_GRAMS + 1
    cuts = []
    if n_shards > 1:
        at = [i / n_shards for i in range(1, n_shards)]
        cuts = [k // size for k in grams.agg(F.percentile_approx("key", at, 100 * n_shards)).head()[0]]
    return np.unique([0, *cuts, *range(0, n_contexts, SHARD_GRAMS), n_contexts]).astype(np.int64)


def _level(grams: DataFrame, files: Files, size: int, n_contexts: int, build) -> tuple[str, ...]:
    """Builds a level's shards in tasks, ships them and returns their names."""
    edges = _edges(grams, size, n_contexts)

    @F.pandas_udf("int")
    def shard_of(keys: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(edges, keys.to_numpy() // size, side="right") - 1).astype(np.int32))

    def content(shard: int, part: pd.DataFrame) -> dict[str, np.ndarray]:
        return build(_mapped(files), int(edges[shard]), int(edges[shard + 1]),
                     *(part[c].to_numpy(np.int64) for c in ("key", "n")))

    return _shipped(_sharded(grams.withColumn("shard", shard_of("key")), "key", content))


def _sharded(rows: DataFrame, key: str, content) -> DataFrame:
    """A file's bytes for each ``shard``, from ``content(shard, its rows by key)``."""
    def files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, current = [], None

        def file() -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            held.clear()
            return pd.DataFrame({"content": [file_bytes(content(current, rows))]})

        for batch in batches:
            for shard, part in batch.groupby("shard"):
                if held and shard != current:
                    yield file()
                current = int(shard)
                held.append(part)
        if held:
            yield file()

    return rows.repartition("shard").sortWithinPartitions("shard", key).mapInPandas(files, "content binary")


def _word_level(frequent: DataFrame, n_words: int) -> tuple[str, ...]:
    """Builds the words' shards in tasks, ships them and returns their names."""
    n_shards = n_words // SHARD_GRAMS + 1

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = word_hashes(pa.array(batch["word"], pa.large_string()))
            yield pd.DataFrame({"hash": hashes, "n": batch["n"], "shard": word_shard_of(hashes, n_shards)})

    def content(shard: int, part: pd.DataFrame) -> dict[str, np.ndarray]:
        return word_shard(shard, part["hash"].to_numpy(np.int64), part["n"].to_numpy(np.int64))

    rows = frequent.select("word", "n").mapInPandas(hashed, "hash long, n long, shard int")
    return _shipped(_sharded(rows, "hash", content))


# ------------------------------------------------------------------ counting
def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for texts in _together((t for batch in batches for t in texts_of(batch["text"])), FLUSH_WORDS):
        at, words, _ = words_of(texts)
        yield pd.DataFrame({"word": words.to_numpy(zero_copy_only=False), "n": np.bincount(at)})


def packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers as all their first bytes, then all second ones and so on: of
    ascending or small numbers most bytes are alike, which Spark's compression sees."""
    return numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(content: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(content, dtype=np.uint8).reshape(8, -1).T).view("<i8").ravel()


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets by the high bits of a product, so that a word's n-grams are dealt over all."""
    high = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    return (high * np.uint64(n_buckets) >> np.uint64(32)).astype(np.min_scalar_type(n_buckets))


def _count_grams(files: Files, order: int, n_buckets: int):
    """A task's n-grams of trie words with their counts, one row for each bucket of
    them. Order 3: of kept pairs, numbered by the first pair's node."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = _mapped(files)
        held, n = [], 0

        def flush():
            keys, many = np.unique(np.concatenate(held), return_counts=True)
            buckets = bucket_of(keys, n_buckets)
            by_bucket = np.argsort(buckets, kind="stable")
            cuts = np.searchsorted(buckets[by_bucket], np.arange(n_buckets + 1))
            some = np.flatnonzero(np.diff(cuts))
            at = [by_bucket[cuts[b]:cuts[b + 1]] for b in some]
            return pd.DataFrame({"bucket": some, "keys": [packed(keys[a]) for a in at],
                                 "many": [packed(many[a]) for a in at]})

        def keys_of(tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
            inner = place[1:] > 0
            u, v = np.where(inner, tokens[:-1], -1), tokens[1:]
            if order == 2:
                ok = (u >= 0) & (v >= 0)
                return u[ok] * trie.size + v[ok]
            pair = trie.pair_nodes(u, v)
            ok = (pair[:-1] >= 0) & (pair[1:] >= 0)
            return pair[:-1][ok] * trie.size + tokens[2:][ok]

        for batch in batches:
            for numbers, word, place, _ in _token_blocks(trie, texts_of(batch["text"])):
                held.append(keys_of(numbers[word], place))
                n += len(held[-1])
                if n >= FLUSH_TOKENS:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return run


def _grams(texts: DataFrame, files: Files, order: int, least: int) -> DataFrame:
    """key, n: the n-grams of all texts that occur ``least`` times. They are hashed to
    buckets, whose number follows the tokens of all texts, and summed up a bucket at a
    time, so neither a row nor a task is needed for each and none holds many."""
    n_buckets = files[3] // BUCKET_TOKENS + 1

    def summed(bucket: pd.DataFrame) -> pd.DataFrame:
        keys, many = (np.concatenate([unpacked(c) for c in bucket[name]]) for name in ("keys", "many"))
        by_key = np.argsort(keys)
        keys = keys[by_key]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.add.reduceat(many[by_key], first)
        return pd.DataFrame({"key": keys[first][n >= least], "n": n[n >= least]})

    return written(texts.mapInPandas(_count_grams(files, order, n_buckets), "bucket long, keys binary, many binary")
                   .groupBy("bucket").applyInPandas(summed, "key long, n long"), f"lm-grams{order}")


def _token_blocks(trie: Trie, texts: list[str], rare: list[list[dict]] | None = None):
    """(numbers of distinct words, each token's place among them, its place in the text,
    its text's number) of about SCORE_TOKENS tokens; texts stay whole. ``rare`` gets each
    text's words that are not in the trie, and how often."""
    first = 0
    for block in _together(texts, SCORE_TOKENS):
        at, words, sizes = words_of(block)
        numbers = trie.numbers(words)
        owner = np.repeat(np.arange(len(block)), sizes)
        if rare is not None:
            unknown = np.flatnonzero(numbers[at] < 0)
            keys, times = np.unique(owner[unknown] * len(words) + at[unknown], return_counts=True)
            found = words.take(pa.array(keys % len(words))).to_pylist()
            own: list[list[dict]] = [[] for _ in block]
            for i, word, n in zip((keys // len(words)).tolist(), found, times.tolist()):
                own[i].append({"word": word, "times": n})
            rare.extend(own)
        yield numbers, at, np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes), owner + first
        first += len(block)


@dataclass
class Model:
    files: Files         # the trie's names among the shipped files
    vocabulary: DataFrame  # word, n: exact training counts of all words
    n_tokens: int
    n_types: int


def train(docs: DataFrame, *, text_col: str = "text", word_share: float = WORD_SHARE,
          share: float = SHARE) -> Model:
    """Counts every text of ``docs`` and builds the trie."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(text_col).alias("text"))
    vocabulary = written(texts.mapInPandas(_count_words, "word string, n long")
                         .groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    totals = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).head()
    n_tokens, n_types = totals["n"] or 0, totals["v"] or 0
    frequent = vocabulary.where(F.col("n") >= max(MIN_COUNT, word_share * n_tokens))
    n_words = frequent.count()
    size, least = max(1, n_words), max(MIN_COUNT, int(np.ceil(share * n_tokens)))
    files: Files = (_word_level(frequent, n_words), (), (), n_tokens, n_types)
    for order, build in ((2, pair_shard), (3, triple_shard)):
        grams = _grams(texts, files, order, least)
        n_contexts = n_words if order == 2 else n_pairs
        names = _level(grams, files, size, n_contexts, build)
        n_pairs = grams.count()
        files = (*files[:order - 1], names, *files[order:])
    return Model(files, vocabulary, n_tokens, n_types)


# ------------------------------------------------------------------ scoring
def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, base_score, score."""
    bounded_batches(docs.sparkSession)
    files = model.files

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = _mapped(files)
        for batch in batches:
            texts, rare = texts_of(batch["text"]), []
            out = {k: np.zeros(len(texts)) for k in ("tokens", "known", "base", "score")}
            for numbers, word, place, owner in _token_blocks(trie, texts, rare):
                total = functools.partial(np.bincount, owner, minlength=len(texts))
                alone, given = trie.log_probs(numbers, word, place)
                out["tokens"] += total()
                out["known"] += total((numbers >= 0)[word])
                out["base"] += total(alone)
                out["score"] += total(given)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_tokens": out["tokens"].astype(np.int64),
                "n_known": out["known"].astype(np.int64), "base_score": out["base"], "score": out["score"],
                "rare": rare})

    scored = written(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .mapInPandas(look_up, "doc_id long, n_tokens long, n_known long, base_score double, score double, "
                              "rare array<struct<word:string,times:long>>")
        .withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    unit = F.lit(float(np.log10(model.n_tokens + 0.5 * (model.n_types + 1))))
    rare = (scored.select("row", F.explode("rare").alias("of")).select("row", "of.word", "of.times")
            .join(model.vocabulary, "word")
            .groupBy("row").agg(F.sum("times").alias("rare_known"),
                                F.sum(F.col("times") * (F.log10(F.col("n") + 0.5) - unit)).alias("rare_score")))
    unknown = F.col("n_tokens") - F.col("n_known") - F.coalesce("rare_known", F.lit(0))
    rest = F.coalesce("rare_score", F.lit(0.0)) + unknown * (F.log10(F.lit(0.5)) - unit)
    return (scored.drop("rare").join(rare, "row", "left")
            .select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                    (F.col("base_score") + rest).alias("base_score"), (F.col("score") + rest).alias("score")))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_remainder(F.col("doc_id"), 5) == 1, F.lit(False))
    model = train(docs.where(~held_out))
    return (score(docs, model)
            .select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                    F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score"))
