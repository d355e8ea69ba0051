"""Operator 8: document fingerprints by a randomised edit embedding.

A text is walked from its first character. At step j the current character
is put out, and a random function shared by all texts, drawn for step j,
says for that character whether the walk moves on or stays. Two walks that
part at an edit meet again soon, so texts at a small edit distance get
embeddings at a small Hamming distance. A walk ends when the text is used
up, after about two steps per character; the whole text takes part.

The fingerprint samples the embedding at ``SAMPLES`` positions and keeps 4
hashed bits of each character, one hexadecimal digit. The position of a
sample is the one of the least random number among all positions the walk
has, so it is uniform over the whole embedding, equal for equal texts and,
for texts of lengths m < n, equal with probability m / n. ``likeness`` is the
share of equal digits, corrected for digits equal by chance.

``near_texts`` finds close documents: bands of sampled digits give candidate
links, which are verified by likeness of the whole fingerprints. The query
joins their components to its rows. The digits of a band follow the number of
distinct fingerprints, so that unrelated texts share few bands at any size, and
the number of bands follows its digits, so that texts of likeness ``NEAR`` share
one with a probability of ``CAUGHT`` or more.

Tables hold a fingerprint as 64 bytes, two digits each; rows show it in hex.

Walks of a batch run side by side in numpy, texts of similar length together;
the few longest ones are finished one by one.

Defined results: a null text counts as empty; the empty text's fingerprint is
all zeros; repeated ids are put in order by text; a single document is its
own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table, written
from tidemark.llm.components import components
from tidemark.llm.groups import cut_hot_groups, whole_groups
from tidemark.llm.trie_join import joined

SAMPLES = 128
LANES = 1024          # walks advanced together
FEW_LANES = 48        # below this walks are finished one by one
BLOCK_STEPS = 64
CHANCE = 0.15          # unrelated texts' share of equal digits (letters are not uniform; measured)
CANDIDATES = 2         # unrelated texts that a text may share a band with, about
CAUGHT = 0.998         # probability that texts of likeness NEAR share a band
LEAST_DIGITS = 6       # sampled digits of a band, at least
GROUP_TEXTS = 2000     # fingerprints of one band compared together at most
BUFFER_TEXTS = 20_000
NEAR = 0.8            # likeness at which two texts are linked
CHARS_PER_BUCKET = 8_000_000
MOST_BUCKETS = 20_000
MOST_STEPS = 1 << 42
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=np.uint64) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def _sample_positions() -> list[np.ndarray]:
    """For every sample the positions at which a new least number appears when
    positions get independent uniform numbers: the gap to the next one is
    geometric, with the least number so far as its probability."""
    out = []
    for sample in range(SAMPLES):
        rnd = np.random.default_rng([8, sample])
        at, least, places = 0, rnd.random(), [0]
        while at < MOST_STEPS:
            at += int(np.ceil(np.log(1 - rnd.random()) / np.log1p(-least))) if least > 1e-15 else MOST_STEPS
            least *= rnd.random()
            places.append(max(at, places[-1] + 1))
        out.append(np.array(places, dtype=np.int64))
    return out


POSITIONS = _sample_positions()
ALL_POSITIONS = np.unique(np.concatenate(POSITIONS))
_ROWS = [np.searchsorted(ALL_POSITIONS, p) for p in POSITIONS]
_DIGIT = (_mix(np.arange(SAMPLES) + 1000) | np.uint64(1)).astype(np.uint32)  # per sample


def _turns(start: int, count: int) -> np.ndarray:
    """The odd multipliers of steps start, start + 1, ...: the top bit of
    character hash times multiplier is the step's move."""
    return (_mix(np.arange(start, start + count, dtype=np.uint64) + np.uint64(1 << 20)) >> np.uint64(32)
            ).astype(np.uint32) | np.uint32(1)


def _characters(text: str) -> np.ndarray:
    """Non-zero 32-bit hashes of the characters, and 0 as the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.append((_mix(points + np.uint64(77)) >> np.uint64(31)).astype(np.uint32) | np.uint32(1), np.uint32(0))


def _walk_alone(chars: list[int], at: int, step: int, stop: int | None, seen: dict[int, int]) -> tuple[int, int]:
    """Walks from (at, step) to the end of the text, or to step ``stop``; notes
    the characters at sampled positions. Returns place and step reached."""
    row = int(np.searchsorted(ALL_POSITIONS, step))
    while chars[at] and (stop is None or step < stop):
        turns = _turns(step, BLOCK_STEPS * 64 if stop is None else stop - step).tolist()
        for turn in turns:
            c = chars[at]
            if not c:
                break
            if ALL_POSITIONS[row] == step:
                seen[row] = c
                row += 1
            at += (c * turn & 0xFFFFFFFF) >> 31
            step += 1
    return at, step


def _digits(steps: np.ndarray, seen) -> np.ndarray:
    """(texts, SAMPLES) digits; ``seen(rows, texts)``: noted characters."""
    out = np.zeros((len(steps), SAMPLES), dtype=np.uint8)
    lane = np.arange(len(steps))
    for k in range(SAMPLES):
        last = np.maximum(np.searchsorted(POSITIONS[k], steps, side="left") - 1, 0)
        out[:, k] = (seen(_ROWS[k][last], lane) * _DIGIT[k]) >> np.uint32(28)
    out[steps == 0] = 0
    return out


def _walk_together(texts: list[np.ndarray]) -> np.ndarray:
    """Digits of texts of similar length (character hashes with their end)."""
    sizes = np.array([len(t) for t in texts])
    x = np.concatenate(texts)
    begin = np.cumsum(sizes) - sizes
    n = len(texts)
    most = int(np.searchsorted(ALL_POSITIONS, 3 * sizes.max() + 64 * BLOCK_STEPS))
    noted = np.zeros((min(most, len(ALL_POSITIONS)), n), dtype=np.uint32)
    steps = np.zeros(n, dtype=np.int64)
    lanes = np.flatnonzero(sizes > 1)
    at = begin[lanes].copy()
    step, row = 0, 0
    while len(lanes) > FEW_LANES:
        before = at.copy()
        for turn in _turns(step, BLOCK_STEPS):
            c = x[at]
            if ALL_POSITIONS[row] == step:
                noted[row, lanes] = c
                row += 1
            at += (c * turn) >> np.uint32(31)  # the end's hash is 0: the walk stays there
            step += 1
        ended = x[at] == 0
        for k in np.flatnonzero(ended):  # when exactly: the block again
            lane = lanes[k]
            rest = x[before[k]:begin[lane] + sizes[lane]].tolist()
            _, steps[lane] = _walk_alone(rest, 0, step - BLOCK_STEPS, step, {})
        lanes, at = lanes[~ended], at[~ended]
    later: dict[int, dict[int, int]] = {}
    for lane, place in zip(lanes, at):
        chars = x[place:begin[lane] + sizes[lane]].tolist()
        later[lane] = {}
        _, steps[lane] = _walk_alone(chars, 0, step, None, later[lane])
    if later:
        rows = max((max(d) for d in later.values() if d), default=-1)
        if rows >= len(noted):
            noted = np.vstack([noted, np.zeros((rows + 1 - len(noted), n), dtype=np.uint32)])
        for lane, found in later.items():
            for r, c in found.items():
                noted[r, lane] = c
    return _digits(steps, lambda rows, lane: noted[np.minimum(rows, len(noted) - 1), lane])


def digits_of(texts: list[str]) -> np.ndarray:
    """(texts, SAMPLES) fingerprint digits, 0 to 15."""
    chars = [_characters(t) for t in texts]
    order = sorted(range(len(texts)), key=lambda i: -len(chars[i]))
    out = np.zeros((len(texts), SAMPLES), dtype=np.uint8)
    for k in range(0, len(order), LANES):
        part = order[k:k + LANES]
        out[part] = _walk_together([chars[i] for i in part])
    return out


def shown(digits: np.ndarray) -> str:
    return packed(digits).tobytes().hex()


def packed(digits: np.ndarray) -> np.ndarray:
    """Two digits a byte, along the last axis."""
    return digits[..., 0::2] << 4 | digits[..., 1::2]


def unpacked(prints: pd.Series) -> np.ndarray:
    """(prints, SAMPLES) digits of packed fingerprints."""
    raw = np.frombuffer(b"".join(prints), dtype=np.uint8).reshape(-1, SAMPLES // 2)
    return np.stack([raw >> 4, raw & 15], axis=-1).reshape(-1, SAMPLES)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of differing digits of packed fingerprints (as 64-bit words, along the last axis)."""
    x = a ^ b
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=-1, dtype=np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of equal embedded characters, 0 to 1, along the last axis."""
    equal = (a == b).mean(axis=-1)
    return np.clip((equal - 1 / 16) / (15 / 16), 0, 1)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


# ------------------------------------------------------------------ next documents
def in_descending_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, guest, id, text): the documents dealt into ranges of ids,
    highest first, each with the first document(s) of the range after it as a
    guest, so that within a bucket every document is followed by its next one.

    Only ids are sampled for the ranges; the texts move once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.length("text")).alias("chars"), F.count("id").alias("n")).head()
    n_buckets = int(min(MOST_BUCKETS, max(1, (total["chars"] or 0) // CHARS_PER_BUCKET)))
    edges = np.zeros(0, dtype=np.int64)
    if total["n"] and n_buckets > 1:
        cuts = [i / n_buckets for i in range(1, n_buckets)]
        edges = np.unique(np.array(rows.agg(F.percentile_approx("id", cuts, 100 * n_buckets)).head()[0], dtype=np.int64))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.full(len(ids), len(edges) + 1)  # no id: after all others
        out[known] = len(edges) - np.searchsorted(edges, ids[known].to_numpy(dtype=np.int64), side="left")
        return pd.Series(out.astype(np.int32))

    first = {r["bucket"]: r["first"] for r in rows.select("id").withColumn("bucket", bucket_of("id"))
             .groupBy("bucket").agg(F.max("id").alias("first")).collect()}  # one row per bucket
    if not first:
        return spark.createDataFrame([], "bucket int, guest boolean, id long, text string")
    order = sorted(first)
    heads = {first[b]: before for b, before in zip(order, [order[-1], *order[:-1]])}  # the last is followed by the first

    @F.pandas_udf("array<struct<bucket:int,guest:boolean>>")
    def places_of(ids: pd.Series, buckets: pd.Series) -> pd.Series:
        return pd.Series([
            [{"bucket": b, "guest": False}] + ([{"bucket": heads[i], "guest": True}] if i in heads else [])
            for i, b in zip((None if pd.isna(i) else int(i) for i in ids), buckets)], dtype=object)

    return (rows.withColumn("at", F.explode(places_of("id", bucket_of("id"))))
            .select("at.bucket", "at.guest", "id", "text")
            .repartition("bucket")
            .sortWithinPartitions("bucket", "guest", F.col("id").desc_nulls_last(), F.col("text").desc()))


def in_hex(rows: DataFrame) -> DataFrame:
    """Binary columns as lower-case hexadecimal text."""
    return rows.select(*[F.lower(F.hex(f.name)).alias(f.name) if f.dataType.typeName() == "binary" else F.col(f.name)
                         for f in rows.schema])


def fingerprints_with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    return in_hex(_with_next(docs, id_col, text_col))


def _with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last row so far: (bucket, guest, id, text, digits)
        for batch in batches:
            texts = batch["text"].tolist()
            ids = [None if pd.isna(i) else int(i) for i in batch["id"]]
            own = digits_of(texts)
            rows = list(zip(batch["bucket"], batch["guest"], ids, texts, own))
            chain = rows if held is None else [held, *rows]
            held = chain[-1]
            pairs = [(a, b) for a, b in zip(chain, chain[1:]) if a[0] == b[0] and not a[1]]
            changed = [edited(a[3], b[3]) for a, b in pairs]
            after = digits_of(changed)
            yield pd.DataFrame({
                "doc_id": pd.array([a[2] for a, _ in pairs], dtype="Int64"),
                "n_chars": np.array([len(a[3]) for a, _ in pairs], dtype=np.int64),
                "edited_sha256": [hashlib.sha256(t.encode()).digest() for t in changed],
                "fingerprint": [packed(a[4]).tobytes() for a, _ in pairs],
                "edited_fingerprint": [packed(d).tobytes() for d in after],
                "near_edited": [float(likeness(a[4], d)) for (a, _), d in zip(pairs, after)],
                "near_next": [float(likeness(a[4], b[4])) for a, b in pairs]})

    return in_descending_order(docs, id_col, text_col).mapInPandas(
        compare, "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, "
                 "edited_fingerprint binary, near_edited double, near_next double")


# ------------------------------------------------------------------ near texts
def band_shape(n_prints: int, near: float = NEAR) -> tuple[int, int]:
    """Digits of a band and number of bands for so many distinct fingerprints.

    A band's digits are the fewest that leave a text about ``CANDIDATES`` unrelated
    ones over all bands; its bands are as many as catch likeness ``near`` with a
    probability of ``CAUGHT``, digits taken as independent.
    """
    agree = near * 15 / 16 + 1 / 16
    digits = LEAST_DIGITS - 1
    while True:
        digits += 1
        bands = int(np.ceil(np.log(1 - CAUGHT) / np.log1p(-agree ** digits)))
        if n_prints * bands * CHANCE ** digits <= CANDIDATES or digits == SAMPLES // 4:
            return digits, bands


def _bands(digits: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """The sampled digits of each band, and odd multipliers that hash them."""
    rnd = np.random.default_rng(88)
    picked = np.array([rnd.choice(SAMPLES, digits, replace=False) for _ in range(bands)])
    return picked, _mix(np.arange(1, picked.size + 1, dtype=np.uint64).reshape(picked.shape)) | np.uint64(1)


def band_keys(digits: np.ndarray, picked: np.ndarray, factors: np.ndarray) -> Iterator[np.ndarray]:
    """For each band, a 64-bit hash of every text's digits in it (bands differ in their factors)."""
    for band, factor in zip(picked, factors):
        yield _mix(((digits[:, band].astype(np.uint64) + np.uint64(1)) * factor).sum(axis=1, dtype=np.uint64)).view(np.int64)


def near_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               near: float = NEAR) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id, component_docs
    (see ``near_prints``)."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def print_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            digits = digits_of([t if isinstance(t, str) else "" for t in batch])
            yield pd.Series([packed(d).tobytes() for d in digits], dtype=object)

    prints = written(docs.select(F.col(id_col).alias("doc_id"), print_of(F.col(text_col)).alias("fingerprint")), "prints")
    return in_hex(prints.join(near_prints(prints, near), "fingerprint").select(
        "doc_id", "fingerprint", "component_id", "component_docs"))


def _with_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, number) sorted by key: those whose key the row before or after
    has, and a task's first and last row, whose neighbour may be in another task."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        same = key[1:] == key[:-1]
        shared = np.append(False, same) | np.append(same, False)
        if held is None:
            shared[0] = True
        elif held[0].column("key")[0].as_py() == key[0]:
            shared[0] = True
            yield held[0]
        elif held[1]:
            yield held[0]
        held = batch.slice(batch.num_rows - 1), bool(shared[-1])
        shared[-1] = False
        yield batch.filter(pa.array(shared))
    if held is not None:
        yield held[0]


def near_prints(prints: DataFrame, near: float = NEAR) -> DataFrame:
    """One row per distinct fingerprint of ``prints`` (doc_id, fingerprint: packed):
    fingerprint, component_id (the smallest doc_id reachable over links of likeness
    ``near`` or more) and component_docs (the documents reached, itself included).

    Texts that agree in a band are compared by their whole fingerprints. Only
    distinct fingerprints are compared, and tasks return spanning links. All bands
    move once, as a hash and a number, into ranges of (hash, number), so that a
    band that very many texts share is spread; only rows that share their hash
    with a neighbour go on, and only these are joined by the fingerprints.
    """
    classes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("docs"))
                      .withColumn("number", F.monotonically_increasing_id()), "print-classes")
    picked, factors = _bands(*band_shape(classes.count(), near))
    most = int(np.floor(SAMPLES * (1 - near) * 15 / 16 + 1e-9))   # differing digits at that likeness

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys in band_keys(unpacked(batch["fingerprint"]), picked, factors):
                yield pd.DataFrame({"key": keys, "number": batch["number"]})

    def compare(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        frame = frame.reset_index(drop=True)
        words = np.frombuffer(b"".join(frame["fingerprint"]), dtype=np.uint64).reshape(-1, SAMPLES // 16)
        number = frame["number"].to_numpy()
        tied_to: list[tuple[np.ndarray, np.ndarray]] = []
        for rows in frame.groupby(["key", "chunks"], sort=False).indices.values():
            if len(rows) < 2:
                continue
            own = words[rows]
            labels = np.arange(len(rows))
            for k in range(0, len(rows), 64):
                a, b = np.nonzero(differing(own[k:k + 64, None, :], own[None, :, :]) <= most)
                labels = joined(labels, a + k, b)
            tied = labels != np.arange(len(rows))
            tied_to.append((number[rows[tied]], number[rows[labels[tied]]]))
        if tied_to:   # one frame of many groups' links
            u, v = (np.concatenate(x) for x in zip(*tied_to))
            yield pd.DataFrame({"u": u, "v": v}).drop_duplicates()

    dealt = (classes.select("fingerprint", "number").mapInPandas(deal, "key long, number long")
             .repartitionByRange("key", "number").sortWithinPartitions("key", "number"))
    dealt = written(dealt.mapInArrow(_with_neighbours, "key long, number long"), "bands")
    dealt = (cut_hot_groups(dealt, ["key"], "number", GROUP_TEXTS)
             .join(classes.select("number", "fingerprint"), "number"))
    links = (dealt.repartition("key", "chunks").sortWithinPartitions("key", "chunks")
             .mapInPandas(whole_groups(["key", "chunks"], compare, BUFFER_TEXTS), "u long, v long"))
    found = components(written(links, "print-links"))
    rooted = written(classes.join(found.withColumnRenamed("node", "number"), "number", "left")
                     .withColumn("root", F.coalesce("root", "number")), "print-roots")
    smallest = written(rooted.groupBy("root").agg(F.min("least").alias("component_id"),
                                                  F.sum("docs").alias("component_docs")), "print-least")
    return written(rooted.join(smallest, "root").select("fingerprint", "component_id", "component_docs"), "print-members")


def op8_editprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``fingerprints_with_next`` and of ``near_prints``, one row per document."""
    rows = written(_with_next(table(spark, sf_dir, "documents"), "doc_id", "text"), "prints")
    return in_hex(rows.join(near_prints(rows.select("doc_id", "fingerprint")), "fingerprint").select(
        *rows.columns, "component_id", "component_docs"))
