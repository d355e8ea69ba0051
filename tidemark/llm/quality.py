"""Operator 5: quality by attention-based multiple-instance learning.

A document is a bag of passages (windows of ``PASSAGE_BYTES`` bytes of its
UTF-8 text), and only the bag has a label. Every passage is encoded:

    x = square roots of the shares of its byte kinds and pairs of kinds,
        and how far its 8-byte sequences repeat
    h = tanh(W x + b)

gated attention weighs the passages of a bag, and the weighted mean is scored:

    a = softmax over the bag of  w . (tanh(V h) * sigmoid(U h))
    score = sigmoid(c . sum(a h) + d)

All parameters are learned together from document labels (Adam on the mean
log loss, in numpy on the driver) from a bounded sample of labelled documents,
every passage of each: the ``MAX_DOCS`` of least hash of the id, in that order
as long as their passages come to ``MAX_PASSAGES`` at most (a document that
would go over it is passed over). Scoring reads whole texts in blocks, with a
running softmax, so memory is bounded for any text length.

Defined results: a null text counts as empty; an empty text is a bag of one
passage without bytes; labels that are null or of unknown documents are left
out, of several labels of a document the smallest counts; equal rows of a
document are learned from once, different texts of one id one by one; without
training labels of both kinds every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, crc_remainder, table, written

PASSAGE_BYTES = 512
BLOCK_PASSAGES = 1024     # passages encoded at a time
MAX_DOCS = 4000           # labelled documents learned from, at most
MAX_PASSAGES = 100_000    # their passages together, at most
HIDDEN, GATE = 24, 16
EPOCHS, BATCH_DOCS, RATE, DECAY = 24, 128, 0.01, 1e-4
SEED = 11

# Kinds of bytes. Bytes not listed are kind 0.
KINDS = (b" ", b"\n\r", b"\t\v\f", b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
         b"0123456789", b".", b",;:", b"!?", b"|<>{}[]()", b"#$%&*@^~", b"-_=+/\\", b"\"'`",
         bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100)))
N_KINDS = len(KINDS) + 1
N_INPUTS = N_KINDS + N_KINDS * N_KINDS + 1
SEQUENCE, CELLS = 8, 256  # length of the sequences, and cells they are hashed into
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KIND = np.zeros(256, dtype=np.int64)
for _n, _bytes in enumerate(KINDS, 1):
    _KIND[list(_bytes)] = _n


def passage_inputs(data: bytes) -> np.ndarray:
    """Inputs of consecutive whole passages (the last may be shorter)."""
    n = max(1, -(-len(data) // PASSAGE_BYTES))
    kinds = _KIND[np.frombuffer(data, dtype=np.uint8)]
    passage = np.arange(len(kinds)) // PASSAGE_BYTES
    single = np.bincount(passage * N_KINDS + kinds, minlength=n * N_KINDS).reshape(n, N_KINDS)
    inside = passage[1:] == passage[:-1]
    pairs = ((passage[1:] * N_KINDS + kinds[:-1]) * N_KINDS + kinds[1:])[inside]
    double = np.bincount(pairs, minlength=n * N_KINDS ** 2).reshape(n, N_KINDS ** 2)
    shares = np.concatenate([single / np.maximum(single.sum(1), 1)[:, None],
                             double / np.maximum(double.sum(1), 1)[:, None]], axis=1)
    repeats = np.zeros((n, 1))
    if len(data) >= SEQUENCE:  # empty cells beyond those that distinct sequences would leave
        sequences = np.ndarray((len(data) - SEQUENCE + 1,), "<u8", buffer=data, strides=(1,))
        cell = ((sequences * _MIX) >> np.uint64(56)).astype(np.int64)
        filled = np.bincount(passage[:len(cell)] * CELLS + cell, minlength=n * CELLS).reshape(n, CELLS)
        repeats[:, 0] = 1 - (filled > 0).sum(1) / (CELLS * -np.expm1(-np.maximum(filled.sum(1), 1) / CELLS))
    return np.concatenate([np.sqrt(shares), np.clip(repeats, 0, 1)], axis=1).astype(np.float32)


@dataclass
class Model:
    """``parameters`` is None where there is nothing to learn from."""

    parameters: dict[str, np.ndarray] | None
    share: float = 0.5

    def _encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passage representations and attention logits."""
        p = self.parameters
        h = np.tanh(x @ p["W"] + p["b"])
        gate = np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))
        return h, gate @ p["w"]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.share)
        if self.parameters is None:
            return out
        for i, text in enumerate(texts):
            data = (text or "").encode()
            top, total, mean = -np.inf, 0.0, np.zeros(HIDDEN)
            for k in range(0, max(1, len(data)), PASSAGE_BYTES * BLOCK_PASSAGES):
                h, logit = self._encode(passage_inputs(data[k:k + PASSAGE_BYTES * BLOCK_PASSAGES]))
                high = max(top, float(logit.max()))
                part = np.exp(logit - high)
                scale = np.exp(top - high)
                total, mean, top = total * scale + part.sum(), mean * scale + part @ h, high
            z = float(mean / total @ self.parameters["c"] + self.parameters["d"][0])
            out[i] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return out


def _gradients(p, x, bag, n_bags, label):
    """Mean log loss over the bags and its gradients. ``bag``: ascending bag
    number of each passage."""
    starts = np.searchsorted(bag, np.arange(n_bags))
    total = lambda v: np.add.reduceat(v, starts, axis=0)
    h = np.tanh(x @ p["W"] + p["b"])
    left, right = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    gate = left * right
    logit = gate @ p["w"]
    e = np.exp(logit - np.maximum.reduceat(logit, starts)[bag])
    a = e / total(e)[bag]
    z = total(a[:, None] * h)
    y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"][0], -50, 50)))
    loss = -np.mean(label * np.log(y + 1e-9) + (1 - label) * np.log(1 - y + 1e-9))
    dy = (y - label) / n_bags
    dz = dy[:, None] * p["c"][None, :]
    dh = a[:, None] * dz[bag]
    da = (h * dz[bag]).sum(1)
    dlogit = a * (da - total(a * da)[bag])
    dgate = dlogit[:, None] * p["w"][None, :]
    dleft, dright = dgate * right * (1 - left ** 2), dgate * left * right * (1 - right)
    dh += dleft @ p["V"].T + dright @ p["U"].T
    dpre = dh * (1 - h ** 2)
    return loss, {"W": x.T @ dpre, "b": dpre.sum(0), "V": h.T @ dleft, "U": h.T @ dright,
                  "w": gate.T @ dlogit, "c": z.T @ dy, "d": np.array([dy.sum()])}


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """Learns from bags of passage inputs and 0/1 labels, in the given order."""
    labels = np.asarray(labels, dtype=np.float64)
    if not len(bags) or labels.min() == labels.max():
        return Model(None, float(labels.mean()) if len(bags) else 0.5)
    rnd = np.random.default_rng(SEED)
    init = lambda *shape: rnd.normal(0, 1 / np.sqrt(shape[0]), shape)
    p = {"W": init(N_INPUTS, HIDDEN) * 3, "b": np.zeros(HIDDEN), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE),
         "w": init(GATE), "c": init(HIDDEN), "d": np.zeros(1)}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rnd.permutation(len(bags))
        for k in range(0, len(order), BATCH_DOCS):
            chosen = order[k:k + BATCH_DOCS]
            x = np.concatenate([bags[i] for i in chosen]).astype(np.float64)
            bag = np.repeat(np.arange(len(chosen)), [len(bags[i]) for i in chosen])
            _, g = _gradients(p, x, bag, len(chosen), labels[chosen])
            step += 1
            for name in p:
                grad = g[name] + (DECAY * p[name] if p[name].ndim == 2 else 0)
                m[name] = 0.9 * m[name] + 0.1 * grad
                v[name] = 0.999 * v[name] + 0.001 * grad ** 2
                p[name] = p[name] - RATE * (m[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)
    return Model({k: x.astype(np.float32) for k, x in p.items()}, float(labels.mean()))


def sampled_rows(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
                 text_col: str = "text", max_docs: int = MAX_DOCS, max_passages: int = MAX_PASSAGES) -> DataFrame:
    """The rows learned from: id, label, text (see the module). The driver sees
    ids, label and length of at most ``max_docs`` rows."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).cast("int").alias("label"))
             .withColumn("place", F.xxhash64("id", F.lit("quality sample"))))
    # documents without a row may be labelled: only ids with one count
    present = docs.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    chosen = known.join(present, "id", "left_semi").orderBy("place", "id").limit(max_docs)
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(chosen, "id").withColumn("hash", F.xxhash64("text")).dropDuplicates(["id", "hash"]))
    rows = written(rows, "quality-sample")
    listed = (rows.select("id", "hash", "place", F.octet_length("text").alias("size"))
              .orderBy("place", "id", "hash").limit(max_docs).collect())
    taken, held = [], 0
    for row in listed:
        passages = max(1, -(-row["size"] // PASSAGE_BYTES))
        if held + passages <= max_passages:
            held += passages
            taken.append((row["id"], row["hash"]))
    taken = docs.sparkSession.createDataFrame(taken, "id long, hash long")
    return rows.join(F.broadcast(taken), ["id", "hash"]).select("id", "label", "text")  # at most max_docs rows


def bags_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (id, label, text) -> (id, label, x), x the inputs of all passages of the text, 16-bit."""
    for batch in batches:
        for doc_id, label, text in zip(batch["id"], batch["label"], batch["text"]):
            data = text.encode()
            x = [passage_inputs(data[i:i + PASSAGE_BYTES * BLOCK_PASSAGES]).astype(np.float16)
                 for i in range(0, max(1, len(data)), PASSAGE_BYTES * BLOCK_PASSAGES)]
            yield pd.DataFrame({"id": [doc_id], "label": [label], "x": [np.concatenate(x).tobytes()]})


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", max_docs: int = MAX_DOCS, max_passages: int = MAX_PASSAGES) -> Model:
    """Fits a model to the labelled documents (all rows of ``labels`` are for
    learning; leave the held-out ones away). Only ids, labels and the passage
    inputs of the bounded sample reach the driver."""
    rows = sampled_rows(docs, labels, label_col=label_col, id_col=id_col, text_col=text_col,
                        max_docs=max_docs, max_passages=max_passages)
    found = sorted((r["id"], bytes(r["x"]), r["label"]) for r in
                   rows.mapInPandas(bags_of, "id long, label int, x binary").collect())
    bags = [np.frombuffer(x, dtype=np.float16).reshape(-1, N_INPUTS) for _, x, _ in found]
    return fit(bags, np.array([label for _, _, label in found], dtype=np.float64))


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The model's score of a text column, double between 0 and 1."""
    shared = spark.sparkContext.broadcast(model)  # a few thousand numbers

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.scores([t if isinstance(t, str) else None for t in batch]))

    return score(text)


def learned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """The production model: learned from ``docs`` with a label whose
    crc32(doc_id) mod 3 is not 1."""
    labels = table(spark, sf_dir, "labels").where(crc_remainder(F.col("doc_id"), 3) != 1)
    return train(docs, labels)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learned(spark, docs, sf_dir)
    return (docs.withColumn("score", score_column(spark, model, F.col("text")))
            .select("doc_id", F.coalesce(crc_remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
