"""Operator 3: approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1, so the largest cosine is the least Euclidean
distance. A table hashes a vector by ``HASHES`` Gaussian projections, shifted
and cut into cells of ``WIDTH``; the cells' numbers are its bucket. A query
visits ``PROBES`` buckets per table, its own and perturbed ones, in order of
the estimated chance that a neighbour at distance ``NEAR`` is there: the
neighbour's projection is normal around the query's, so each hash gives the
chance of each cell near the query's, and a bucket's is their product.
Candidates of all tables are merged and ranked by exact cosine.

Work is dealt by (table, bucket): the vectors of a bucket and the queries that
visit it meet in a group, are compared in blocks with numpy, and only every
query's best candidates leave the task. A bucket of more than
``GROUP_VECTORS`` is cut into chunks, which every visiting query visits.

Equal vectors are one class with its ``KEPT`` smallest ids: of equal scores
the smaller ids win, so no other copy can be among the nearest. Queries of
equal vectors are searched once. A query that its buckets leave with fewer
neighbours than there are is compared with every bucket of one table, which
is every vector.

Defined results: rows with a null id, or a vector that is null, empty, all
zero or has null or non-finite components, take no part; vectors are compared
with those of equal length; rows that agree in id and vector are one row.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table, written

NEAREST = 5
TABLES, HASHES, WIDTH, PROBES = 4, 4, 1.5, 20
REACH = 2             # cells left and right of the query's that are perturbed to
NEAR = 1.1
KEPT = NEAREST + 1    # the query itself may be among them
GROUP_VECTORS = 20_000
QUERY_BLOCK = 256
HELD_ROWS = 200_000   # candidate rows a task holds before it keeps the best only
SEED = 3
_GROUP = ["dim", "t", "bucket", "chunk"]
DEALT = "dim int, t int, bucket long, cls long, is_query boolean, vec binary, ids array<long>"


def _projections(dim: int, t: int) -> tuple[np.ndarray, np.ndarray]:
    rnd = np.random.default_rng([SEED, dim, t])
    return rnd.normal(size=(dim, HASHES)), rnd.uniform(0, WIDTH, HASHES)


def _bucket(cells: np.ndarray) -> np.ndarray:
    """Cells of every hash -> one number."""
    return ((cells.astype(np.int64) + 1000) * 2048 ** np.arange(HASHES, dtype=np.int64)).sum(axis=-1)


_STEPS = np.arange(-REACH, REACH + 1)
_COMBINATIONS = np.array(list(itertools.product(range(len(_STEPS)), repeat=HASHES)))
_ERF = np.vectorize(math.erf, otypes=[float])


def probed_buckets(units: np.ndarray, t: int, probes: int = PROBES) -> np.ndarray:
    """(vectors, probes) buckets of table t, the likeliest first."""
    a, b = _projections(units.shape[1], t)
    at = (units @ a + b) / WIDTH
    own = np.floor(at)
    edges = own[:, :, None] + np.append(_STEPS, REACH + 1) - at[:, :, None]
    below = 0.5 * (1 + _ERF(edges * WIDTH / NEAR / np.sqrt(2)))
    chance = np.log(np.maximum(np.diff(below, axis=2), 1e-300))
    total = sum(chance[:, i, :][:, _COMBINATIONS[:, i]] for i in range(HASHES))
    best = np.argsort(-total, axis=1, kind="stable")[:, :probes]
    return _bucket(own[:, None, :] + _STEPS[_COMBINATIONS[best]])


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _by_length(batch: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    for dim, rows in batch.groupby(batch["vec"].map(len), sort=False):
        yield dim, rows, np.array(rows["vec"].tolist(), dtype=np.float64)


def _deal_index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for dim, rows, vectors in _by_length(batch):
            units, raw = _units(vectors), [v.tobytes() for v in vectors]
            for t in range(TABLES):
                a, b = _projections(dim, t)
                yield pd.DataFrame({"dim": np.int32(dim), "t": np.int32(t),
                                    "bucket": _bucket(np.floor((units @ a + b) / WIDTH)), "cls": rows["cls"].to_numpy(),
                                    "is_query": False, "vec": raw, "ids": rows["ids"].to_numpy()})


def _deal_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for dim, rows, vectors in _by_length(batch):
            units, raw = _units(vectors), np.array([v.tobytes() for v in vectors], dtype=object)
            for t in range(TABLES):
                buckets = probed_buckets(units, t)
                n = buckets.shape[1]
                yield pd.DataFrame({"dim": np.int32(dim), "t": np.int32(t), "bucket": buckets.ravel(),
                                    "cls": np.repeat(rows["cls"].to_numpy(), n), "is_query": True,
                                    "vec": np.repeat(raw, n), "ids": None})


class _Best:
    """The best candidate classes of many queries."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.rows = 0

    def add(self, query, cls, score, ids) -> None:
        self.parts.append((query, cls, score, ids))
        self.rows += len(query)

    def reduced(self) -> tuple:
        query, cls, score, ids = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((cls, -score, query))
        query, cls, score, ids = query[order], cls[order], score[order], ids[order]
        # a candidate met in several tables has the same score each time
        fresh = np.r_[True, (query[1:] != query[:-1]) | (cls[1:] != cls[:-1])]
        query, cls, score, ids = query[fresh], cls[fresh], score[fresh], ids[fresh]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        keep = rank < KEPT
        return query[keep], cls[keep], score[keep], ids[keep]

    def frame(self) -> pd.DataFrame:
        query, cls, score, ids = self.reduced()
        self.parts, self.rows = [], 0
        return pd.DataFrame({"query": query, "cls": cls, "score": score, "ids": ids})


def _compare(queries: pd.DataFrame, q: np.ndarray, q_unit: np.ndarray, cls, x, x_unit, ids, best: _Best) -> None:
    close = q_unit @ x_unit.T
    n = min(KEPT, close.shape[1])
    top = np.argpartition(-close, n - 1, axis=1)[:, :n]
    a, b = np.repeat(q, n, axis=0), x[top.ravel()]
    # row by row, so that a pair's score is the same number wherever it is met
    score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
    best.add(np.repeat(queries["cls"].to_numpy(), n), cls[top.ravel()], score, ids[top.ravel()])


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by group, the vectors of a group before its queries."""
    best, key, held, block = _Best(), None, [], None
    for batch in batches:
        names = batch[_GROUP]
        new = (names != names.shift()).any(axis=1).to_numpy() | (batch["is_query"] != batch["is_query"].shift()).to_numpy()
        starts = np.flatnonzero(new)
        for a, b in zip(starts, np.r_[starts[1:], len(batch)]):
            rows = batch.iloc[a:b]
            own = tuple(names.iloc[a])
            if own != key:
                key, held, block = own, [], None
            if not rows["is_query"].iloc[0]:
                held.append(rows)
                continue
            if not held:
                continue  # nobody lives in this bucket
            if block is None:
                index = pd.concat(held)
                x = np.frombuffer(b"".join(index["vec"])).reshape(len(index), -1)
                block = (index["cls"].to_numpy(), x, _units(x), index["ids"].to_numpy())
            for k in range(0, len(rows), QUERY_BLOCK):
                part = rows.iloc[k:k + QUERY_BLOCK]
                q = np.frombuffer(b"".join(part["vec"])).reshape(len(part), -1)
                _compare(part, q, _units(q), *block, best)
            if best.rows > HELD_ROWS:
                done = best.reduced()
                best.parts, best.rows = [done], len(done[0])
                if best.rows > HELD_ROWS // 2:
                    yield best.frame()
    if best.rows:
        yield best.frame()


def _visits(index: DataFrame, queries: DataFrame) -> DataFrame:
    """Candidates (query, cls, score, ids) from the groups where both meet."""
    hot = written(index.groupBy("dim", "t", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP_VECTORS)
                  .select("dim", "t", "bucket", F.ceil(F.col("n") / GROUP_VECTORS).cast("int").alias("m")), "ann-hot")
    if hot.head() is None:
        rows = index.unionByName(queries).withColumn("chunk", F.lit(0))
    else:
        m = F.coalesce("m", F.lit(1))
        on = ["dim", "t", "bucket"]
        rows = (index.join(hot, on, "left").withColumn("chunk", F.pmod(F.xxhash64("cls"), m).cast("int"))
                .unionByName(queries.join(hot, on, "left").withColumn("chunk", F.explode(F.sequence(F.lit(0), m - 1)))).drop("m"))
    return (rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "is_query")
            .mapInPandas(_search, "query long, cls long, score double, ids array<long>"))


def _nearest(candidates: DataFrame) -> DataFrame:
    """query -> near: its KEPT nearest (score, id), nearest first."""
    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return (candidates.dropDuplicates(["query", "cls"]).withColumn("id", F.explode("ids"))
            .withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= KEPT)
            .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("near")))


def search(vectors: DataFrame, is_query, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: of every row with ``is_query`` (a column
    over ``id``) the NEAREST rows of largest cosine found."""
    bounded_batches(vectors.sparkSession)
    inf = F.lit(float("inf"))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
            .where(F.col("id").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
                   & F.exists("vec", lambda x: x != 0)))
    first = Window.partitionBy("vec").orderBy("id")  # limited before the shuffle, so copies do not pile up
    classes = written(
        rows.select("vec", "id").withColumn("place", F.dense_rank().over(first)).where(F.col("place") <= KEPT)
        .groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids")).withColumn("cls", F.xxhash64("vec")), "ann-classes")
    asked = written(rows.where(is_query).select("id", "vec").distinct(), "ann-queries")
    wanted = written(classes.join(asked.select("vec").distinct(), "vec", "left_semi").select("vec", "cls"), "ann-asked")

    index = classes.mapInPandas(_deal_index, DEALT)
    found = written(_nearest(_visits(index, wanted.mapInPandas(_deal_queries, DEALT))), "ann-found")

    # exact way for queries whose buckets hold fewer vectors than there are
    sizes = {r["dim"]: r["n"] for r in classes.groupBy(F.size("vec").alias("dim")).agg(
        F.sum(F.size("ids")).alias("n")).collect()}
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    there = F.create_map(*[F.lit(min(v, KEPT) if i else k) for k, v in sizes.items() for i in (0, 1)])
    short = written(wanted.join(found, wanted["cls"] == found["query"], "left")
                    .where(F.coalesce(F.size("near"), F.lit(0)) < there[F.size("vec")]).select("vec", "cls"), "ann-short")
    if short.head() is not None:
        whole = written(index.where("t = 0"), "ann-all")
        every = whole.select("dim", "bucket").distinct()
        visits = (short.withColumn("dim", F.size("vec")).mapInPandas(_raw_queries, "dim int, cls long, vec binary")
                  .join(every, "dim").select("dim", F.lit(0).alias("t"), "bucket", "cls", F.lit(True).alias("is_query"),
                                             "vec", F.lit(None).cast("array<long>").alias("ids")))
        more = written(_nearest(_visits(whole, visits)), "ann-more")
        found = found.join(short, found["query"] == short["cls"], "left_anti").unionByName(more)

    result = (asked.join(wanted, "vec").join(found, F.col("cls") == F.col("query"))
              .select(F.col("id").alias("query_id"), F.posexplode(F.slice(
                  F.filter("near", lambda x: x["id"] != F.col("id")), 1, NEAREST)).alias("at", "one")))
    return result.select("query_id", (F.col("at") + 1).alias("rank"), F.col("one.id").alias("vec_id"),
                         F.col("one.score").alias("score"))


def _raw_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"dim": batch["dim"], "cls": batch["cls"],
                            "vec": [np.asarray(v, dtype=np.float64).tobytes() for v in batch["vec"]]})


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
