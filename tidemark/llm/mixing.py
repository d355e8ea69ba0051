"""Operator 10: mixing sources to target weights by weighted fair queueing.

Every source's documents are put in a fixed random order and laid out as
often as they may repeat. A copy's virtual finish time is the number of its
source's words up to and including it, divided by the source's target, so
every source reaches its target at time 1 and sources progress in proportion
to their targets. Sorting all copies by finish time and cutting at the total
budget gives the mix.

DataFrame functions only, and no task holds a whole source:

* A document is one narrow row, and its order key is an md5, so any range of
  key prefixes holds an even share of a source. Running sums are taken per
  (source, key range) and the ranges' totals are summed ahead of them; the
  number of ranges follows the number of rows. Rows that agree in id, source
  and text are counted first and then numbered; the number is part of the key,
  so repeats spread over the source like any other documents.
* The cut needs no total order: finish times are grouped into ranges, the
  ranges' totals say which one holds the budget's end, and only the copies
  of that range are put in order.

Defined results: a null text counts as empty; an empty document has size 0
and is taken 0 words, but it moves with the mix (``copies`` may be above 0);
a null source is a source of its own, after all others; rows that agree in
id, source and text are documents of their own, told apart by a number (which
of them has which is open), so the cut may fall between them; an empty table
gives an empty result. Columns beside id, source and text are left alone,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import word_count, written

WEIGHTS = (5, 2, 1)   # by source in code point order, repeating
BUDGET_SHARE = 1.5    # of all words
MAX_REPEATS = 2       # times a document may be taken
SEED = "mix"
ROWS_PER_RANGE = 20_000
ROWS_PER_PIECE = 1000  # repeats of one row numbered by one input row


def order_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """The shuffle key: md5 over the seed, the id and the text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")),
                          F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            share: float = BUDGET_SHARE, repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source (``source``, ``source_size``) -> rank, weight, target.

    Sources share the budget by weight; what a source cannot take (its cap
    is ``repeats`` times its size) is shared again by weight among the rest.
    The fixed point is a common level L with target = min(cap, L * weight).
    A source is at its cap exactly if the level at which it fills up uses no
    more than the budget. The window sees one small row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    filled = (sources.withColumn("rank", F.row_number().over(by_name))
              .withColumn("weight", weight)
              .withColumn("cap", F.col("source_size") * repeats)
              .withColumn("fill", F.col("cap") / F.col("weight"))
              .withColumn("budget", F.sum("source_size").over(whole) * F.lit(share))
              .withColumn("rest", F.sum("weight").over(whole) - F.sum("weight").over(by_fill))
              .withColumn("capped", F.sum("cap").over(by_fill) + F.col("fill") * F.col("rest")
                          <= F.col("budget")))
    level = ((F.col("budget") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(whole))
             / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole))
    return (filled.withColumn("level", level)
            .select("source", "source_size", "rank", "weight", "budget",
                    F.when(F.col("capped"), F.col("cap").cast("double"))
                    .otherwise(F.col("level") * F.col("weight")).alias("target")))


def _ranges(n_rows: int) -> int:
    n = 1
    while n * ROWS_PER_RANGE < n_rows:
        n *= 2
    return min(n, 1 << 24)


def _numbered(items: DataFrame) -> DataFrame:
    """One row per document from counted rows (key, n_rows): its number among its
    repeats, from 1, and the order key that follows. Only repeats are dealt out:
    pieces of ``ROWS_PER_PIECE`` numbers first, so that no task writes a hot one alone."""
    first = items.where("n_rows = 1").withColumn("repeat", F.lit(1).cast("long"))
    pieces = (items.where("n_rows > 1")
              .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"),
                                                        F.floor((F.col("n_rows") - 1) / ROWS_PER_PIECE))))
              .repartition("key", "source", "piece"))
    low = F.col("piece") * ROWS_PER_PIECE + 1
    many = pieces.withColumn("repeat", F.explode(F.sequence(low, F.least(low + (ROWS_PER_PIECE - 1), F.col("n_rows")))))
    rows = first.unionByName(many.drop("piece"))
    return (rows.withColumn("base", F.col("key"))
            .withColumn("key", F.when(F.col("repeat") == 1, F.col("key"))
                        .otherwise(F.md5(F.concat_ws(":", "key", F.col("repeat").cast("string"))))))


def schedule(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
             share: float = BUDGET_SHARE, repeats: int = MAX_REPEATS,
             seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, key, base and repeat (the key before
    numbering, and the number), n_rows (its repeats), size, source_size, target,
    finish (of the first copy), rank and copies (how often the mix takes it).
    """
    at = lambda c: F.col(f"`{c}`")
    counted = written(
        docs.select(at(id_col).alias("doc_id"), at(source_col).alias("source"),
                    order_key(at(id_col), at(text_col), seed).alias("key"), word_count(at(text_col)).alias("size"))
        .groupBy("doc_id", "source", "key", "size").agg(F.count(F.lit(1)).alias("n_rows")), "mix")
    n_ranges = _ranges(counted.agg(F.sum("n_rows")).head()[0] or 0)
    items = _numbered(counted).withColumn("part", F.floor(
        F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(n_ranges) / F.lit(1 << 32)))

    parts = items.groupBy("source", "part").agg(F.sum("size").alias("part_words"))
    aimed = targets(parts.groupBy("source").agg(F.sum("part_words").alias("source_size")),
                    weights, share, repeats)
    before = (Window.partitionBy("source").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    parts = (parts.withColumn("before", F.coalesce(F.sum("part_words").over(before), F.lit(0)))
             .withColumnRenamed("source", "of"))
    parts = written(parts.join(aimed, parts["of"].eqNullSafe(aimed["source"])).drop("source"),
                    "mix-parts").withColumnRenamed("part", "of_part")
    within = (Window.partitionBy("rank", "part").orderBy("key")
              .rowsBetween(Window.unboundedPreceding, 0))
    queue = (items.join(parts, (F.col("part") == F.col("of_part"))
                        & F.col("source").eqNullSafe(F.col("of")))
             .withColumn("served", F.col("before") + F.sum("size").over(within))
             .select("doc_id", "source", "key", "base", "repeat", "n_rows", "size", "source_size", "target",
                     "budget", "rank", "served"))
    queue = written(queue, "mix-queue")

    finish = lambda copy: (F.col("served") + F.col("source_size") * copy) / F.col("target")
    copies = queue.where("target > 0").select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("copy"), finish(c).alias("finish"))
                            for c in range(repeats)])).alias("at"),
        "rank", "key", F.col("size").alias("words"), "budget")
    copies = (copies.select("at.copy", "at.finish", "rank", "key", "words", "budget")
              .withColumn("slot", F.floor(F.col("finish") * n_ranges)))
    up_to = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    slots = (copies.groupBy("slot").agg(F.sum("words").alias("words"), F.first("budget").alias("budget"))
             .withColumn("so_far", F.sum("words").over(up_to)))
    over = slots.where("so_far > budget").orderBy("slot").limit(1).head()
    if over is None:  # the budget is not used up: everything is taken
        kept = F.lit(repeats)
    else:
        in_order = (Window.partitionBy("slot").orderBy("finish", "rank", "key")
                    .rowsBetween(Window.unboundedPreceding, 0))
        end = (copies.where(F.col("slot") == over["slot"])
               .withColumn("so_far", F.sum("words").over(in_order) + (over["so_far"] - over["words"]))
               .where("so_far > budget").orderBy("finish", "rank", "key").limit(1).head())
        first_left = F.struct(F.lit(end["finish"]), F.lit(end["rank"]), F.lit(end["key"]))
        kept = sum((F.struct(finish(c), F.col("rank"), F.col("key")) < first_left).cast("int")
                   for c in range(repeats))
    return (queue.withColumn("copies", F.when(F.col("target") > 0, kept).otherwise(0))
            .withColumn("finish", F.when(F.col("target") > 0, finish(0)))
            .drop("budget", "served"))


def _told_apart(rows: DataFrame) -> DataFrame:
    """Repeated rows (columns row, base, source) with their number among their like,
    from 1. Two levels, as a hot row's repeats must not meet in one task: the
    places within each partition of the written rows, and before them the
    partitions' totals."""
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "mix-repeats")
    rows = rows.withColumn("chunk", F.shiftright("at", 33))
    like = ("base", "source")
    inside = Window.partitionBy(*like, "chunk").orderBy("at")
    before = Window.partitionBy(*like).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.groupBy(*like, "chunk").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .select(F.col("base").alias("of"), F.col("source").alias("from"), F.col("chunk").alias("in"), "before"))
    return (rows.withColumn("place", F.row_number().over(inside))
            .join(totals, (F.col("base") == F.col("of")) & F.col("source").eqNullSafe(F.col("from"))
                  & (F.col("chunk") == F.col("in")))
            .select("row", "base", "source", (F.col("place") + F.col("before")).alias("repeat")))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", seed: str = SEED, **settings) -> DataFrame:
    """The mix itself: ``docs``' columns, each row as often as it is taken,
    in order of virtual finish time (a global range sort)."""
    at = lambda c: F.col(f"`{c}`")
    plan = schedule(docs, id_col=id_col, text_col=text_col, source_col=source_col,
                    seed=seed, **settings)
    rows = docs.select(F.struct("*").alias("row"), order_key(at(id_col), at(text_col), seed).alias("base"),
                       at(source_col).alias("source"))
    repeated = (plan.where("n_rows > 1").groupBy(F.col("base").alias("of"), F.col("source").alias("from"))
                .agg(F.count(F.lit(1)).alias("n")))
    if repeated.head() is None:
        rows = rows.withColumn("repeat", F.lit(1).cast("long"))
    else:
        same = (rows["base"] == repeated["of"]) & rows["source"].eqNullSafe(repeated["from"])
        rows = (rows.join(repeated, same, "left_anti").withColumn("repeat", F.lit(1).cast("long"))
                .unionByName(_told_apart(rows.join(repeated, same, "left_semi"))))
    times = plan.where("copies > 0").select(
        F.col("base").alias("of"), F.col("source").alias("from"), F.col("repeat").alias("number"), "key", "copies",
        "finish", "rank", (F.col("source_size") / F.col("target")).alias("round"))
    return (rows.join(times, (F.col("base") == F.col("of")) & F.col("source").eqNullSafe(F.col("from"))
                      & (F.col("repeat") == F.col("number")))
            .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
            .orderBy(F.col("finish") + F.col("round") * F.col("copy"), "rank", "key")
            .select("row.*"))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    from tidemark.llm.common import table

    plan = schedule(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
                       (F.col("size") * F.col("copies")).cast("long").alias("taken"))


# The same definition with whole-table windows, for DuckDB.
OP10_SQL = """
WITH rows AS (
  SELECT doc_id, source,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, key) AS repeat FROM rows),
items AS (SELECT doc_id, source, CASE WHEN repeat = 1 THEN key ELSE md5(key || ':' || repeat) END AS key, size
          FROM numbered),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM items GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sources),
weighted AS (
  SELECT *, CAST(CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight,
         source_size * 2 AS cap,
         CAST((SELECT sum(source_size) FROM sources) AS DOUBLE) * 1.5 AS budget FROM ranked),
levels AS (
  SELECT *, sum(cap) OVER f + cap / weight * (sum(weight) OVER () - sum(weight) OVER f) <= budget AS capped
  FROM weighted WINDOW f AS (ORDER BY cap / weight, rank ROWS UNBOUNDED PRECEDING)),
aimed AS (
  SELECT source, rank, source_size, budget,
         CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
           ((budget - CAST(sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS DOUBLE))
            / sum(CASE WHEN NOT capped THEN weight END) OVER ()) * weight END AS target
  FROM levels),
served AS (
  SELECT i.doc_id, i.key, i.size, a.rank, a.source_size, a.target, a.budget,
         CAST(sum(i.size) OVER (PARTITION BY a.rank ORDER BY i.key, i.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS served
  FROM items i JOIN aimed a ON i.source IS NOT DISTINCT FROM a.source),
copies AS (
  SELECT s.*, CAST(served + source_size * copy AS DOUBLE) / target AS finish
  FROM served s, (SELECT unnest([0, 1]) AS copy) WHERE target > 0),
mixed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, key ROWS UNBOUNDED PRECEDING) > budget AS late FROM copies),
taken AS (
  SELECT rank, key, CAST(sum(CASE WHEN late THEN 0 ELSE size END) AS BIGINT) AS taken FROM mixed GROUP BY rank, key)
SELECT s.doc_id, s.size, s.source_size, coalesce(s.target, 0.0) AS target, coalesce(t.taken, 0) AS taken
FROM served s LEFT JOIN taken t ON s.key = t.key AND s.rank = t.rank
"""
