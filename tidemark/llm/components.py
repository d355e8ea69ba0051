"""Connected components of an edge table, as rounds of joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).head()
    return row["n"], row["h"]


def _with_least(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) with m, the least v of each u. The least values are written
    first, so the join shuffles both sides itself and AQE can split the rows
    of a node with very many neighbours."""
    least = written(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs of any order -> (node, root), root being the least node of
    the component; nodes that are their own root are left out.

    Alternates two steps until nothing changes. Large star: every neighbour
    above a node is tied to the least neighbour (or the node). Small star: the
    neighbours below a node, and the node, are tied to the least of them.
    Each step keeps the components; the rounds grow with the logarithm of the
    longest chain. Every round is written to the shared folder.
    """
    edges = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_with_least(both).where("v > u")
                        .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large-star")
        tied = _with_least(large)
        small = (tied.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(tied.select("u", F.col("m").alias("v"))).distinct())
        edges = written(small, "small-star")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
