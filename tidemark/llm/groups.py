"""Groups of any size in tasks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def cut_hot_groups(rows: DataFrame, keys: list[str], member: str, most: int) -> DataFrame:
    """``rows`` with a column ``chunks`` that cuts groups of more than ``most``
    members into smaller ones: the members are dealt by hash into chunks of
    half that size, and every two chunks make a group, so any two members
    still meet. Members are repeated once per other chunk."""
    hot = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
                  .select(*keys, F.ceil(F.col("n") / (most // 2)).alias("m")), "hot-keys")
    if hot.head() is None:
        return rows.withColumn("chunks", F.lit(0).cast("long"))
    others = F.when(F.col("m").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("m") - 1))
    return (rows.join(hot, keys, "left")
            .withColumn("own", F.when(F.col("m").isNotNull(), F.pmod(F.xxhash64(member), F.col("m"))))
            .withColumn("other", F.explode(others))
            .where("m is null or own != other")
            .withColumn("chunks", F.when(F.col("m").isNull(), F.lit(0).cast("long")).otherwise(
                F.least("own", "other") * F.col("m") + F.greatest("own", "other")))
            .select(*rows.columns, "chunks"))


def whole_groups(keys: list[str], work: Callable[[pd.DataFrame], Iterator[pd.DataFrame]],
                 buffer_rows: int) -> Callable:
    """A ``mapInPandas`` function over rows sorted by ``keys`` that calls
    ``work`` with frames of whole groups, about ``buffer_rows`` rows at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, n = [], 0
        for batch in batches:
            kept.append(batch)
            n += len(batch)
            if n < buffer_rows:
                continue
            frame = pd.concat(kept, ignore_index=True)
            last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
            cut = len(frame) - int(last.sum())
            if cut:
                yield from work(frame.iloc[:cut])
            kept, n = [frame.iloc[cut:]], len(frame) - cut
        if n:
            yield from work(pd.concat(kept, ignore_index=True))

    return run
