"""Spark session settings the models rely on.

The models assume a UTC session (timestamps are instants, day and hour
boundaries are UTC) and ANSI mode (bad casts and division by zero raise,
as the warehouse dialect does). AQE stays on so shuffle partition counts,
skewed joins and broadcast decisions are re-planned from runtime sizes.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every model needs; applied to an existing session too.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the models depend on to a running session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir`` (or one already set on the
    context). Only a local-mode session (tests) without one gets a
    scratch folder; on a cluster a machine-local folder would not survive
    the loss of an executor, so a missing setting is an error there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back:
    computed once, and readable again after the loss of an executor."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tidemark-{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def colocated(df: DataFrame, label: str, key: str) -> DataFrame:
    """``written``, in one sorted bucket per shuffle partition of ``key``: joins and
    groupings by ``key`` read it without another exchange or sort.

    Spark knows of buckets through a catalog table only, so one is made over the
    folder and dropped again once the frame is resolved; the files stay.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tidemark_{label}_{uuid.uuid4().hex[:12]}"
    (df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
     .option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query made inside are deleted when it has ended,
    not when the driver next collects garbage: queries that run one after the
    other hold the files of one of them. A later read makes them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark", warehouse_dir: str | None = None) -> SparkSession:
    """Session for tests and local benchmarking (no UI, UTC, ANSI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
