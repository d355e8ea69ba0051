"""What the operators share: table access, batch limits and written tables."""

from __future__ import annotations

import os
import uuid
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

# Rows and bytes of one Arrow batch handed to a Python worker: a worker holds
# a few batches at a time, so these bound its memory whatever the text lengths.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20

#: White space that separates words in every contract (ASCII only).
SPACE_CLASS = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where the package lies; workers on the same machine, or with the same layout, import it from there.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def bounded_batches(spark: SparkSession) -> None:
    """Hand Python workers small Arrow batches (kept if already smaller), and
    tell them where the package is, as a driver may have found it by its own
    ``sys.path`` only. Elsewhere it is shipped with ``--py-files``."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if not 0 < _number(spark.conf.get(key)) <= most:
            spark.conf.set(key, str(most))


def _number(value: str) -> int:
    digits = value.strip().lower().removesuffix("b")
    return int(digits) if digits.isdigit() else 0


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage at a point every executor can read again, so a lost
    executor costs its running tasks only, and a later plan does not
    repeat the work above. The folders may be deleted once the session
    that made them has ended.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words (runs of anything but ASCII white space); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")), F.lit(0)).cast("long")


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def crc_of(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


def texts_of(series: pd.Series) -> list[str]:
    """The batch's texts with null as the empty text."""
    return [t if isinstance(t, str) else "" for t in series]
