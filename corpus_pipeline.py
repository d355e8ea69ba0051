"""The corpus pipeline: documents in, tokenised training mix out.

Every stage calls one operator of ``tidemark.llm`` on all rows that the stage
before it kept; ``run`` writes each stage's result as Parquet in the shared
folder and reads it again for the next one. All stages but the last return
the columns of ``documents``.

1. quality    rejects documents that score below 0.5
2. near_dups  keeps one document of each SimHash component
3. secrets    replaces secrets in the texts by their kind (n_chars follows)
4. mix        repeats or drops documents so that sources reach their targets
5. tokens     encodes the texts, and decodes the ids to check the round trip

All stages take nulls in any column, empty and very long texts, ties, repeated
rows, a table without rows and extra columns of any names (one with a dot or one
that a stage uses itself included); what each gives for them stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, quality, secrets, simhash
from tidemark.llm.common import bounded_batches, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text scores 0.5 or more (a null text scores as an empty one),
    by a model learned from these rows. Without labels of both kinds a score is the
    share of label 1, 0.5 without any, so all rows or none stay. Equal texts score
    alike, so repeated rows stay or go together; columns pass through."""
    bounded_batches(spark)
    model = quality.learned(spark, docs, sf_dir)
    return docs.where(quality.score_column(spark, model, F.col("text")) >= 0.5)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: the one of the smallest id, rows without
    one last, among equal ids by a hash of the whole row; of equal rows one. Null
    texts, empty ones and those of white space alone are near duplicates of one
    another (fingerprint zero). Columns pass through."""
    return simhash.drop_near_duplicates(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its text redacted and n_chars counted anew; a null text stays
    null, as does its n_chars. Repeated rows stay, extra columns pass through."""
    bounded_batches(spark)
    clean = docs.withColumn("text", secrets.redacted_column(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row 0, 1 or 2 times, as the mix takes it. A null source is a source of
    its own, the last; repeated rows are numbered and taken one by one; a text
    without words adds nothing to the sizes and is taken by its place in the queue,
    a source without any word is not taken. Columns pass through."""
    return mixing.mix(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, exact (whether the decoded ids are the text),
    one row per row. A null text is encoded as an empty one: no ids, exact."""
    bounded_batches(spark)
    encoded = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "result", bpe.round_trip(spark, F.col("text")))
    return encoded.select("doc_id", "lang", "source", F.size("result.ids").cast("long").alias("n_tokens"),
                          "result.ids", "result.exact")


STAGES = [
    ("quality", quality_stage),
    ("near_dups", near_duplicates_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Learned scores, XXH64 fingerprints and BPE have no SQL: tests/llm/test_pipeline.py
# compares run() with a plain Python version of every stage instead.
ORACLE_SQL = None
