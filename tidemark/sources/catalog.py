"""Sinks and catalog access: views, mart tables with comments, describe.

* View sink (staging, intermediate): ``Warehouse.register_views``
  exposes models as temp views; nothing is materialised.
* Table sink (marts): ``build_marts`` writes every mart as a new version with
  its table and column comments, audits the versions and then switches the
  readers to them (``sources/publish.py``); ``write_mart`` replaces a single
  table in place.
* Discovery: ``list_tables`` and ``describe_table`` return DataFrames
  built from the session catalog, so a caller never needs to parse
  strings on the driver.

Marts are laid out by ranges of their key and sorted within files, so a
point lookup (``where account_id = ...``) finds its key in one file by the
parquet min/max statistics and skips the others.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.models import MODELS, SHARED, Warehouse, upstream
from tidemark.plans.summaries import KPIS, RANKINGS, kpi_row, observed_sums, ranked, summaries_database
from tidemark.sources.glossary import describe
from tidemark.sources.publish import (
    KEPT_VERSIONS, Audit, audited, new_build, prune, publish, sql_string, version_table,
    versions_database, with_comments, write_version,
)

# Key of each mart (one row per key), used to sort rows within files.
MART_KEYS = {
    "mart_customer_churn": "account_id",
    "mart_revenue": "account_id",
    "mart_sales_funnel": "lead_id",
}


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def _laid_out(df: DataFrame, name: str) -> DataFrame:
    """The mart with its comments, by ranges of its key."""
    documented = with_comments(df, {c: describe(name, c) for c in df.columns})
    key = MART_KEYS.get(name)
    return documented.repartitionByRange(key).sortWithinPartitions(key) if key else documented


def _description(name: str) -> str:
    return MODELS[name].description if name in MODELS else ""


def write_mart(spark: SparkSession, df: DataFrame, name: str, database: str = "marts",
               fmt: str = "parquet") -> str:
    """S3 + S4: full-refresh the table ``database.name`` in place, with its comments.

    Column comments travel as field metadata, so the table is created
    with them in one write; the table comment is one catalog call.
    """
    ensure_database(spark, database)
    table = f"{database}.{name}"
    _laid_out(df, name).write.mode("overwrite").format(fmt).saveAsTable(table)
    if _description(name):
        spark.sql(f"COMMENT ON TABLE {table} IS {sql_string(_description(name))}")
    return table


def build_marts(spark: SparkSession, warehouse: Warehouse, database: str = "marts",
                names: tuple[str, ...] = tuple(MART_KEYS), threads: int = 3,
                audit: Audit | None = None, keep: int = KEPT_VERSIONS, summaries: bool = True) -> list[str]:
    """Build the marts as new versions, audit them, then publish them.

    Readers of ``database.<mart>`` see the version before until all marts are
    written and ``audit`` (mart name -> version table, to rows with
    ``failures``) has found nothing; ``AuditFailed`` leaves it that way. The
    newest ``keep`` versions stay. With ``summaries`` the top-k tables and KPIs
    (``plans/summaries.py``) are part of the build.

    The account-grain frames that several marts read (invoice and payment
    totals, billing) are written once, in sorted buckets of their account, so
    the marts join them without moving them again. The marts are written by
    ``threads`` concurrent jobs (the original builds with 4 threads), so their
    independent stages share the cluster instead of queueing; a mart that reads
    none of those frames begins before they are written.
    """
    ensure_database(spark, database)
    ensure_database(spark, versions_database(database))
    build = new_build()
    waiting = [n for n in names if n in MODELS and set(SHARED).intersection(upstream(n))]
    jobs = {}
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for group in ([n for n in names if n not in waiting], waiting):
            if group is waiting:
                warehouse.write_shared()
            plans = {n: _laid_out(warehouse.model(n), n) for n in group}  # plan on one thread
            jobs |= {n: pool.submit(write_version, spark, plans[n], n, build, database, _description(n),
                                    observed=observed_sums(n) if summaries else None) for n in group}
        sums = {n: jobs[n].result() for n in names}
    staged = {n: version_table(n, build, database) for n in names}
    if audit is not None:
        audited(audit, staged, build)
    made = _write_summaries(spark, staged, sums, build, database, threads) if summaries else []
    tables = [publish(spark, n, build, database) for n in names]
    for s in made:
        publish(spark, s, build, summaries_database(database))
    for n, of in [*[(n, database) for n in names], *[(s, summaries_database(database)) for s in made]]:
        prune(spark, n, of, keep)
    return tables


def _write_summaries(spark: SparkSession, staged: dict[str, str], sums: dict[str, dict], build: str,
                     database: str, threads: int) -> list[str]:
    """The ranked tables and KPI rows of a build's marts, as versions of their own."""
    frames = {n: ranked(spark.table(staged[r.mart]), r) for n, r in RANKINGS.items() if r.mart in staged}
    for name, kpis in KPIS.items():
        if kpis.mart in staged:
            frames[name] = kpi_row(spark, kpis, sums[kpis.mart], spark.table(staged[kpis.mart]))
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        jobs = [pool.submit(write_version, spark, df.coalesce(1), n, build, summaries_database(database))
                for n, df in frames.items()]
        for job in jobs:
            job.result()
    return list(frames)


def list_tables(spark: SparkSession, database: str = "marts") -> DataFrame:
    """Tables in ``database`` with their descriptions."""
    rows = [(t.name, t.tableType, t.description) for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(rows, "table_name string, table_type string, description string")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """Column name, type and description of ``table``."""
    return (spark.sql(f"DESCRIBE TABLE {table}")
            .where(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
            .select(F.col("col_name").alias("column_name"), F.col("data_type"),
                    F.col("comment").alias("description")))


__all__ = ["build_marts", "describe_table", "list_tables", "write_mart"]
