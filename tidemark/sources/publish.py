"""Write, audit, publish: marts are replaced in one catalog step (S3).

Every build writes its marts as new tables, ``<database>_versions.<mart>__<build>``.
Readers use ``<database>.<mart>``, a stored view of one version. Only when all
marts of a build are written, and its audit has found nothing, are the views
switched: one catalog call a mart, which replaces the view's definition. A build
that dies, or whose audit fails, leaves every view on the version before it.

A query that began on a version keeps its files: ``prune`` keeps the newest
versions up to the published one, and everything newer (a build that may still
be running). An earlier version is put back with ``publish``.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BUILD = "tidemark.build"   # table property: the build that wrote a version, or that a view shows
KEPT_VERSIONS = 2


class AuditFailed(RuntimeError):
    """The audit of a build found failures; nothing was published."""

    def __init__(self, build: str, failures: Sequence):
        super().__init__(f"build {build} is not published: " + "; ".join(str(f) for f in failures))
        self.build, self.failures = build, failures


def sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def new_build() -> str:
    """A name that sorts by the time the build began."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dt%H%M%S%f}_{uuid.uuid4().hex[:6]}"


def versions_database(database: str) -> str:
    return f"{database}_versions"


def version_table(name: str, build: str, database: str) -> str:
    return f"{versions_database(database)}.{name}__{build}"


def write_version(spark: SparkSession, documented: DataFrame, name: str, build: str, database: str,
                  description: str = "", fmt: str = "parquet", observed: Mapping[str, Column] | None = None) -> dict:
    """Write one table of a build; nobody reads it before it is published.

    ``observed``: sums to be taken while the rows are written, returned by name.
    They are taken in the writing tasks, behind every shuffle, so a task that
    runs again is counted once.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {versions_database(database)}")
    table = version_table(name, build, database)
    seen = Observation()
    rows = documented.observe(seen, *[c.alias(n) for n, c in observed.items()]) if observed else documented
    rows.write.format(fmt).saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BUILD}' = '{build}')")
    if description:
        spark.sql(f"COMMENT ON TABLE {table} IS {sql_string(description)}")
    return dict(seen.get) if observed else {}


def versions(spark: SparkSession, name: str, database: str) -> list[str]:
    """The builds that have a version of the mart, oldest first. A catalog call."""
    if not spark.catalog.databaseExists(versions_database(database)):
        return []
    of = re.compile(rf"{re.escape(name)}__(\d{{8}}t\d{{12}}_[0-9a-f]{{6}})$")
    found = (of.match(t.name) for t in spark.catalog.listTables(versions_database(database)))
    return sorted(m.group(1) for m in found if m)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def published_build(spark: SparkSession, name: str, database: str) -> str | None:
    """The build that ``<database>.<name>`` shows, None before the first one."""
    table = f"{database}.{name}"
    return _properties(spark, table).get(BUILD) if spark.catalog.tableExists(table) else None


def publish(spark: SparkSession, name: str, build: str, database: str) -> str:
    """Switch ``<database>.<name>`` to the build's version: one catalog call.

    A plain table of that name, as earlier releases wrote it, is renamed first.
    """
    target, version = f"{database}.{name}", version_table(name, build, database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if spark.catalog.tableExists(target) and spark.catalog.getTable(target).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {target} RENAME TO {target}__before_{build}")
    listed = []
    for field in spark.table(version).schema.fields:
        comment = field.metadata.get("comment")
        listed.append(f"`{field.name}`" + (f" COMMENT {sql_string(comment)}" if comment else ""))
    described = spark.catalog.getTable(version).description
    spark.sql(f"CREATE OR REPLACE VIEW {target} ({', '.join(listed)}) "
              + (f"COMMENT {sql_string(described)} " if described else "")
              + f"TBLPROPERTIES ('{BUILD}' = '{build}') AS SELECT * FROM {version}")
    return target


def prune(spark: SparkSession, name: str, database: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Drop versions older than the newest ``keep`` up to the published one."""
    current = published_build(spark, name, database)
    if current is None:
        return []
    old = [b for b in versions(spark, name, database) if b <= current]
    gone = [b for b in old[:-keep] if b != current] if keep > 0 else [b for b in old if b != current]
    for build in gone:
        spark.sql(f"DROP TABLE IF EXISTS {version_table(name, build, database)}")
    return gone


Audit = Callable[[Mapping[str, str]], DataFrame]


def audited(audit: Audit, staged: Mapping[str, str], build: str) -> None:
    """Run the audit on a build's versions (mart name -> table). It returns one
    row per check with its number of ``failures``; any above 0 stops the build."""
    failed = audit(staged).where(F.col("failures") > 0).limit(20).collect()
    if failed:
        raise AuditFailed(build, [r.asDict() for r in failed])


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """The frame with comments as field metadata, which a saved table keeps."""
    schema = StructType([StructField(f.name, f.dataType, f.nullable,
                                     {**f.metadata, **({"comment": comments[f.name]} if comments.get(f.name) else {})})
                         for f in df.schema.fields])
    return df.select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in schema.fields])
