"""Readers for the 14 raw source tables in production layouts.

Two layouts are supported: one parquet dataset per table under a root
folder (``<root>/<group>/<table>``), or tables in the Spark catalog
(``raw.<table>``). Both are plain scans, so column pruning and filter
pushdown from the models reach the files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# The raw tables and the source group each belongs to.
SOURCE_GROUPS = {
    "crm": ["accounts", "contacts", "leads", "opportunities", "campaigns",
            "activities", "support_tickets"],
    "erp": ["products", "orders", "invoices", "subscriptions", "payments"],
    "web": ["web_events", "feature_usage"],
}


def group_of(table: str) -> str:
    for group, tables in SOURCE_GROUPS.items():
        if table in tables:
            return group
    raise KeyError(f"unknown raw table {table!r}")


class LazyTables(Mapping):
    """Raw tables built on first use, so a model pays only for its inputs."""

    def __init__(self, build: Callable[[str], DataFrame], names: Sequence[str]):
        self._build, self._names, self._built = build, tuple(names), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


ALL_TABLES = tuple(t for tables in SOURCE_GROUPS.values() for t in tables)


def read_parquet_tables(spark: SparkSession, root: str) -> Mapping[str, DataFrame]:
    """Scan ``<root>/<group>/<table>`` parquet datasets (opened on first use)."""
    root = root.rstrip("/")
    return LazyTables(lambda t: spark.read.parquet(f"{root}/{group_of(t)}/{t}"), ALL_TABLES)


def read_catalog_tables(spark: SparkSession, database: str = "raw") -> Mapping[str, DataFrame]:
    """Read ``<database>.<table>`` from the session catalog (on first use)."""
    return LazyTables(lambda t: spark.table(f"{database}.{t}"), ALL_TABLES)


def write_parquet_tables(raw: Mapping[str, DataFrame], root: str) -> None:
    """Land raw DataFrames in the ``read_parquet_tables`` layout."""
    root = root.rstrip("/")
    for table, df in raw.items():
        df.write.mode("overwrite").parquet(f"{root}/{group_of(table)}/{table}")
