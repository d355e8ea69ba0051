"""Tiny in-memory raw tables for hand-computed semantic tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from tidemark.plans.models import Warehouse
from tidemark.sources.fixtures import RAW_TABLES, TestData

AS_OF = dt.date(2002, 1, 1)
RUN_TS = dt.datetime(2002, 1, 1)

_SCHEMAS: dict = {}


def raw_schema(spark: SparkSession, table: str):
    if table not in _SCHEMAS:
        schema = TestData(spark, "/root/testdata/sf0.001").raw(table).schema
        _SCHEMAS[table] = StructType([StructField(f.name, f.dataType, True) for f in schema])
    return _SCHEMAS[table]


def raw(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    schema = raw_schema(spark, table)
    names = schema.fieldNames()
    for r in rows:
        unknown = set(r) - set(names)
        assert not unknown, f"{table}: unknown columns {unknown}"
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def warehouse(spark: SparkSession, **tables: list[dict]) -> Warehouse:
    """A warehouse over the given raw rows; other raw tables are empty."""
    return Warehouse({t: raw(spark, t, tables.get(t, [])) for t in RAW_TABLES},
                     as_of=AS_OF, run_ts=RUN_TS)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)
