"""Every registered query against its DuckDB oracle (row count, column
names and types, and all values, order-insensitive)."""

import pytest

import __spark_entry__ as entry_module
from tidemark.plans.registry import QUERIES as REGISTERED
from conftest import SF_SMALL
from oracle_compare import compare, duck

SQL = entry_module.oracle_sql()
QUERIES = {name: entry_module.queries()[name] for name in REGISTERED}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    result = compare(QUERIES[name](spark, SF_SMALL), SQL[name], con)
    assert result["match"], result


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "revenue_health_band" in df.columns
