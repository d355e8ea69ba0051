"""Write, audit, publish: readers keep the old mart until the new build is whole."""

import functools
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators.quality import Check, run_checks
from tidemark.plans.registry import warehouse
from tidemark.sources import catalog, publish
from tidemark.sources.catalog import list_tables

MART = "mart_revenue"
build_marts = functools.partial(catalog.build_marts, summaries=False)   # the stand-in has three columns


@pytest.fixture()
def database(spark):
    name = f"wap_{uuid.uuid4().hex[:8]}"
    yield name
    for d in (name, publish.versions_database(name)):
        spark.sql(f"DROP DATABASE IF EXISTS {d} CASCADE")


class Marts:
    """Stands in for a warehouse: one small mart with a marker column."""

    def __init__(self, spark, marker, rows=20):
        self.df = spark.range(rows).select(F.concat(F.lit("A"), "id").alias("account_id"),
                                           F.lit(marker).alias("tier"), F.col("id").alias("total_arr"))

    def model(self, name):
        return self.df

    def write_shared(self):
        pass


def seen(spark, database):
    return [r[0] for r in spark.table(f"{database}.{MART}").select("tier").distinct().collect()]


def test_a_build_that_dies_midway_leaves_the_old_mart(spark, database, monkeypatch):
    build_marts(spark, Marts(spark, "old"), database, (MART,))
    broken = Marts(spark, "new")
    broken.df = broken.df.withColumn("tier", F.when(F.col("total_arr") == 13, F.raise_error(F.lit("lost")))
                                     .otherwise(F.col("tier")))
    with pytest.raises(Exception, match="lost"):
        build_marts(spark, broken, database, (MART,))
    assert seen(spark, database) == ["old"]
    # dies after the versions are written, before the switch
    monkeypatch.setattr(catalog, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        build_marts(spark, Marts(spark, "newer"), database, (MART,))
    assert seen(spark, database) == ["old"]
    monkeypatch.undo()
    build_marts(spark, Marts(spark, "newest"), database, (MART,))
    assert seen(spark, database) == ["newest"]


def test_a_failing_audit_keeps_the_old_mart(spark, database):
    def audit(staged):
        return run_checks(lambda n: spark.table(staged[n]), [Check(MART, "account_id", "unique"),
                                                             Check(MART, "tier", "not_null")])

    build_marts(spark, Marts(spark, "old"), database, (MART,), audit=audit)
    twice = Marts(spark, "new")
    twice.df = twice.df.unionByName(twice.df)
    with pytest.raises(publish.AuditFailed) as stopped:
        build_marts(spark, twice, database, (MART,), audit=audit)
    assert [f["test"] for f in stopped.value.failures] == ["unique"] and stopped.value.failures[0]["failures"] == 20
    assert seen(spark, database) == ["old"]
    assert spark.table(publish.version_table(MART, stopped.value.build, database)).count() == 40   # to look into


def test_readers_of_another_session_switch_as_well(spark, database):
    build_marts(spark, Marts(spark, "old"), database, (MART,))
    other = spark.newSession()
    assert seen(other, database) == ["old"]
    begun = other.table(f"{database}.{MART}")   # a query that began before the switch
    build_marts(spark, Marts(spark, "new", rows=7), database, (MART,))
    assert seen(other, database) == ["new"] and other.table(f"{database}.{MART}").count() == 7
    assert begun.count() == 20


def test_versions_are_pruned_and_put_back(spark, database):
    builds = []
    for k in range(4):
        build_marts(spark, Marts(spark, f"v{k}"), database, (MART,), keep=2)
        builds.append(publish.published_build(spark, MART, database))
    assert publish.versions(spark, MART, database) == builds[2:]
    publish.publish(spark, MART, builds[2], database)
    assert seen(spark, database) == ["v2"] and publish.published_build(spark, MART, database) == builds[2]
    assert publish.prune(spark, MART, database, keep=0) == []   # the newer one may be a running build


def test_schema_changes_and_plain_tables_are_replaced(spark, database):
    catalog.write_mart(spark, Marts(spark, "table").df, MART, database)
    build_marts(spark, Marts(spark, "view"), database, (MART,))
    assert seen(spark, database) == ["view"]
    wider = Marts(spark, "wide")
    wider.df = wider.df.withColumn("it's", F.lit(1)).drop("total_arr")
    build_marts(spark, wider, database, (MART,))
    assert spark.table(f"{database}.{MART}").columns == ["account_id", "tier", "it's"]


def test_whole_build_with_gate(spark, database):
    wh = warehouse(spark, SF_SMALL)
    tables = build_marts(spark, wh, database, audit=lambda staged: run_checks(
        lambda n: spark.table(staged[n]), [Check(m, k, "unique") for m, k in catalog.MART_KEYS.items()]))
    assert {r.table_name for r in list_tables(spark, database).collect()} == set(catalog.MART_KEYS)
    assert len(tables) == 3 and len({publish.published_build(spark, m, database) for m in catalog.MART_KEYS}) == 1


def test_a_mart_without_shared_frames_does_not_wait_for_them(spark, database):
    """The funnel reads no account frame: its job begins before those are written."""
    asked = []

    class Ordered(Marts):
        def model(self, name):
            asked.append(name)
            return self.df.withColumn("lead_id", F.col("account_id"))

        def write_shared(self):
            asked.append("shared")

    build_marts(spark, Ordered(spark, "x"), database, ("mart_revenue", "mart_sales_funnel"), summaries=False)
    assert asked == ["mart_sales_funnel", "shared", "mart_revenue"]
