"""Stored views: every view against its model, from a session of its own."""

import time
import uuid

import pytest

from conftest import SF_SMALL
from tidemark.operators.quality import union_all
from tidemark.plans.models import MODELS, Warehouse
from tidemark.plans.registry import AS_OF, RUN_TS, _fingerprint, stored_views, warehouse
from tidemark.session import configure, shuffles_released
from tidemark.sources.raw import read_catalog_tables
from tidemark.sources.views import LAYERS, create_views, view_sql


@pytest.fixture(scope="module")
def databases(spark):
    tag = uuid.uuid4().hex[:8]
    names = {k: f"{k}_{tag}" for k in ("raw", "staging", "intermediate")}
    spark.sql(f"CREATE DATABASE {names['raw']}")
    for table, df in warehouse(spark, SF_SMALL).raw.items():
        df.write.saveAsTable(f"{names['raw']}.{table}")
    create_views(spark, **names, as_of=AS_OF)
    yield names
    for n in names.values():
        spark.sql(f"DROP DATABASE IF EXISTS {n} CASCADE")


def test_layers_are_the_registrys():
    for layer, names in LAYERS.items():
        assert list(names) == [n for n, m in MODELS.items() if m.layer == layer] or set(names) == {
            n for n, m in MODELS.items() if m.layer == layer}


@pytest.mark.parametrize("name", [n for names in LAYERS.values() for n in names])
def test_view_equals_model_in_another_session(spark, databases, name):
    other = configure(spark.newSession())
    view = other.table(f"{databases[MODELS[name].layer]}.{name}")
    wh = warehouse(other, SF_SMALL)
    wh.raw = read_catalog_tables(other, databases["raw"])
    model = wh.model(name)
    assert [(f.name, f.dataType) for f in view.schema] == [(f.name, f.dataType) for f in model.schema]
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(view) == rows(model)


def test_views_are_stored_and_replaced(spark, databases):
    listed = {t.name: t for t in spark.catalog.listTables(databases["intermediate"])}
    assert set(LAYERS["intermediate"]) <= set(listed) and not listed["int_payment_health"].isTemporary
    assert listed["int_payment_health"].tableType == "VIEW" and listed["int_payment_health"].description
    assert len(create_views(spark, **databases, as_of=AS_OF)) == 19


def test_views_without_a_fixed_date_use_the_readers(spark, databases):
    assert "current_date()" in view_sql("stg_erp__invoices") and "{" not in view_sql("int_sales_activity")
    plan = spark.table(f"{databases['intermediate']}.int_payment_health")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SortAggregate" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["int_accounts_with_subscriptions", "int_customer_health"])
def test_accounts_take_payments_without_their_order(spark, databases, name):
    """Counts and sums of payments are combined in the tasks: no payment moves for them."""
    models = Warehouse(read_catalog_tables(spark, databases["raw"]), as_of=AS_OF, run_ts=RUN_TS)
    for df in (spark.table(f"{databases['intermediate']}.{name}"), models.model(name)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "Window" not in plan


@pytest.mark.parametrize("name", ["int_payment_health", "int_sales_activity", "int_leads_with_campaigns"])
def test_view_and_model_move_the_rows_once(spark, databases, name):
    models = Warehouse(read_catalog_tables(spark, databases["raw"]), as_of=AS_OF, run_ts=RUN_TS)
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = spark.table(f"{databases['intermediate']}.{name}")
        plan = union_all([_fingerprint(view, name, "view"), _fingerprint(models.model(name), name, "model")]) \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    table = {"int_payment_health": "payments", "int_sales_activity": "opportunities",
             "int_leads_with_campaigns": "leads"}[name]
    assert "ReusedExchange" in plan
    assert plan.count(f"FileScan parquet spark_catalog.{databases['raw']}.{table}[") == 1


@pytest.mark.parametrize("name, own", [("int_payment_health", 0), ("int_sales_activity", 1),
                                       ("int_leads_with_campaigns", 1)])
def test_a_view_adds_no_exchange_to_its_model(spark, databases, name, own):
    """All exchanges are shared but ``own``, the one above a final sort-based aggregate."""
    models = Warehouse(read_catalog_tables(spark, databases["raw"]), as_of=AS_OF, run_ts=RUN_TS)
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def moves(df):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        return sum("Exchange " in x and "ReusedExchange" not in x and "SinglePartition" not in x for x in lines)

    try:
        view = _fingerprint(spark.table(f"{databases['intermediate']}.{name}"), name, "view")
        model = _fingerprint(models.model(name), name, "model")
        assert moves(union_all([view, model])) == moves(model) + own
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffles_of_an_ended_query_are_released(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name)
    with shuffles_released(spark):
        df = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, df.collect()))  # made again
    rows = stored_views(spark, SF_SMALL).collect()
    assert len(rows) == 19 and all(r["same"] for r in rows)
    for _ in range(100):  # files go a little after the query
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(name) == setting
