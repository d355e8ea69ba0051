"""Raw-table scans (S1) and the view sink."""

import os
import tempfile

from conftest import SF_SMALL
from tidemark.plans.models import MODELS, Warehouse, by_tag, upstream
from tidemark.sources.fixtures import RAW_TABLES, raw_tables
from tidemark.sources.raw import SOURCE_GROUPS, read_parquet_tables, write_parquet_tables


def test_source_groups_cover_raw_tables():
    assert sorted(t for ts in SOURCE_GROUPS.values() for t in ts) == sorted(RAW_TABLES)


def test_parquet_layout_round_trip(spark):
    raw = raw_tables(spark, SF_SMALL)
    root = os.path.join(tempfile.mkdtemp(prefix="tidemark-raw-"), "raw")
    write_parquet_tables(raw, root)
    back = read_parquet_tables(spark, root)
    assert set(back) == set(RAW_TABLES)
    for name in ("accounts", "payments", "web_events"):
        assert back[name].count() == raw[name].count()
        assert back[name].schema.fieldNames() == raw[name].schema.fieldNames()
    # models build the same from the landed tables
    a = Warehouse(back).model("stg_crm__accounts").orderBy("account_id").collect()
    b = Warehouse(raw).model("stg_crm__accounts").orderBy("account_id").collect()
    assert a == b


def test_views_are_queryable_with_sql(spark):
    wh = Warehouse(raw_tables(spark, SF_SMALL))
    names = wh.register_views(layer="staging")
    assert len(names) == 14
    n = spark.sql("SELECT count(*) AS n FROM stg_crm__accounts WHERE tier_rank > 0").first().n
    assert n == wh.model("stg_crm__accounts").where("tier_rank > 0").count()


def test_registry_layers_and_dag():
    layers = {}
    for m in MODELS.values():
        layers[m.layer] = layers.get(m.layer, 0) + 1
    assert layers == {"staging": 14, "intermediate": 5, "marts": 3, "helper": 4}
    assert set(by_tag("marts")) == {"mart_customer_churn", "mart_revenue", "mart_sales_funnel"}
    order = upstream("mart_customer_churn")
    assert order[-1] == "mart_customer_churn"
    assert order.index("account_payment_totals") < order.index("account_billing") \
        < order.index("customer_health_with_billing")
    assert "account_invoice_totals" in upstream("int_payment_health")


def test_run_entry_point_builds_and_checks(spark):
    from tidemark.plans.run import main

    root = os.path.join(tempfile.mkdtemp(prefix="tidemark-run-"), "raw")
    write_parquet_tables(raw_tables(spark, SF_SMALL), root)
    status = main(["--raw-root", root, "--database", "run_marts", "--as-of", "2002-01-01",
                   "--checks"])
    assert status == 1  # the test data hold one line item twice
    results = spark.table("run_marts.quality_results")
    assert results.count() == 95
    assert [(r["model"], r["test"]) for r in results.where("failures > 0").collect()] == [
        ("stg_erp__payments", "unique")]
    assert spark.table("run_marts.mart_revenue").count() == \
        spark.table("run_marts.mart_customer_churn").count()


def test_a_lookup_finds_its_key_in_one_file(spark):
    """Marts are laid out by ranges of their key: no two files share a key."""
    import glob

    import pyarrow.parquet as pq

    from tidemark.sources.catalog import write_mart

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).selectExpr("concat('A', id) as account_id", "id as total_arr").repartition(5)
        write_mart(spark, df, "mart_revenue", database="range_marts")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    root = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    ranges = []
    for file in glob.glob(f"{root}/range_marts.db/mart_revenue/*.parquet"):
        stats = pq.ParquetFile(file).metadata.row_group(0).column(0).statistics
        ranges.append((stats.min, stats.max))
    ranges.sort()
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
