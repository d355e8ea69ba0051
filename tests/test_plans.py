"""Plan shape of every registered query: the properties that matter at
scale, checked on the physical plan rather than on results."""

import re

import pytest

import __spark_entry__ as entry_module
from conftest import SF_SMALL
from tidemark.plans.explain import formatted_plan, plan_summary

from tidemark.plans.registry import QUERIES as REGISTERED, warehouse

QUERIES = {name: entry_module.queries()[name] for name in REGISTERED}
TOP_K = [n for n in QUERIES if n.startswith(("q2_", "q4_", "q6_", "r3_highest", "r6_", "r11_"))]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_properties(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    text = formatted_plan(df)
    ops = plan_summary(df)["operators"]
    # no cross joins, no nested-loop joins
    assert "CartesianProduct" not in ops and "BroadcastNestedLoopJoin" not in ops
    # windows only appear in the running frames over payments: partitioned by
    # (account, chunk) over rows, or by account over the chunks' summaries
    for args in re.findall(r"\(\d+\) Window\n(?:.*\n)*?Arguments: (.*)", text):
        assert "_chunk" in args, args
    if name in ("v6_quality_suite", "s5_described_marts", "d2_payment_sequence"):
        return  # they scan written models, as wide as the checks need
    # every scan is pruned to the columns it needs (sources have 4-11)
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert schema.count(":") <= 6, schema
    if name in TOP_K:
        assert ops.get("TakeOrderedAndProject") == 1


def scans_of(df, table):
    return sum(f"/{table}.parquet" in loc for loc in
               re.findall(r"Location: InMemoryFileIndex \[([^\]]*)\]", formatted_plan(df)))


@pytest.mark.parametrize("name", ["mart_revenue", "mart_customer_churn"])
def test_payments_are_read_once(spark, name):
    assert scans_of(QUERIES[name](spark, SF_SMALL), "lineitem") == 1


@pytest.mark.parametrize("name", ["int_payment_health", "mart_revenue"])
def test_payments_are_not_aggregated_by_sorting(spark, name):
    assert "SortAggregate" not in plan_summary(QUERIES[name](spark, SF_SMALL))["operators"]


def test_checks_move_their_keys_once(spark):
    """Every model is read once, and one exchange groups the keys of all checks."""
    from tidemark.operators.quality import CHECKS, run_checks

    models = {}

    def model(name):
        assert name not in models, f"{name} is resolved twice"
        columns = {c.column: "string" for c in CHECKS if c.model == name} | {
            c.to_column: "string" for c in CHECKS if c.to_model == name}
        columns |= {c: "long" for c in columns if c.startswith("days_")}
        models[name] = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in columns.items())).repartition(2)
        return models[name]

    summary = plan_summary(run_checks(model))["operators"]
    assert len(models) == 22
    # one per model's stand-in here, one for the keys, one for the sums of a check (a row per check and task)
    assert summary["Exchange"] - 22 <= 2
    assert summary.get("SortMergeJoin", 0) == 0


def test_funnel_moves_leads_by_full_keys_only(spark):
    """Without broadcasts, no join of the leads has a key that is often NULL."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["mart_sales_funnel"](spark, SF_SMALL)
        text = formatted_plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    left = re.findall(r"Left keys \[\d+\]: \[([^\]]*)\]", text)
    keys = [k for k in (re.sub(r"#\d+L?", "", k) for k in left) if k != "c_nationkey"]
    # leads: the two spread keys and their own id; the others are dimensions'
    assert sorted(keys) == ["_key", "_key", "account_id", "lead_id", "opportunity_id"]


def exchanges_above(plan, path_part):
    """Scans of a path in a tree string, and how many reach a join through an exchange."""
    lines, scans, moved = plan.splitlines(), 0, 0
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if path_part not in line:
            continue
        scans += 1
        at = depth(line)
        for above in reversed(lines[:i]):
            if depth(above) < at:
                at = depth(above)
                if "Join" in above:
                    break
                if "Exchange" in above:
                    moved += 1
                    break
    return scans, moved


def test_account_helpers_are_colocated(spark):
    """With broadcasts off, a build's account joins read the written helpers
    without moving or sorting them again."""
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.maxMetadataStringLength")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        wh = warehouse(spark, SF_SMALL)
        wh.write_shared()
        wh._write("customer_health_with_billing")
        plans = {n: wh.model(n)._jdf.queryExecution().executedPlan().toString()
                 for n in ("int_payment_health", "mart_customer_churn")}
        fresh = warehouse(spark, SF_SMALL)
        fresh.write_shared()
        plans["customer_health_with_billing"] = (fresh.model("customer_health_with_billing")
                                                 ._jdf.queryExecution().executedPlan().toString())
        rows = wh.model("mart_customer_churn").count()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert rows == warehouse(spark, SF_SMALL).model("mart_customer_churn").count()
    for name, helper, n in (("int_payment_health", "account_payment_totals", 1),
                            ("int_payment_health", "account_invoice_totals", 1),
                            ("customer_health_with_billing", "account_billing", 1),
                            ("mart_customer_churn", "customer_health_with_billing", 1)):
        assert exchanges_above(plans[name], f"tidemark_{helper}_") == (n, 0), (name, helper, plans[name])
