"""Curated queries: argument rules, top-k order, and the table sink."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.plans import curated as Q
from tidemark.plans.registry import warehouse
from tidemark.sources.catalog import build_marts, describe_table, list_tables


@pytest.fixture(scope="module")
def marts(spark):
    wh = warehouse(spark, SF_SMALL)
    return {n: wh.model(n) for n in ("mart_customer_churn", "mart_revenue",
                                     "mart_sales_funnel")}


@pytest.mark.parametrize("call", [
    lambda m: Q.list_high_risk_accounts(m["mart_customer_churn"], "severe"),
    lambda m: Q.list_high_risk_accounts(m["mart_customer_churn"], "high", 0),
    lambda m: Q.list_high_risk_accounts(m["mart_customer_churn"], "high", 201),
    lambda m: Q.list_accounts_by_revenue_health(m["mart_revenue"], "great"),
    lambda m: Q.list_leads_by_outcome(m["mart_sales_funnel"], "won"),
    lambda m: Q.list_leads_by_outcome(m["mart_sales_funnel"], "closed_won", "paid"),
    lambda m: Q.get_account_churn_risk(m["mart_customer_churn"], ""),
])
def test_bad_arguments_raise(marts, call):
    with pytest.raises(ValueError):
        call(marts)


def test_top_k_is_sorted_and_capped(marts):
    rows = Q.list_high_risk_accounts(marts["mart_customer_churn"], "critical", 200).collect()
    assert 0 < len(rows) <= 200
    keys = [(-float(r.mrr_at_risk), r.account_id) for r in rows]
    assert keys == sorted(keys)
    assert {r.churn_risk_band for r in rows} == {"critical"}


def test_top_k_plans_as_take_ordered(marts):
    df = Q.list_accounts_by_revenue_health(marts["mart_revenue"], "critical")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_lookup_returns_one_row(marts):
    some = marts["mart_customer_churn"].select("account_id").orderBy("account_id").first()[0]
    assert Q.get_account_churn_risk(marts["mart_customer_churn"], some).count() == 1
    assert Q.get_account_revenue_health(marts["mart_revenue"], "no-such-id").count() == 0


def test_funnel_summary_counts_every_lead(marts):
    funnel = marts["mart_sales_funnel"]
    summary = Q.get_funnel_summary_by_stage(funnel).collect()
    assert sum(r.lead_count for r in summary) == funnel.count()
    assert [r.funnel_stage for r in summary] == sorted(r.funnel_stage for r in summary)


def test_marts_written_with_comments(spark):
    wh = warehouse(spark, SF_SMALL)
    tables = build_marts(spark, wh, database="test_marts")
    assert tables == ["test_marts.mart_customer_churn", "test_marts.mart_revenue",
                      "test_marts.mart_sales_funnel"]
    listed = {r.table_name: r.description for r in list_tables(spark, "test_marts").collect()}
    assert set(listed) == {"mart_customer_churn", "mart_revenue", "mart_sales_funnel"}
    assert listed["mart_revenue"]
    cols = {r.column_name: r.description
            for r in describe_table(spark, "test_marts.mart_customer_churn").collect()}
    assert "churn_risk_score" in cols and cols["churn_risk_score"]
    assert all(cols.values()), [c for c, text in cols.items() if not text]
    written = spark.table("test_marts.mart_revenue")
    assert written.count() == wh.model("mart_revenue").count()
    lookup = Q.get_account_revenue_health(written, "A7")
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(account_id), EqualTo(account_id,A7)]" in plan
    assert written.where(F.col("mart_updated_at").isNull()).count() == 0
