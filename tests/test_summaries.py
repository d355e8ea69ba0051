"""Top-k tables and KPIs built with the marts: equal to the marts' own, and read in their place."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.plans import curated as Q
from tidemark.plans import rollups as R
from tidemark.plans.registry import warehouse
from tidemark.plans.summaries import RANKINGS, Serving, ranked, summaries_database
from tidemark.sources import publish
from tidemark.sources.catalog import build_marts


@pytest.fixture(scope="module")
def built(spark):
    database = f"sums_{uuid.uuid4().hex[:8]}"
    build_marts(spark, warehouse(spark, SF_SMALL), database)
    yield database
    for d in (database, summaries_database(database)):
        for name in (d, publish.versions_database(d)):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def same(a, b):
    assert [r.asDict() for r in a.collect()] == [r.asDict() for r in b.collect()]


@pytest.mark.parametrize("limit", [1, 20, 200])
def test_lists_equal_the_marts(spark, built, limit):
    churn, revenue, funnel = (spark.table(f"{built}.{m}") for m in
                              ("mart_customer_churn", "mart_revenue", "mart_sales_funnel"))
    s = Serving(spark, built)
    for band in Q.RISK_BANDS:
        same(s.list_high_risk_accounts(band, limit), Q.list_high_risk_accounts(churn, band, limit))
    for band in Q.REVENUE_HEALTH_BANDS:
        same(s.list_accounts_by_revenue_health(band, limit), Q.list_accounts_by_revenue_health(revenue, band, limit))
    for outcome in Q.LEAD_OUTCOMES:
        for kind in Q.ATTRIBUTION_TYPES:
            same(s.list_leads_by_outcome(outcome, kind, limit), Q.list_leads_by_outcome(funnel, outcome, kind, limit))
    same(s.highest_risk_accounts(limit), R.highest_risk_accounts(churn, limit))
    same(s.poor_collection_accounts(limit), R.poor_collection_accounts(revenue, limit))
    same(s.top_won_deals(limit), R.top_won_deals(funnel, limit))


def test_lists_do_not_read_the_marts(spark, built):
    s = Serving(spark, built)
    for df in (s.list_high_risk_accounts("high"), s.list_leads_by_outcome("closed_won"), s.top_won_deals()):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        files = " ".join(df.inputFiles())
        assert "mart_" not in files and "_summaries" in files, (plan, files)


def test_kpis_equal_the_rollups(spark, built):
    s = Serving(spark, built)
    same(s.churn_kpis(), R.churn_kpis(spark.table(f"{built}.mart_customer_churn")))
    same(s.revenue_kpis(), R.revenue_kpis(spark.table(f"{built}.mart_revenue")))
    same(s.funnel_kpis(), R.funnel_kpis(spark.table(f"{built}.mart_sales_funnel")))


def test_bands_keep_the_best_rows_of_a_hot_band(spark):
    ranking = RANKINGS["accounts_by_risk"]
    df = spark.range(3000).select(
        F.concat(F.lit("A"), "id").alias("account_id"), F.lit("n").alias("account_name"), F.lit("t").alias("tier"),
        F.lit(1.0).alias("churn_risk_score"), F.when(F.col("id") % 3 < 2, "high").otherwise(None).alias("churn_risk_band"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("mrr_at_risk"), F.lit(0).alias("arr_at_risk"),
        F.lit("").alias("recommended_action"))
    kept = ranked(df, ranking, 50)
    assert kept.groupBy("churn_risk_band").count().orderBy("churn_risk_band").collect() == [(None, 50), ("high", 50)]
    want = df.where("churn_risk_band = 'high'").orderBy(*ranking.order()).limit(50)
    assert sorted(kept.where("churn_risk_band = 'high'").collect()) == sorted(want.select(*ranking.columns).collect())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan   # a task keeps its best rows only


def test_an_empty_build(spark):
    database = f"sums_{uuid.uuid4().hex[:8]}"

    class Empty:
        def __init__(self):
            self.wh = warehouse(spark, SF_SMALL)

        def model(self, name):
            return self.wh.model(name).limit(0)

        def write_shared(self):
            pass

    build_marts(spark, Empty(), database)
    s = Serving(spark, database)
    assert s.list_high_risk_accounts("high").count() == 0
    same(s.churn_kpis(), R.churn_kpis(spark.table(f"{database}.mart_customer_churn")))
    same(s.funnel_kpis(), R.funnel_kpis(spark.table(f"{database}.mart_sales_funnel")))
