"""Small tables built and published with the marts: top-k lists and KPIs.

A ranked list shows at most ``MAX_ROW_LIMIT`` rows of a band, so that many rows
of every band are all such a list can ever need. ``ranked`` keeps them (each
task keeps its own best rows of a band before anything is shuffled), and the
curated lists and rollups run unchanged on that table in place of the mart
(``Serving``). KPIs that are plain sums are observed while the mart is written:
no pass of their own. The funnel's spend counts a campaign once, which a sum
over rows cannot, so two columns of the written funnel are read for it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans import curated as Q
from tidemark.plans import rollups as R


@dataclass(frozen=True)
class Ranking:
    """The best rows of a mart, per value of ``bands``, by ``order``."""
    mart: str
    columns: tuple[str, ...]
    order: Callable[[], list[Column]]
    bands: tuple[str, ...] = ()
    where: Callable[[], Column] | None = None


RANKINGS: dict[str, Ranking] = {
    "accounts_by_risk": Ranking("mart_customer_churn", tuple(Q.CHURN_LIST_COLS), Q.by_mrr_at_risk,
                                ("churn_risk_band",)),
    "highest_risk": Ranking("mart_customer_churn", tuple(R.HIGHEST_RISK_COLS), R.by_risk_score),
    "accounts_by_health": Ranking("mart_revenue", tuple(Q.REVENUE_LIST_COLS), Q.by_arr_at_risk,
                                  ("revenue_health_band",)),
    "poor_collection": Ranking("mart_revenue", tuple(R.POOR_COLLECTION_COLS), R.by_collection, where=R.is_billed),
    "leads_by_outcome": Ranking("mart_sales_funnel", tuple(Q.FUNNEL_LIST_COLS), Q.by_opportunity_amount,
                                ("lead_outcome", "attribution_type")),
    "won_deals": Ranking("mart_sales_funnel", tuple(R.WON_DEAL_COLS) + ("is_won",), Q.by_opportunity_amount,
                         where=R.is_won),
}


def ranked(mart: DataFrame, ranking: Ranking, most: int = Q.MAX_ROW_LIMIT) -> DataFrame:
    """The first ``most`` rows of every band, in any order."""
    rows = (mart.where(ranking.where()) if ranking.where else mart).select(*ranking.columns)
    if not ranking.bands:
        return rows.orderBy(*ranking.order()).limit(most)
    place = F.row_number().over(Window.partitionBy(*ranking.bands).orderBy(*ranking.order()))
    return rows.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")


@dataclass(frozen=True)
class Kpis:
    """What is summed while the mart is written, and the KPI row made of it."""
    mart: str
    sums: Callable[[], dict[str, Column]]
    finish: Callable[[DataFrame], DataFrame]
    rollup: Callable[[DataFrame], DataFrame]   # the same KPIs from the mart's rows
    spend: bool = False


KPIS: dict[str, Kpis] = {
    "churn_kpis": Kpis("mart_customer_churn", R.churn_sums, lambda one: one, R.churn_kpis),
    "revenue_kpis": Kpis("mart_revenue", R.revenue_sums, R.finish_revenue, R.revenue_kpis),
    "funnel_kpis": Kpis("mart_sales_funnel", R.funnel_sums, R.finish_funnel, R.funnel_kpis, spend=True),
}


def observed_sums(mart: str) -> dict[str, Column]:
    """The sums of all KPIs of a mart."""
    return {n: c for k in KPIS.values() if k.mart == mart for n, c in k.sums().items()}


def kpi_row(spark: SparkSession, kpis: Kpis, sums: dict, written: DataFrame) -> DataFrame:
    """The KPI row from the observed sums (and the written mart's campaign spend),
    typed as the rollup types it."""
    schema = written.agg(*[c.alias(n) for n, c in kpis.sums().items()]).schema
    one = spark.createDataFrame([Row(**{n: sums[n] for n in kpis.sums()})], schema)
    if kpis.spend:
        spend = R.campaign_spend(written)
        one = one.withColumn("total_spend", F.lit(spend.first()["total_spend"]).cast(spend.schema[0].dataType))
    return kpis.finish(one).select(*[F.col(f.name).cast(f.dataType) for f in kpis.rollup(written).schema])


class Serving:
    """The ranked lists and KPIs of published marts, read from their summaries."""

    def __init__(self, spark: SparkSession, database: str = "marts"):
        self.spark, self.database = spark, summaries_database(database)

    def _table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def list_high_risk_accounts(self, risk_band: str, row_limit: int = Q.DEFAULT_ROW_LIMIT) -> DataFrame:
        return Q.list_high_risk_accounts(self._table("accounts_by_risk"), risk_band, row_limit)

    def list_accounts_by_revenue_health(self, health_band: str, row_limit: int = Q.DEFAULT_ROW_LIMIT) -> DataFrame:
        return Q.list_accounts_by_revenue_health(self._table("accounts_by_health"), health_band, row_limit)

    def list_leads_by_outcome(self, lead_outcome: str, attribution_type: str = "all",
                              row_limit: int = Q.DEFAULT_ROW_LIMIT) -> DataFrame:
        return Q.list_leads_by_outcome(self._table("leads_by_outcome"), lead_outcome, attribution_type, row_limit)

    def highest_risk_accounts(self, row_limit: int = Q.DEFAULT_ROW_LIMIT) -> DataFrame:
        return R.highest_risk_accounts(self._table("highest_risk"), row_limit)

    def poor_collection_accounts(self, row_limit: int = Q.DEFAULT_ROW_LIMIT) -> DataFrame:
        return R.poor_collection_accounts(self._table("poor_collection"), row_limit)

    def top_won_deals(self, row_limit: int = Q.DEFAULT_ROW_LIMIT) -> DataFrame:
        return R.top_won_deals(self._table("won_deals"), row_limit)

    def churn_kpis(self) -> DataFrame:
        return self._table("churn_kpis")

    def revenue_kpis(self) -> DataFrame:
        return self._table("revenue_kpis")

    def funnel_kpis(self) -> DataFrame:
        return self._table("funnel_kpis")


def summaries_database(database: str) -> str:
    return f"{database}_summaries"
