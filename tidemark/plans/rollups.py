"""Dashboard rollups over the marts (churn, revenue and funnel pages).

All are aggregations with a partial stage before the shuffle, so a band,
tier or campaign that holds a large share of the rows costs one partial
row per task. Money sums stay decimal (exact, independent of the order
of addition); ratios of money are rounded once from a wide quotient.

Campaign spend repeats on every lead row of the funnel mart, so spend is
first reduced to one row per campaign (``campaign_spend``), then summed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import exact_ratio, money_pct
from tidemark.plans.curated import DEFAULT_ROW_LIMIT, by_opportunity_amount, top


def _at_risk() -> Column:
    """Bands with a non-zero revenue-at-risk weight (all but low)."""
    return F.col("churn_risk_band") != F.lit("low")


def money_ratio(num: Column, den: Column) -> Column:
    """round(num / den, 2) for money sums, rounded once; NULL if den is 0."""
    return exact_ratio(num, F.nullif(den, F.lit(0)))


# ---------------------------------------------------------------- churn
def _summed(df: DataFrame, sums: dict[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in sums.items()])


def churn_sums() -> dict[str, Column]:
    return {"accounts": F.count(F.lit(1)), "accounts_at_risk": F.count_if(_at_risk()), "total_mrr": F.sum("total_mrr"),
            "mrr_at_risk": F.sum("mrr_at_risk"), "arr_at_risk": F.sum("arr_at_risk")}


def churn_kpis(churn: DataFrame) -> DataFrame:
    """Accounts, accounts at risk, MRR and ARR at risk."""
    return _summed(churn, churn_sums())


def churn_by_band(churn: DataFrame) -> DataFrame:
    """R2: MRR / ARR and the at-risk share per churn risk band."""
    return churn.groupBy("churn_risk_band").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.sum("total_mrr").alias("total_mrr"),
        F.sum("mrr_at_risk").alias("mrr_at_risk"),
        F.sum("arr_at_risk").alias("arr_at_risk"),
    )


HIGHEST_RISK_COLS = ["account_id", "account_name", "tier", "churn_risk_score", "churn_risk_band", "mrr_at_risk",
                     "recommended_action"]


def by_risk_score() -> list[Column]:
    return [F.col("churn_risk_score").desc_nulls_last(), F.col("mrr_at_risk").desc_nulls_last(),
            F.col("account_id").asc()]


def highest_risk_accounts(churn: DataFrame, row_limit: int = DEFAULT_ROW_LIMIT) -> DataFrame:
    """The riskiest accounts with their recommended action."""
    return top(churn.select(*HIGHEST_RISK_COLS), by_risk_score(), row_limit)


def risk_bubble(churn: DataFrame) -> DataFrame:
    """One point per account (usage against risk, sized by MRR)."""
    return churn.select("account_id", "account_name", "total_usage_count", "churn_risk_score",
                        "total_mrr", "churn_risk_band")


# -------------------------------------------------------------- revenue
def revenue_sums() -> dict[str, Column]:
    return {"total_mrr": F.sum("total_mrr"), "total_arr": F.sum("total_arr"), "accounts": F.count(F.lit(1)),
            "billed": F.sum("total_billed"), "collected": F.sum("total_collected"),
            "total_outstanding": F.sum("total_outstanding")}


def finish_revenue(sums: DataFrame) -> DataFrame:
    """The KPI row from one row of ``revenue_sums``."""
    return sums.select("total_mrr", "total_arr", "accounts",
                       money_pct(F.col("collected"), F.nullif(F.col("billed"), F.lit(0))).alias("collection_rate_pct"),
                       "total_outstanding")


def revenue_kpis(revenue: DataFrame) -> DataFrame:
    """MRR, ARR, accounts, collection rate and outstanding balance."""
    return finish_revenue(_summed(revenue, revenue_sums()))


def revenue_by_health_band(revenue: DataFrame) -> DataFrame:
    """Accounts and ARR per revenue health band."""
    return revenue.groupBy("revenue_health_band").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.sum("total_arr").alias("total_arr"),
        F.sum("arr_at_risk").alias("arr_at_risk"),
    )


POOR_COLLECTION_COLS = ["account_id", "account_name", "tier", "collection_rate_pct", "total_billed",
                        "total_outstanding", "revenue_health_band"]


def is_billed() -> Column:
    return F.col("total_billed") > 0


def by_collection() -> list[Column]:
    return [F.col("collection_rate_pct").asc_nulls_first(), F.col("total_outstanding").desc_nulls_last(),
            F.col("account_id").asc()]


def poor_collection_accounts(revenue: DataFrame, row_limit: int = DEFAULT_ROW_LIMIT) -> DataFrame:
    """Billed accounts with the lowest collection rate."""
    return top(revenue.where(is_billed()).select(*POOR_COLLECTION_COLS), by_collection(), row_limit)


# --------------------------------------------------------------- funnel
def _per_campaign(funnel: DataFrame, *keys: str) -> DataFrame:
    """First level of a two-level rollup: one row per (keys, campaign).

    Spend repeats on every lead row of a campaign, so it is taken once
    here (``max``) and summed at the second level. Organic leads form
    the NULL-campaign group, which has no spend.
    """
    won = F.col("is_won")
    return funnel.groupBy(*keys, "campaign_id").agg(
        F.count(F.lit(1)).alias("leads"),
        F.count_if(won).alias("won_deals"),
        F.sum(F.when(won, F.col("opportunity_amount"))).alias("won_revenue"),
        F.sum("days_lead_to_close").alias("days_sum"),
        F.count("days_lead_to_close").alias("days_n"),
        F.max("campaign_spend").alias("spend"),
    )


def _won_amount() -> Column:
    return F.sum(F.when(F.col("is_won"), F.col("opportunity_amount")))


def funnel_sums() -> dict[str, Column]:
    """Sums over leads; the spend of a campaign is not among them (``campaign_spend``)."""
    won = F.when(F.col("is_won"), F.col("opportunity_amount"))
    return {"leads": F.count(F.lit(1)), "won_deals": F.count_if(F.col("is_won")), "won_revenue": F.sum(won),
            "days_sum": F.sum("days_lead_to_close"), "days_n": F.count("days_lead_to_close"),
            "campaign_won_revenue": F.sum(F.when(F.col("campaign_id").isNotNull(), won))}


def campaign_spend(funnel: DataFrame) -> DataFrame:
    """One row: the spend of the campaigns that have leads, each counted once."""
    return (funnel.groupBy("campaign_id").agg(F.max("campaign_spend").alias("spend"))
            .agg(F.sum("spend").alias("total_spend")))


def finish_funnel(sums: DataFrame) -> DataFrame:
    """The KPI row from one row of ``funnel_sums`` and ``total_spend``."""
    return sums.select(
        "leads", "won_deals", "won_revenue",
        (F.col("days_sum").cast("double") / F.nullif(F.col("days_n"), F.lit(0)).cast("double"))
        .alias("avg_days_lead_to_close"),
        "total_spend", money_ratio(F.col("campaign_won_revenue"), F.col("total_spend")).alias("revenue_per_spend"))


def funnel_kpis(funnel: DataFrame) -> DataFrame:
    """Leads, won deals, won revenue, days to close, revenue per spend.

    Revenue per spend is won revenue of campaign-attributed leads over
    the spend of all campaigns, each campaign counted once.
    """
    per = _per_campaign(funnel)
    campaign = F.col("campaign_id").isNotNull()
    return finish_funnel(per.agg(
        F.coalesce(F.sum("leads"), F.lit(0)).alias("leads"),
        F.coalesce(F.sum("won_deals"), F.lit(0)).alias("won_deals"),
        F.sum("won_revenue").alias("won_revenue"),
        F.sum("days_sum").alias("days_sum"), F.sum("days_n").alias("days_n"),
        F.sum(F.when(campaign, F.col("won_revenue"))).alias("campaign_won_revenue"),
        F.sum("spend").alias("total_spend"),
    ))


def leads_per_month(funnel: DataFrame) -> DataFrame:
    """Leads created per calendar month (UTC)."""
    return funnel.groupBy(F.date_format("lead_created_at", "yyyy-MM").alias("lead_month")) \
        .agg(F.count(F.lit(1)).alias("leads"),
             F.count_if(F.col("is_converted")).alias("converted_leads"))


def conversion_by_source(funnel: DataFrame) -> DataFrame:
    """Share of leads converted and won, per lead source."""
    n = F.count(F.lit(1))
    return funnel.groupBy("lead_source").agg(
        n.alias("leads"),
        (F.count_if(F.col("is_converted")).cast("double") / n.cast("double"))
        .alias("conversion_rate"),
        (F.count_if(F.col("is_won")).cast("double") / n.cast("double")).alias("win_rate"),
    )


def return_by_campaign(funnel: DataFrame) -> DataFrame:
    """Leads, won revenue, spend and return per campaign.

    Name and channel depend on the campaign; grouping by them keeps the
    aggregate's buffers of fixed width (a hash aggregate).
    """
    return (
        funnel.where(F.col("campaign_id").isNotNull())
        .groupBy("campaign_id", "campaign_name", "channel")
        .agg(F.count(F.lit(1)).alias("leads"), F.count_if(F.col("is_won")).alias("won_deals"),
             _won_amount().alias("won_revenue"), F.max("campaign_spend").alias("total_spend"))
        .withColumn("revenue_per_spend", money_ratio(F.col("won_revenue"), F.col("total_spend")))
    )


def return_by_channel(funnel: DataFrame) -> DataFrame:
    """The same per channel; spend summed over distinct campaigns."""
    per = _per_campaign(funnel.where(F.col("campaign_id").isNotNull()), "channel")
    return per.groupBy("channel").agg(
        F.sum("leads").alias("leads"), F.sum("won_deals").alias("won_deals"),
        F.sum("won_revenue").alias("won_revenue"), F.sum("spend").alias("total_spend"),
    ).withColumn("revenue_per_spend", money_ratio(F.col("won_revenue"), F.col("total_spend")))


def return_by_source(funnel: DataFrame) -> DataFrame:
    """Leads, won deals and won revenue per lead source."""
    return funnel.groupBy("lead_source").agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("is_won")).alias("won_deals"),
        _won_amount().alias("won_revenue"))


WON_DEAL_COLS = ["lead_id", "opportunity_id", "account_name", "lead_source", "channel", "opportunity_amount",
                 "close_date", "days_lead_to_close"]


def is_won() -> Column:
    return F.col("is_won")


def top_won_deals(funnel: DataFrame, row_limit: int = DEFAULT_ROW_LIMIT) -> DataFrame:
    """Largest closed-won opportunities."""
    return top(funnel.where(is_won()).select(*WON_DEAL_COLS), by_opportunity_amount(), row_limit)
