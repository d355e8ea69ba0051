"""Curated parameterised queries over the marts (point lookups, top-k lists).

Each function takes the mart DataFrame and validated arguments and
returns a lazy DataFrame. A point lookup is an equality filter on the
mart key, which reaches the parquet scan as a pushed filter when the
mart is a table. A ranked list is ``filter -> orderBy -> limit``, which
Spark plans as TakeOrderedAndProject: every task keeps only its own top
``row_limit`` rows, so the work stays distributed and the driver sees at
most ``row_limit`` rows per task. The mart key is the last sort column
so ties come back in a fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Legal arguments and limits of the curated queries.
RISK_BANDS = ("critical", "high", "medium", "low")
REVENUE_HEALTH_BANDS = ("healthy", "stable", "at_risk", "critical", "no_revenue")
LEAD_OUTCOMES = ("closed_won", "closed_lost", "in_pipeline", "not_converted")
ATTRIBUTION_TYPES = ("campaign", "organic", "all")
DEFAULT_ROW_LIMIT = 20
MAX_ROW_LIMIT = 200


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}; got {value!r}")
    return value


def _row_limit(row_limit: int) -> int:
    if isinstance(row_limit, bool) or not isinstance(row_limit, int):
        raise ValueError(f"row_limit must be an integer; got {row_limit!r}")
    if not 1 <= row_limit <= MAX_ROW_LIMIT:
        raise ValueError(f"row_limit must be between 1 and {MAX_ROW_LIMIT}; got {row_limit}")
    return row_limit


def _key(account_id: str) -> str:
    if not isinstance(account_id, str) or not account_id:
        raise ValueError("account_id must be a non-empty string")
    return account_id


def top(df: DataFrame, order: list[Column], row_limit: int) -> DataFrame:
    """Deterministic top-k: ``order`` then the caller's key as tie-break."""
    return df.orderBy(*order).limit(_row_limit(row_limit))


# Orders of the ranked lists, each ending in the mart's key.
def by_mrr_at_risk() -> list[Column]:
    return [F.col("mrr_at_risk").desc_nulls_last(), F.col("account_id").asc()]


def by_arr_at_risk() -> list[Column]:
    return [F.col("arr_at_risk").desc_nulls_last(), F.col("account_id").asc()]


def by_opportunity_amount() -> list[Column]:
    return [F.col("opportunity_amount").desc_nulls_last(), F.col("lead_id").asc()]


# ---------------------------------------------------------------- Q1, Q2
CHURN_LOOKUP_COLS = ["account_id", "account_name", "tier", "churn_risk_score",
                     "churn_risk_band", "payment_health_band", "mrr_at_risk", "arr_at_risk",
                     "recommended_action"]
CHURN_LIST_COLS = ["account_id", "account_name", "tier", "churn_risk_score",
                   "churn_risk_band", "mrr_at_risk", "arr_at_risk", "recommended_action"]


def get_account_churn_risk(churn: DataFrame, account_id: str) -> DataFrame:
    return churn.where(F.col("account_id") == F.lit(_key(account_id))) \
        .select(*CHURN_LOOKUP_COLS)


def list_high_risk_accounts(churn: DataFrame, risk_band: str,
                            row_limit: int = DEFAULT_ROW_LIMIT) -> DataFrame:
    band = _one_of("risk_band", risk_band, RISK_BANDS)
    return top(churn.where(F.col("churn_risk_band") == F.lit(band)).select(*CHURN_LIST_COLS),
               by_mrr_at_risk(), row_limit)


# ---------------------------------------------------------------- Q3, Q4
REVENUE_LOOKUP_COLS = ["account_id", "account_name", "tier", "revenue_health_band",
                       "total_mrr", "total_arr", "collection_rate_pct", "outstanding_pct",
                       "net_revenue", "estimated_clv"]
REVENUE_LIST_COLS = ["account_id", "account_name", "tier", "revenue_health_band",
                     "total_mrr", "total_arr", "arr_at_risk", "collection_rate_pct"]


def get_account_revenue_health(revenue: DataFrame, account_id: str) -> DataFrame:
    return revenue.where(F.col("account_id") == F.lit(_key(account_id))) \
        .select(*REVENUE_LOOKUP_COLS)


def list_accounts_by_revenue_health(revenue: DataFrame, health_band: str,
                                    row_limit: int = DEFAULT_ROW_LIMIT) -> DataFrame:
    band = _one_of("health_band", health_band, REVENUE_HEALTH_BANDS)
    return top(revenue.where(F.col("revenue_health_band") == F.lit(band))
               .select(*REVENUE_LIST_COLS),
               by_arr_at_risk(), row_limit)


# ---------------------------------------------------------------- Q5, Q6
def get_funnel_summary_by_stage(funnel: DataFrame) -> DataFrame:
    """Lead count and deal value per funnel stage, in funnel order.

    The result has one row per stage (five at most), so the final sort
    is over a handful of rows after the partial/final aggregation.
    """
    return (
        funnel.groupBy("funnel_stage")
        .agg(F.count(F.lit(1)).alias("lead_count"),
             F.sum("opportunity_amount").alias("total_opportunity_amount"),
             F.sum("weighted_amount").alias("total_weighted_amount"))
        .orderBy("funnel_stage")
    )


FUNNEL_LIST_COLS = ["lead_id", "account_name", "tier", "lead_source", "attribution_type",
                    "lead_outcome", "opportunity_amount", "weighted_amount",
                    "days_lead_to_close"]


def list_leads_by_outcome(funnel: DataFrame, lead_outcome: str, attribution_type: str = "all",
                          row_limit: int = DEFAULT_ROW_LIMIT) -> DataFrame:
    outcome = _one_of("lead_outcome", lead_outcome, LEAD_OUTCOMES)
    attribution = _one_of("attribution_type", attribution_type, ATTRIBUTION_TYPES)
    rows = funnel.where(F.col("lead_outcome") == F.lit(outcome))
    if attribution != "all":
        rows = rows.where(F.col("attribution_type") == F.lit(attribution))
    return top(rows.select(*FUNNEL_LIST_COLS), by_opportunity_amount(), row_limit)


# -------------------------------------------------------------------- Q7
def exact_avg2(c: Column) -> Column:
    """round(avg(c), 2) for values with at most 2 decimals, rounded once.

    The sum is exact in decimal and the quotient keeps 12 fractional
    digits before the final rounding (Spark's decimal ``avg`` keeps
    only 6, which can round twice).
    """
    total = F.sum(c.cast("decimal(18,2)"))
    n = F.count(c).cast("decimal(20,0)")
    return F.round(total / F.nullif(n, F.lit(0).cast("decimal(20,0)")), 2)


def average_churn_risk_by_tier(churn: DataFrame) -> DataFrame:
    """Ad hoc aggregate: which tier has the highest average churn risk."""
    return (
        churn.groupBy("tier")
        .agg(F.count(F.lit(1)).alias("accounts"),
             exact_avg2(F.col("churn_risk_score")).cast("double").alias("avg_churn_risk_score"),
             F.sum("mrr_at_risk").alias("mrr_at_risk"))
        .orderBy(F.col("avg_churn_risk_score").desc_nulls_last(), F.col("tier").asc_nulls_first())
    )
