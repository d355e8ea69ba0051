"""Marts: the three wide result tables.

All three are left joins of account- or opportunity-keyed rollups onto a
driving table, then one projection. Account marts read one frame that
carries every account-grain rollup. The funnel joins what it can at contact
and opportunity grain, so leads move for their campaign, their contact and
their opportunity only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    MONEY, as_of_date, dec, flag, money_pct, round2, run_timestamp,
)
from tidemark.operators.intermediate import (
    BILLING_COLS, engagement_columns, int_leads_with_campaigns, opportunity_activity,
)

# Recommended next action per churn risk band.
RECOMMENDED_ACTION = {
    "critical": "Immediate intervention — assign CSM, escalate to leadership",
    "high": "Urgent outreach — schedule executive business review",
    "medium": "Proactive check-in — review feature adoption and resolve tickets",
    "low": "Monitor — maintain regular cadence",
}
# Share of MRR / ARR at risk per churn risk band.
CHURN_AT_RISK_SHARE = {"high": "0.75", "medium": "0.40"}


def _days_since(as_of, c: str):
    return F.datediff(as_of_date(as_of), F.to_date(F.col(c))).cast("long")


# ------------------------------------------------------------------- M1
PAYMENT_HEALTH_COLS = [
    "account_id", "payment_health_score", "payment_health_band",
    "consecutive_failure_count", "total_cumulative_failures",
    "most_recent_failure_reason", "latest_payment_date", "total_payments",
    "successful_payments", "failed_payments",
]


def mart_customer_churn(customer_health: DataFrame, payment_health: DataFrame,
                        account_subscriptions: DataFrame, as_of: dt.date | None = None,
                        run_ts: dt.datetime | None = None) -> DataFrame:
    """M1 as defined: customer health, then payment health, then D1."""
    s = account_subscriptions.select("account_id", *BILLING_COLS)
    j = customer_health.join(payment_health.select(*PAYMENT_HEALTH_COLS), "account_id", "left") \
        .join(s, "account_id", "left")
    return _churn_columns(j, as_of, run_ts)


def mart_customer_churn_shared(health_with_billing: DataFrame, accounts: DataFrame,
                               as_of: dt.date | None = None,
                               run_ts: dt.datetime | None = None) -> DataFrame:
    """M1 with D1 and D2 read once: same rows and values as ``mart_customer_churn``.

    The joins with D2 and, again, with D1 contribute rollups of the account
    key (equal on every row of a key), and D1 a row multiplicity: the number
    of account rows per key. So the columns come from the join inside
    customer health (``customer_health_with_billing`` over
    ``account_billing``) and the multiplicity from a left join with the
    account key column alone: a narrow scan of a dimension instead of
    aggregating the fact tables again. With unique account keys (a declared
    check) that join is one-to-one; with duplicates it repeats rows exactly
    as the definition.
    """
    keys = accounts.select("account_id")
    j = health_with_billing.join(keys, "account_id", "left").withColumnsRenamed(
        {f"health_{c}": c for c in ("total_payments", "successful_payments", "failed_payments")})
    return _churn_columns(j, as_of, run_ts)


def _churn_columns(j: DataFrame, as_of: dt.date | None, run_ts: dt.datetime | None) -> DataFrame:
    band = F.col("churn_risk_band")

    def at_risk(c: str):
        v = F.col(c)
        return (F.when(band == "critical", v)
                .when(band == "high", round2(v * dec(CHURN_AT_RISK_SHARE["high"])))
                .when(band == "medium", round2(v * dec(CHURN_AT_RISK_SHARE["medium"])))
                .otherwise(F.lit(0).cast(MONEY)))

    action = F.when(band == "critical", RECOMMENDED_ACTION["critical"]) \
        .when(band == "high", RECOMMENDED_ACTION["high"]) \
        .when(band == "medium", RECOMMENDED_ACTION["medium"]) \
        .otherwise(RECOMMENDED_ACTION["low"])
    return j.select(
        "account_id", "account_name", "industry", "tier", "tier_rank", "account_status",
        "is_churned", "total_mrr", "total_arr", "active_subscriptions",
        "total_subscriptions", "churned_subscriptions", "earliest_subscription_start",
        "latest_subscription_start", "avg_subscription_duration_days",
        "collection_rate_pct", "payment_failure_rate_pct", "overdue_invoices",
        "repeat_failures", "total_billed", "total_collected", "total_outstanding",
        "max_days_overdue",
        "payment_health_score", "payment_health_band", "consecutive_failure_count",
        "total_cumulative_failures", "most_recent_failure_reason", "latest_payment_date",
        "total_payments", "successful_payments", "failed_payments",
        "total_tickets", "high_priority_tickets", "low_csat_tickets", "escalated_tickets",
        "open_tickets", "avg_csat_score", "avg_resolution_hours", "latest_ticket_date",
        "distinct_features_used", "total_usage_count", "power_usage_days", "inactive_days",
        "latest_usage_date", "avg_session_duration_minutes",
        "churn_risk_score", "churn_risk_band",
        _days_since(as_of, "latest_ticket_date").alias("days_since_last_ticket"),
        _days_since(as_of, "latest_usage_date").alias("days_since_last_usage"),
        _days_since(as_of, "latest_payment_date").alias("days_since_last_payment"),
        at_risk("total_mrr").alias("mrr_at_risk"),
        at_risk("total_arr").alias("arr_at_risk"),
        action.alias("recommended_action"),
        run_timestamp(run_ts).alias("mart_updated_at"),
    )


# ------------------------------------------------------------------- M2
REVENUE_BASE_COLS = [
    "account_id", "account_name", "industry", "country", "tier", "tier_rank",
    "account_status", "is_churned", "created_at", "total_subscriptions",
    "active_subscriptions", "churned_subscriptions", "total_mrr", "total_arr",
    "earliest_subscription_start", "latest_subscription_start",
    "avg_subscription_duration_days", "total_invoices", "paid_invoices",
    "overdue_invoices", "total_billed", "total_collected", "total_outstanding",
    "max_days_overdue", "collection_rate_pct", "payment_failure_rate_pct",
    "total_payments", "successful_payments", "failed_payments", "repeat_failures",
    "total_payment_amount",
]


def revenue_band(active, rate, pay_band):
    return (F.when(active == 0, "no_revenue")
            .when((rate >= 90) & (pay_band == "healthy"), "healthy")
            .when((rate >= 70) & pay_band.isin("healthy", "at_risk"), "stable")
            .when((rate >= 50) | (pay_band == "at_risk"), "at_risk")
            .otherwise("critical"))


REVENUE_HEALTH_COLS = [
    "payment_health_score", "payment_health_band",
    "consecutive_failure_count", "total_cumulative_failures",
    "most_recent_failure_reason", "latest_payment_date", "first_payment_date",
    "avg_payment_amount",
]


def mart_revenue(account_subscriptions: DataFrame, payment_health: DataFrame,
                 as_of: dt.date | None = None, run_ts: dt.datetime | None = None) -> DataFrame:
    """M2 as defined: D1, then payment health."""
    ph = payment_health.select("account_id", *REVENUE_HEALTH_COLS)
    return mart_revenue_shared(
        account_subscriptions.select(*REVENUE_BASE_COLS).join(ph, "account_id", "left"), as_of, run_ts)


def mart_revenue_shared(j: DataFrame, as_of: dt.date | None = None,
                        run_ts: dt.datetime | None = None) -> DataFrame:
    """M2 from one frame with the columns of both (``account_billing``)."""
    rate, arr = F.col("collection_rate_pct"), F.col("total_arr")
    billed, outstanding = F.col("total_billed"), F.col("total_outstanding")
    avg_days = F.col("avg_subscription_duration_days")
    today = as_of_date(as_of)
    return j.select(
        *REVENUE_BASE_COLS,
        *REVENUE_HEALTH_COLS,
        revenue_band(F.col("active_subscriptions"), rate, F.col("payment_health_band"))
        .alias("revenue_health_band"),
        F.when(rate < 50, arr).when(rate < 70, round2(arr * dec("0.50")))
         .when(rate < 90, round2(arr * dec("0.20"))).otherwise(F.lit(0).cast(MONEY))
         .alias("arr_at_risk"),
        round2(F.col("total_collected") - outstanding).alias("net_revenue"),
        F.when(billed > 0, money_pct(outstanding, billed))
         .otherwise(F.lit(0)).alias("outstanding_pct"),
        # NUMERIC * FLOAT64 is FLOAT64.
        F.when(avg_days > 0, round2(F.col("total_mrr").cast("double") * (avg_days / 30.0)))
         .otherwise(F.lit(0.0)).alias("estimated_clv"),
        F.datediff(today, F.col("earliest_subscription_start")).cast("long")
        .alias("customer_tenure_days"),
        F.datediff(today, F.col("latest_subscription_start")).cast("long")
        .alias("days_since_latest_subscription"),
        flag((F.col("total_subscriptions") > 1)
             & (F.col("earliest_subscription_start") != F.col("latest_subscription_start")))
        .alias("has_expanded"),
        flag((F.col("churned_subscriptions") > 0) & (F.col("active_subscriptions") > 0))
        .alias("has_contracted"),
        run_timestamp(run_ts).alias("mart_updated_at"),
    )


# ------------------------------------------------------------------- M3
def funnel_stage(is_won, is_lost, is_open, is_converted):
    return (F.when(is_won, "4_closed_won").when(is_lost, "4_closed_lost")
            .when(is_open, "3_in_pipeline").when(is_converted, "2_converted")
            .otherwise("1_lead"))


FUNNEL_ACCOUNT_COLS = ["account_name", "tier", "tier_rank", "industry"]
FUNNEL_ACTIVITY_COLS = [
    "total_activities", "high_touch_activities", "positive_outcomes",
    "total_calls", "total_meetings", "total_demos", "total_emails", "reps_involved",
    "avg_activity_duration", "positive_outcome_rate", "engagement_quality",
    "days_since_last_activity", "latest_activity_date", "first_activity_date",
]


def mart_sales_funnel(leads_with_campaigns: DataFrame, accounts: DataFrame,
                      sales_activity: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """M3 as defined: leads, then activity by opportunity, then accounts."""
    j = leads_with_campaigns \
        .join(sales_activity.select("opportunity_id", *FUNNEL_ACTIVITY_COLS), "opportunity_id", "left") \
        .join(accounts.select("account_id", *FUNNEL_ACCOUNT_COLS), "account_id", "left")
    return _funnel_columns(j, run_ts)


def mart_sales_funnel_shared(leads: DataFrame, campaigns: DataFrame, opportunities: DataFrame,
                             contacts: DataFrame, accounts: DataFrame, activities: DataFrame,
                             as_of: dt.date | None = None,
                             run_ts: dt.datetime | None = None) -> DataFrame:
    """M3 with the activity joined to the chosen opportunities and the accounts
    to the contacts, before either meets the leads: the same rows, but three
    quarters of the leads have no opportunity and would meet under NULL."""
    activity = opportunity_activity(activities)

    def with_activity(best: DataFrame) -> DataFrame:
        return best.join(activity, "opportunity_id", "left").select(
            "*", *engagement_columns(as_of))

    def with_account(contact: DataFrame) -> DataFrame:
        return contact.join(accounts.select("account_id", *FUNNEL_ACCOUNT_COLS), "account_id", "left")

    j = int_leads_with_campaigns(leads, campaigns, opportunities, contacts,
                                 with_contact=with_account, with_opportunity=with_activity)
    return _funnel_columns(j, run_ts)


def _funnel_columns(leads: DataFrame, run_ts: dt.datetime | None) -> DataFrame:
    j = leads.withColumn(
        "funnel_stage", funnel_stage(F.col("is_won"), F.col("is_lost"), F.col("is_open"),
                                     F.col("is_converted")))
    won, close = F.col("is_won"), F.col("close_date")
    spend, amount = F.col("actual_spend"), F.col("opportunity_amount")
    lead_days = F.datediff(close, F.to_date("lead_created_at"))
    conv_days = F.datediff(close, F.to_date("converted_at"))

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0)).alias(c)

    return j.select(
        "account_name", "tier", "tier_rank", "industry",
        "lead_id", "contact_id", "account_id", "campaign_id", "campaign_name",
        "campaign_type", "channel", "lead_source", "lead_status", "assigned_rep",
        "attribution_type", "lead_outcome", "lead_created_at", "converted_at",
        "is_converted", "days_to_convert", "is_decision_maker", "budget", "actual_spend",
        "budget_utilisation_pct",
        "opportunity_id", "opportunity_stage", "opportunity_amount", "weighted_amount",
        "is_won", "is_lost", "is_open", "close_date", "probability", "funnel_stage",
        zero("total_activities"), zero("high_touch_activities"), zero("positive_outcomes"),
        zero("total_calls"), zero("total_meetings"), zero("total_demos"),
        zero("total_emails"), zero("reps_involved"),
        "avg_activity_duration", "positive_outcome_rate", "engagement_quality",
        "days_since_last_activity", "latest_activity_date", "first_activity_date",
        F.when(won & close.isNotNull() & (lead_days >= 0), lead_days).cast("long")
        .alias("days_lead_to_close"),
        F.when(won & F.col("converted_at").isNotNull() & close.isNotNull() & (conv_days >= 0),
               conv_days).cast("long").alias("days_convert_to_close"),
        F.when(spend.isNotNull() & (spend > 0), round2(spend)).alias("campaign_spend"),
        F.when(spend.isNotNull() & (spend > 0) & won,
               round2(amount / F.nullif(spend, F.lit(0)))).alias("revenue_per_spend"),
        run_timestamp(run_ts).alias("mart_updated_at"),
    )
