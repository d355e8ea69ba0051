"""Staging models: one raw table in, one cleaned table out, same rows.

Each function is a pure projection (no shuffle): categoricals are
lower-cased and whitespace-trimmed, types are fixed by strict casts,
and boolean flags turn NULL comparisons into false. Functions that
depend on "today" take ``as_of`` so runs are reproducible.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    MONEY, as_of_date, clean, elapsed, flag, money, money_pct, round2, whole,
)

# Category lists the flags test against.
DECISION_MAKER_TITLES = ["ceo", "cto", "cfo", "vp of sales", "head of operations",
                         "sales director"]
POSITIVE_OUTCOMES = ["meeting booked", "interested", "sent", "opened"]
HIGH_TOUCH_TYPES = ["call", "meeting", "demo"]
CONVERSION_EVENTS = ["demo_request", "form_submit"]
CLOSED_STAGES = ["closed won", "closed lost"]


def _ts(c: str):
    return F.col(c).cast("timestamp")


def _date(c: str):
    return F.col(c).cast("date")


# --------------------------------------------------------------------- crm
def stg_crm__accounts(raw: DataFrame) -> DataFrame:
    tier = clean("tier")
    return raw.select(
        "account_id",
        "account_name",
        clean("industry").alias("industry"),
        clean("country").alias("country"),
        clean("account_status").alias("account_status"),
        tier.alias("tier"),
        whole(raw, "employee_count").alias("employee_count"),
        _ts("created_at").alias("created_at"),
        flag(clean("account_status") == "churned").alias("is_churned"),
        F.when(tier == "enterprise", 3).when(tier == "growth", 2)
         .when(tier == "starter", 1).otherwise(0).alias("tier_rank"),
    )


def stg_crm__contacts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "contact_id",
        "account_id",
        "full_name",
        clean("email").alias("email"),
        clean("job_title").alias("job_title"),
        "phone",
        _ts("created_at").alias("created_at"),
        flag(F.col("account_id").isNull()).alias("is_orphaned"),
        flag(clean("job_title").isin(DECISION_MAKER_TITLES)).alias("is_decision_maker"),
    )


def stg_crm__leads(raw: DataFrame) -> DataFrame:
    status = clean("status")
    return raw.select(
        "lead_id",
        "contact_id",
        "campaign_id",
        clean("lead_source").alias("lead_source"),
        status.alias("lead_status"),
        "assigned_rep",
        _ts("created_at").alias("created_at"),
        _ts("converted_at").alias("converted_at"),
        flag((status == "converted") & F.col("converted_at").isNull())
        .alias("is_conversion_date_missing"),
        flag(status == "converted").alias("is_converted"),
        elapsed("DAY", _ts("created_at"), _ts("converted_at")).alias("days_to_convert"),
    )


def stg_crm__opportunities(raw: DataFrame) -> DataFrame:
    stage = clean("stage")
    return raw.select(
        "opportunity_id",
        "account_id",
        "lead_id",
        stage.alias("stage"),
        clean("currency").alias("currency"),
        money("amount").alias("amount"),
        F.col("probability").cast("double").alias("probability"),
        _date("close_date").alias("close_date"),
        _ts("created_at").alias("created_at"),
        flag(stage.isin(CLOSED_STAGES) & F.col("close_date").isNull())
        .alias("is_close_date_missing"),
        flag(stage == "closed won").alias("is_won"),
        flag(stage == "closed lost").alias("is_lost"),
        flag(~stage.isin(CLOSED_STAGES)).alias("is_open"),
        # NUMERIC * FLOAT64 is FLOAT64 in the warehouse.
        round2(money("amount").cast("double") * F.col("probability").cast("double") / 100)
        .alias("weighted_amount"),
    )


def stg_crm__campaigns(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    spend, budget = money("actual_spend"), money("budget")
    return raw.select(
        "campaign_id",
        "campaign_name",
        clean("campaign_type").alias("campaign_type"),
        clean("status").alias("campaign_status"),
        clean("channel").alias("channel"),
        "owner",
        clean("campaign_variant").alias("campaign_variant"),
        budget.alias("budget"),
        spend.alias("actual_spend"),
        whole(raw, "target_leads").alias("target_leads"),
        _date("start_date").alias("start_date"),
        _date("end_date").alias("end_date"),
        flag(F.col("actual_spend").isNull()).alias("is_spend_missing"),
        F.when(F.col("actual_spend").isNotNull() & (budget > 0),
               money_pct(spend, budget)).alias("budget_utilisation_pct"),
        flag(_date("end_date") < as_of_date(as_of)).alias("is_completed"),
    )


def stg_crm__activities(raw: DataFrame) -> DataFrame:
    return raw.select(
        "activity_id",
        "contact_id",
        "opportunity_id",
        "account_id",
        clean("activity_type").alias("activity_type"),
        clean("outcome").alias("outcome"),
        "assigned_rep",
        "notes",
        whole(raw, "duration_minutes").alias("duration_minutes"),
        _date("activity_date").alias("activity_date"),
        _ts("created_at").alias("created_at"),
        flag(F.col("activity_date").isNull()).alias("is_date_missing"),
        flag(clean("outcome").isin(POSITIVE_OUTCOMES)).alias("is_positive_outcome"),
        flag(clean("activity_type").isin(HIGH_TOUCH_TYPES)).alias("is_high_touch"),
    )


def stg_crm__support_tickets(raw: DataFrame) -> DataFrame:
    status = clean("status")
    csat = whole(raw, "csat_score")
    return raw.select(
        "ticket_id",
        "account_id",
        "contact_id",
        clean("category").alias("category"),
        clean("priority").alias("priority"),
        status.alias("ticket_status"),
        "agent",
        csat.alias("csat_score"),
        F.col("first_response_hours").cast("double").alias("first_response_hours"),
        _ts("created_at").alias("created_at"),
        _ts("resolved_at").alias("resolved_at"),
        flag(status.isin("resolved", "closed") & F.col("csat_score").isNull())
        .alias("is_csat_missing"),
        flag(F.col("csat_score").isNotNull() & (csat <= 2)).alias("is_low_csat"),
        flag(clean("priority").isin("high", "critical")).alias("is_high_priority"),
        elapsed("HOUR", _ts("created_at"), _ts("resolved_at")).alias("resolution_hours"),
    )


# --------------------------------------------------------------------- erp
def stg_erp__products(raw: DataFrame) -> DataFrame:
    price = money("unit_price")
    return raw.select(
        "product_id",
        "product_name",
        clean("category").alias("category"),
        clean("billing_type").alias("billing_type"),
        price.alias("unit_price"),
        flag(clean("billing_type") == "subscription").alias("is_recurring"),
        F.when(price >= 5000, "enterprise").when(price >= 500, "mid-market")
         .otherwise("smb").alias("price_tier"),
    )


def stg_erp__orders(raw: DataFrame) -> DataFrame:
    status, price = clean("order_status"), money("unit_price")
    return raw.select(
        "order_id",
        "account_id",
        "product_id",
        "opportunity_id",
        status.alias("order_status"),
        whole(raw, "quantity").alias("quantity"),
        price.alias("unit_price"),
        money("total_amount").alias("total_amount"),
        _date("order_date").alias("order_date"),
        flag(price < 0).alias("is_refund"),
        flag(status == "completed").alias("is_completed"),
        flag(status == "cancelled").alias("is_cancelled"),
        F.when((status == "completed") & (price > 0), money("total_amount"))
         .otherwise(F.lit(0).cast(MONEY)).alias("recognised_revenue"),
    )


def stg_erp__invoices(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    status = clean("payment_status")
    due, paid = money("amount_due"), money("amount_paid")
    return raw.select(
        "invoice_id",
        "subscription_id",
        "account_id",
        due.alias("amount_due"),
        paid.alias("amount_paid"),
        _date("due_date").alias("due_date"),
        _date("paid_date").alias("paid_date"),
        status.alias("payment_status"),
        flag(status.isin("overdue", "unpaid") & F.col("amount_paid").isNull())
        .alias("is_payment_null"),
        flag(status == "paid").alias("is_paid"),
        flag(status == "overdue").alias("is_overdue"),
        F.when(F.col("amount_paid").isNotNull(), round2(due - paid).cast(MONEY))
         .otherwise(due).alias("outstanding_amount"),
        F.when(status == "overdue", F.datediff(as_of_date(as_of), _date("due_date")))
         .otherwise(0).cast("long").alias("days_overdue"),
    )


def stg_erp__subscriptions(raw: DataFrame) -> DataFrame:
    status = clean("status")
    start, end = _date("start_date"), _date("end_date")
    return raw.select(
        "subscription_id",
        "account_id",
        "product_id",
        "opportunity_id",
        status.alias("subscription_status"),
        clean("billing_cycle").alias("billing_cycle"),
        money("mrr").alias("mrr"),
        start.alias("start_date"),
        end.alias("end_date"),
        flag(end < start).alias("is_date_inverted"),
        flag(status == "active").alias("is_active"),
        flag(status == "churned").alias("is_churned"),
        round2(money("mrr") * 12).alias("arr"),
        F.when(end >= start, F.datediff(end, start)).cast("long")
        .alias("subscription_duration_days"),
    )


def stg_erp__payments(raw: DataFrame) -> DataFrame:
    status = clean("payment_status")
    return raw.select(
        "payment_id",
        "invoice_id",
        "account_id",
        clean("payment_method").alias("payment_method"),
        status.alias("payment_status"),
        "failure_reason",
        "gateway_ref",
        money("amount").alias("amount"),
        whole(raw, "retry_count").alias("retry_count"),
        _date("payment_date").alias("payment_date"),
        _ts("created_at").alias("created_at"),
        flag((status == "successful") & F.col("payment_date").isNull())
        .alias("is_payment_date_missing"),
        flag(status == "successful").alias("is_successful"),
        flag(status == "failed").alias("is_failed"),
        flag(whole(raw, "retry_count") >= 2).alias("is_repeat_failure"),
    )


# --------------------------------------------------------------------- web
def stg_web__web_events(raw: DataFrame) -> DataFrame:
    event_type, ts = clean("event_type"), _ts("event_timestamp")
    return raw.select(
        "event_id",
        "contact_id",
        event_type.alias("event_type"),
        "page_url",
        "session_id",
        clean("utm_source").alias("utm_source"),
        clean("utm_campaign").alias("utm_campaign"),
        ts.alias("event_timestamp"),
        F.to_date(ts).alias("event_date"),
        F.hour(ts).cast("long").alias("event_hour"),
        F.date_format(ts, "yyyy-MM").alias("event_month"),
        flag(event_type == "page_view").alias("is_page_view"),
        flag(event_type.isin(CONVERSION_EVENTS)).alias("is_conversion_event"),
        flag(clean("page_url") == "/pricing").alias("is_pricing_page"),
    )


def stg_web__feature_usage(raw: DataFrame) -> DataFrame:
    usage = whole(raw, "usage_count")
    seconds = whole(raw, "session_duration_seconds")
    return raw.select(
        "usage_id",
        "account_id",
        "contact_id",
        clean("feature_name").alias("feature_name"),
        clean("device_type").alias("device_type"),
        usage.alias("usage_count"),
        seconds.alias("session_duration_seconds"),
        _date("usage_date").alias("usage_date"),
        _ts("created_at").alias("created_at"),
        flag(F.col("usage_date").isNull()).alias("is_date_missing"),
        flag(usage == 0).alias("is_zero_usage"),
        F.when(usage >= 100, "power").when(usage >= 20, "regular")
         .when(usage >= 1, "light").otherwise("inactive").alias("engagement_level"),
        F.when(seconds.isNotNull(), round2(seconds / 60)).alias("session_duration_minutes"),
    )


# Model name -> (raw table, function, needs as_of)
STAGING = {
    "stg_crm__accounts": ("accounts", stg_crm__accounts, False),
    "stg_crm__contacts": ("contacts", stg_crm__contacts, False),
    "stg_crm__leads": ("leads", stg_crm__leads, False),
    "stg_crm__opportunities": ("opportunities", stg_crm__opportunities, False),
    "stg_crm__campaigns": ("campaigns", stg_crm__campaigns, True),
    "stg_crm__activities": ("activities", stg_crm__activities, False),
    "stg_crm__support_tickets": ("support_tickets", stg_crm__support_tickets, False),
    "stg_erp__products": ("products", stg_erp__products, False),
    "stg_erp__orders": ("orders", stg_erp__orders, False),
    "stg_erp__invoices": ("invoices", stg_erp__invoices, True),
    "stg_erp__subscriptions": ("subscriptions", stg_erp__subscriptions, False),
    "stg_erp__payments": ("payments", stg_erp__payments, False),
    "stg_web__web_events": ("web_events", stg_web__web_events, False),
    "stg_web__feature_usage": ("feature_usage", stg_web__feature_usage, False),
}
