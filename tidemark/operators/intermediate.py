"""Intermediate models: per-account, per-opportunity and per-lead rollups.

Every rollup is a ``groupBy().agg()`` (partial aggregation before the
shuffle, so a hot key costs one partial row per task, not its raw rows).
Rollups are joined back with left equi joins on the key they are grouped
by, so the join reuses the aggregate's hash partitioning.

"Pick one row per key" (QUALIFY row_number() = 1 in a warehouse) is
written as ``max/min(struct(order..., payload...))``: an ordinary
aggregate with a partial stage, instead of a window that would put every
row of a hot key into one task. The primary key is appended to every
ordering so ties resolve deterministically.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import (
    MONEY, as_of_date, count_when, dec, exact_ratio, least_strict, money_pct, round2,
)
from tidemark.operators.sequence import (
    CHUNK, across_chunks, chunked, last_of, pair_columns, running_frame, with_previous,
)

RATE = "decimal(18,2)"


def _zero(c: str, cast: str | None = None) -> Column:
    z = F.lit(0) if cast is None else F.lit(0).cast(cast)
    return F.coalesce(F.col(c), z).alias(c)


# ----------------------------------------------------------- shared rollups
def invoice_rollup(invoices: DataFrame) -> DataFrame:
    """Invoice totals per account (read by D1 and D2)."""
    return (
        invoices.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count("invoice_id").alias("total_invoices"),
            count_when(F.col("is_paid")).alias("paid_invoices"),
            count_when(F.col("is_overdue")).alias("overdue_invoices"),
            round2(F.sum("amount_due")).alias("total_billed"),
            round2(F.sum(F.coalesce(F.col("amount_paid"), F.lit(0).cast(MONEY))))
            .alias("total_collected"),
            round2(F.sum("outstanding_amount")).alias("total_outstanding"),
            F.max("days_overdue").alias("max_days_overdue"),
        )
    )


PAYMENT_ORDER = ("created_at", "payment_id")


def payment_sequence(payments: DataFrame) -> DataFrame:
    """D2b-D2d as columns: every payment of an account with its place in time
    (``payment_sequence``), the failures up to it (``cumulative_failures``) and
    whether the one before it failed (``previous_failed``)."""
    rows = payments.where(F.col("account_id").isNotNull()).select(
        "payment_id", "account_id", "created_at", "payment_status", "is_failed")
    return running_frame(rows, "account_id", PAYMENT_ORDER, {"cumulative_failures": F.col("is_failed").cast("long")},
                         number="payment_sequence", previous={"previous_failed": "is_failed"})


def payment_rollup(payments: DataFrame) -> DataFrame:
    """Everything D1 and D2 take from payments, per account, in one pass.

    Payments are cut into ranges of (account, time) of equal size, so a hot
    account is spread, however few days it has. Each (account, range) yields
    counts, sums, dates, the failure pairs inside it and its newest failure
    (created_at, then payment_id) with its reason kept even when NULL, on its
    last row; then the ranges of an account are put together the same way.
    ``total_cumulative_failures`` is the maximum of the running failure count,
    which for non-negative increments is the final one.
    """
    ok, failed, zero = F.col("is_successful"), F.col("is_failed"), F.lit(0).cast(MONEY)
    paid = (payments.where(F.col("account_id").isNotNull())
            .select("account_id", "payment_id", "created_at", "payment_date", "amount", "failure_reason",
                    "is_successful", "is_failed", "is_repeat_failure"))
    rows = with_previous(chunked(paid, "account_id", PAYMENT_ORDER), "account_id", PAYMENT_ORDER,
                         "is_failed", "_previous")
    per_chunk = last_of(rows, ("account_id", CHUNK), PAYMENT_ORDER, {
        "n": F.count("payment_id"), "n_ok": F.count_if(ok), "n_failed": F.count_if(failed),
        "n_repeat": F.count_if(F.col("is_repeat_failure")),
        "ok_amount": F.sum(F.when(ok, F.col("amount")).otherwise(zero)),
        "n_amounts": F.count(F.when(ok, F.col("amount"))),
        "latest": F.max("payment_date"), "first": F.min("payment_date"),
        "failure": F.last(F.when(failed, F.struct("created_at", "payment_id", "failure_reason")), ignorenulls=True),
        **pair_columns("is_failed", "_previous"),
    }, carried=("is_failed",))
    total = last_of(across_chunks(per_chunk, "account_id", "is_failed"), ("account_id",), (CHUNK,), {
        "total_payments": F.sum("n"), "successful_payments": F.sum("n_ok"), "failed_payments": F.sum("n_failed"),
        "repeat_failures": F.sum("n_repeat"), "_ok_amount": F.sum("ok_amount"), "_n_amounts": F.sum("n_amounts"),
        "latest_payment_date": F.max("latest"), "first_payment_date": F.min("first"),
        "last_failure": F.last("failure", ignorenulls=True), "consecutive_failure_count": F.sum("_pairs"),
    })
    return total.select(
        "account_id", "total_payments", "successful_payments", "failed_payments", "repeat_failures",
        round2(F.col("_ok_amount")).alias("total_payment_amount"),
        F.when(F.col("_n_amounts") > 0, exact_ratio(F.col("_ok_amount"), F.col("_n_amounts")))
         .alias("avg_payment_amount"),
        "latest_payment_date", "first_payment_date", "last_failure", "consecutive_failure_count",
        F.col("failed_payments").alias("total_cumulative_failures"),
    )


def payment_counts(payments: DataFrame) -> DataFrame:
    """What D1 takes from payments, as ``payment_rollup`` has it: none of it needs
    their order, so one aggregate is combined in the tasks before anything moves."""
    ok = F.col("is_successful")
    spent = F.sum(F.when(ok, F.col("amount")).otherwise(F.lit(0).cast(MONEY))).cast("decimal(38,9)")
    return (
        payments.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count("payment_id").alias("total_payments"),
            F.count_if(ok).alias("successful_payments"),
            F.count_if(F.col("is_failed")).alias("failed_payments"),
            F.count_if(F.col("is_repeat_failure")).alias("repeat_failures"),
            round2(spent).alias("total_payment_amount"),
        )
    )


# ------------------------------------------------------------------- D1
def int_accounts_with_subscriptions(accounts: DataFrame, subscriptions: DataFrame,
                                    invoices: DataFrame, payments: DataFrame,
                                    invoice_totals: DataFrame | None = None,
                                    payment_totals: DataFrame | None = None) -> DataFrame:
    """D1."""
    pay = payment_totals if payment_totals is not None else payment_counts(payments)
    return account_billing(accounts, subscriptions, invoices, payments, invoice_totals,
                           pay).drop(*HEALTH_COLS)


# Columns of int_payment_health that the account marts read, as they come out
# of ``account_billing``: NULL for an account without payments.
HEALTH_COLS = [
    "payment_health_score", "payment_health_band", "consecutive_failure_count",
    "total_cumulative_failures", "most_recent_failure_reason", "latest_payment_date",
    "first_payment_date", "avg_payment_amount", "health_total_payments",
    "health_successful_payments", "health_failed_payments",
]


def payment_score() -> Column:
    """Payment health score from an account's payment and invoice rollups."""
    return round2(
        F.lit(Decimal(100))
        - F.least(F.col("failed_payments").cast(MONEY) * 5, dec(30))
        - F.least(F.col("consecutive_failure_count").cast(MONEY) * 10, dec(30))
        - least_strict(F.col("overdue_invoices").cast(MONEY) * 3, 20)
        - least_strict(F.col("max_days_overdue").cast(MONEY) * dec("0.5"), 20)
    )


def payment_band() -> Column:
    consec, failed = F.col("consecutive_failure_count"), F.col("failed_payments")
    return (F.when(consec >= 3, "critical").when(failed >= 5, "poor")
            .when(failed >= 2, "at_risk").otherwise("healthy"))


def account_billing(accounts: DataFrame, subscriptions: DataFrame, invoices: DataFrame,
                    payments: DataFrame, invoice_totals: DataFrame | None = None,
                    payment_totals: DataFrame | None = None) -> DataFrame:
    """D1 with the columns the marts take from D2 (``HEALTH_COLS``).

    Both are left joins of the same rollups on the account, so one join
    carries both and each fact table is scanned and shuffled once. The
    rollups (``invoice_rollup``, ``payment_rollup``) may be passed in when
    they are shared with int_payment_health; payment totals without the newest
    failure (``payment_counts``) leave ``HEALTH_COLS`` out.
    """
    subs = (
        subscriptions.where(~F.col("is_date_inverted") & F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count("subscription_id").alias("total_subscriptions"),
            count_when(F.col("is_active")).alias("active_subscriptions"),
            count_when(F.col("is_churned")).alias("churned_subscriptions"),
            round2(F.sum("mrr")).alias("total_mrr"),
            round2(F.sum("arr")).alias("total_arr"),
            F.max("start_date").alias("latest_subscription_start"),
            F.min("start_date").alias("earliest_subscription_start"),
            F.avg("subscription_duration_days").alias("avg_subscription_duration_days"),
        )
    )
    inv = invoice_totals if invoice_totals is not None else invoice_rollup(invoices)
    pay = payment_totals if payment_totals is not None else payment_rollup(payments)
    inv = inv.select("account_id", "total_invoices", "paid_invoices", "overdue_invoices",
                     "total_billed", "total_collected", "total_outstanding", "max_days_overdue")
    a = accounts.select("account_id", "account_name", "industry", "country",
                        "account_status", "tier", "tier_rank", "is_churned", "created_at")
    joined = a.join(subs, "account_id", "left").join(inv, "account_id", "left") \
              .join(pay, "account_id", "left")
    billed = F.coalesce(F.col("total_billed"), F.lit(0).cast(MONEY))
    collected = F.coalesce(F.col("total_collected"), F.lit(0).cast(MONEY))
    health = [
        F.when(F.col("total_payments").isNotNull(), payment_score()).alias("payment_health_score"),
        F.when(F.col("total_payments").isNotNull(), payment_band()).alias("payment_health_band"),
        F.col("consecutive_failure_count"), F.col("total_cumulative_failures"),
        F.col("last_failure.failure_reason").alias("most_recent_failure_reason"),
        F.col("latest_payment_date"), F.col("first_payment_date"), F.col("avg_payment_amount"),
        F.col("total_payments").alias("health_total_payments"),
        F.col("successful_payments").alias("health_successful_payments"),
        F.col("failed_payments").alias("health_failed_payments"),
    ] if "last_failure" in pay.columns else []
    return joined.select(
        "account_id", "account_name", "industry", "country", "account_status", "tier",
        "tier_rank", "is_churned", "created_at",
        _zero("total_subscriptions"), _zero("active_subscriptions"),
        _zero("churned_subscriptions"), _zero("total_mrr", MONEY), _zero("total_arr", MONEY),
        "latest_subscription_start", "earliest_subscription_start",
        _zero("avg_subscription_duration_days", "double"),
        _zero("total_invoices"), _zero("paid_invoices"), _zero("overdue_invoices"),
        _zero("total_billed", MONEY), _zero("total_collected", MONEY),
        _zero("total_outstanding", MONEY), _zero("max_days_overdue", "long"),
        _zero("total_payments"), _zero("successful_payments"), _zero("failed_payments"),
        _zero("repeat_failures"), _zero("total_payment_amount", MONEY),
        F.when(billed > 0, money_pct(collected, F.col("total_billed")))
         .otherwise(F.lit(0)).alias("collection_rate_pct"),
        F.when(F.coalesce(F.col("total_payments"), F.lit(0)) > 0,
               round2(F.coalesce(F.col("failed_payments"), F.lit(0))
                      / F.col("total_payments") * 100))
         .otherwise(F.lit(0.0)).alias("payment_failure_rate_pct"),
        *health,
    )


# ------------------------------------------------------------------- D2
def int_payment_health(payments: DataFrame, invoices: DataFrame,
                       invoice_totals: DataFrame | None = None,
                       payment_totals: DataFrame | None = None) -> DataFrame:
    """D2; the optional rollups are shared with D1 as there."""
    roll = payment_totals if payment_totals is not None else payment_rollup(payments)
    inv = (invoice_totals if invoice_totals is not None else invoice_rollup(invoices)).select(
        "account_id", "total_invoices", "overdue_invoices", "total_billed",
        "total_outstanding", "max_days_overdue")
    return roll.join(inv, "account_id", "left").select(
        "account_id", "total_payments", "successful_payments", "failed_payments",
        "repeat_failures", "total_cumulative_failures",
        F.col("total_payment_amount").alias("total_collected"),
        "avg_payment_amount", "latest_payment_date", "first_payment_date",
        "consecutive_failure_count",
        F.col("last_failure.failure_reason").alias("most_recent_failure_reason"),
        "total_invoices", "overdue_invoices", "total_billed", "total_outstanding",
        "max_days_overdue",
        payment_score().alias("payment_health_score"),
        payment_band().alias("payment_health_band"),
    )


# ------------------------------------------------------------------- D3
def churn_risk_score(rate: Column, overdue: Column, repeat: Column, low_csat: Column,
                     high_prio: Column, escalated: Column, usage: Column) -> Column:
    """Churn risk points, 0-100, computed in exact decimal arithmetic."""
    def pts(n: Column, weight: int, cap: int) -> Column:
        return F.least(n.cast(MONEY) * weight, dec(cap))

    usage_pts = (F.when(usage == 0, 30).when(usage < 10, 20).when(usage < 50, 10)
                 .otherwise(0))
    total = (F.least(rate.cast(RATE) * dec("0.5"), dec(15))
             + pts(overdue, 2, 10) + pts(repeat, 5, 10) + pts(low_csat, 3, 15)
             + pts(high_prio, 2, 10) + pts(escalated, 5, 10) + usage_pts.cast(MONEY))
    return round2(total).cast("double")


def churn_band(score: Column) -> Column:
    return (F.when(score >= 60, "critical").when(score >= 40, "high")
            .when(score >= 20, "medium").otherwise("low"))


# Columns of int_accounts_with_subscriptions that mart_customer_churn
# reads besides those int_customer_health already carries. All of them
# are rollups of the account key, so they are the same on every row of
# an account.
BILLING_COLS = [
    "total_subscriptions", "churned_subscriptions", "earliest_subscription_start",
    "latest_subscription_start", "avg_subscription_duration_days", "total_billed",
    "total_collected", "total_outstanding", "max_days_overdue",
]
CARRIED_COLS = [*BILLING_COLS, *HEALTH_COLS]


def int_customer_health(accounts: DataFrame, support_tickets: DataFrame,
                        feature_usage: DataFrame, account_subscriptions: DataFrame) -> DataFrame:
    """D3."""
    return customer_health_with_billing(
        accounts, support_tickets, feature_usage, account_subscriptions).drop(*CARRIED_COLS)


def customer_health_with_billing(accounts: DataFrame, support_tickets: DataFrame,
                                 feature_usage: DataFrame,
                                 account_subscriptions: DataFrame) -> DataFrame:
    """D3 plus the columns of the account's billing that the input has
    (``CARRIED_COLS`` of ``account_billing``), from the same join.

    Lets the churn mart read D1 and D2 once instead of joining them again
    (see ``marts.mart_customer_churn_shared``).
    """
    carried = [c for c in CARRIED_COLS if c in account_subscriptions.columns]
    tickets = (
        support_tickets.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count("ticket_id").alias("total_tickets"),
            count_when(F.col("is_high_priority")).alias("high_priority_tickets"),
            count_when(F.col("is_low_csat")).alias("low_csat_tickets"),
            count_when(F.col("ticket_status") == "escalated").alias("escalated_tickets"),
            count_when(F.col("ticket_status") == "open").alias("open_tickets"),
            F.avg("csat_score").alias("avg_csat_score"),
            F.avg("resolution_hours").alias("avg_resolution_hours"),
            F.max("created_at").alias("latest_ticket_date"),
        )
    )
    usage = (
        feature_usage.where(F.col("account_id").isNotNull() & ~F.col("is_date_missing"))
        .groupBy("account_id")
        .agg(
            F.count_distinct("feature_name").alias("distinct_features_used"),
            F.sum("usage_count").alias("total_usage_count"),
            count_when(F.col("engagement_level") == "power").alias("power_usage_days"),
            count_when(F.col("engagement_level") == "inactive").alias("inactive_days"),
            F.max("usage_date").alias("latest_usage_date"),
            F.avg("session_duration_minutes").alias("avg_session_duration_minutes"),
        )
    )
    s = account_subscriptions.select(
        "account_id", "total_mrr", "total_arr", "active_subscriptions", "collection_rate_pct",
        "payment_failure_rate_pct", "overdue_invoices", "repeat_failures", *carried)
    a = accounts.select("account_id", "account_name", "industry", "tier", "tier_rank",
                        "account_status", "is_churned")
    j = a.join(s, "account_id", "left").join(tickets, "account_id", "left") \
         .join(usage, "account_id", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    score = churn_risk_score(
        F.col("payment_failure_rate_pct"), z("overdue_invoices"), z("repeat_failures"),
        z("low_csat_tickets"), z("high_priority_tickets"), z("escalated_tickets"),
        z("total_usage_count"))
    return j.select(
        "account_id", "account_name", "industry", "tier", "tier_rank", "account_status",
        "is_churned",
        round2(F.col("total_mrr")).alias("total_mrr"),
        round2(F.col("total_arr")).alias("total_arr"),
        "active_subscriptions", "collection_rate_pct", "payment_failure_rate_pct",
        "overdue_invoices", "repeat_failures",
        _zero("total_tickets"), _zero("high_priority_tickets"), _zero("low_csat_tickets"),
        _zero("escalated_tickets"), _zero("open_tickets"),
        "avg_csat_score", "avg_resolution_hours", "latest_ticket_date",
        _zero("distinct_features_used"), _zero("total_usage_count", "long"),
        _zero("power_usage_days"), _zero("inactive_days"),
        "latest_usage_date", "avg_session_duration_minutes",
        score.alias("churn_risk_score"),
        *carried,
    ).withColumn("churn_risk_band", churn_band(F.col("churn_risk_score")))


# ------------------------------------------------------------------- D4
OPP_ACTIVITY_COLS = [
    "total_activities", "high_touch_activities", "positive_outcomes", "total_calls",
    "total_meetings", "total_demos", "total_emails", "reps_involved",
    "avg_activity_duration", "positive_outcome_rate", "latest_activity_date",
    "first_activity_date",
]


def counted_activities(activities: DataFrame) -> DataFrame:
    return activities.where(~F.col("is_date_missing") & F.col("account_id").isNotNull())


def opportunity_activity(activities: DataFrame) -> DataFrame:
    """One row per opportunity that has activities: ``OPP_ACTIVITY_COLS``."""
    acts, kind = counted_activities(activities), F.col("activity_type")
    per_pair = (
        acts.where(F.col("opportunity_id").isNotNull())
        .groupBy("opportunity_id", "account_id")
        .agg(
            F.count("activity_id").alias("total_activities"),
            count_when(F.col("is_high_touch")).alias("high_touch_activities"),
            count_when(F.col("is_positive_outcome")).alias("positive_outcomes"),
            count_when(kind == "call").alias("total_calls"),
            count_when(kind == "meeting").alias("total_meetings"),
            count_when(kind == "demo").alias("total_demos"),
            count_when(kind == "email").alias("total_emails"),
            F.count_distinct("assigned_rep").alias("reps_involved"),
            F.avg("duration_minutes").alias("avg_activity_duration"),
            F.max("activity_date").alias("latest_activity_date"),
            F.min("activity_date").alias("first_activity_date"),
        )
        .withColumn("positive_outcome_rate",
                    round2(F.col("positive_outcomes")
                           / F.nullif(F.col("total_activities"), F.lit(0)) * 100))
    )
    # An opportunity logged under several accounts keeps the rollup of the
    # account with the latest activity (ties: the larger account id).
    best = F.max(F.struct(F.col("latest_activity_date").alias("k1"),
                          F.col("account_id").alias("k2"), *OPP_ACTIVITY_COLS))
    return per_pair.groupBy("opportunity_id").agg(best.alias("b")) \
        .select("opportunity_id", *[F.col(f"b.{c}").alias(c) for c in OPP_ACTIVITY_COLS])


def one_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the first by ``order``, then by the other columns.
    An aggregate with a partial stage, so a repeated key stays balanced."""
    rest = [*order, *[c for c in df.columns if c != key and c not in order]]
    return (df.groupBy(key).agg(F.min(F.struct(*rest)).alias("b"))
            .select(key, *[F.col(f"b.{c}").alias(c) for c in rest]))


def engagement_columns(as_of: dt.date | None) -> list[Column]:
    """What the activity of an opportunity says, for one without any as well."""
    n_act, n_high = F.coalesce(F.col("total_activities"), F.lit(0)), \
        F.coalesce(F.col("high_touch_activities"), F.lit(0))
    return [
        F.datediff(as_of_date(as_of), F.col("latest_activity_date")).cast("long")
        .alias("days_since_last_activity"),
        F.when(n_act == 0, "no_engagement").when(n_high >= 5, "high")
         .when(n_high >= 2, "medium").otherwise("low").alias("engagement_quality"),
    ]


def int_sales_activity(activities: DataFrame, opportunities: DataFrame, accounts: DataFrame,
                       as_of: dt.date | None = None) -> DataFrame:
    """One row per opportunity, whatever repeats in the inputs.

    A repeated opportunity keeps its earliest row (created_at, account_id,
    then the other columns), a repeated account its first by name.
    """
    acts, per_opp = counted_activities(activities), opportunity_activity(activities)
    per_account = acts.groupBy("account_id").agg(
        F.count("activity_id").alias("total_account_activities"),
        count_when(F.col("is_high_touch")).alias("account_high_touch_count"),
        F.max("activity_date").alias("latest_account_activity_date"),
        F.count_distinct("assigned_rep").alias("total_reps_engaged"),
    )
    a = one_per_key(accounts.select("account_id", "account_name", "tier", "tier_rank"),
                    "account_id", ["account_name"])
    o = one_per_key(opportunities.select(
        "opportunity_id", "account_id", "stage",
        round2(F.col("amount")).alias("amount"),
        round2(F.col("weighted_amount").cast(MONEY)).alias("weighted_amount"),
        "probability", "is_won", "is_lost", "is_open", "close_date",
        F.col("created_at").alias("opportunity_created_at")),
        "opportunity_id", ["opportunity_created_at", "account_id"])
    # by opportunity first, as ``o`` is grouped by it; then both by account
    j = o.join(per_opp, "opportunity_id", "left").join(per_account, "account_id", "left") \
         .join(a, "account_id", "left")
    return j.select(
        "opportunity_id", "account_id", "stage", "amount", "weighted_amount", "probability",
        "is_won", "is_lost", "is_open", "close_date", "opportunity_created_at",
        "account_name", "tier", "tier_rank",
        _zero("total_activities"), _zero("high_touch_activities"), _zero("positive_outcomes"),
        _zero("total_calls"), _zero("total_meetings"), _zero("total_demos"),
        _zero("total_emails"), _zero("reps_involved"),
        "avg_activity_duration", "positive_outcome_rate", "latest_activity_date",
        "first_activity_date",
        _zero("total_account_activities"), _zero("account_high_touch_count"),
        "latest_account_activity_date", _zero("total_reps_engaged"),
        *engagement_columns(as_of),
    )


# ------------------------------------------------------------------- D5
# Opportunity stage priority when choosing a lead's deal.
STAGE_PRIORITY = {
    "closed won": 1, "negotiation": 2, "proposal": 3, "qualification": 4,
    "prospecting": 5, "closed lost": 6,
}
OTHER_STAGE_PRIORITY = 7

BEST_OPP_COLS = ["opportunity_id", "stage", "amount", "weighted_amount", "is_won",
                 "is_lost", "is_open", "close_date", "probability"]


def _stage_priority(stage: Column) -> Column:
    expr = None
    for name, rank in STAGE_PRIORITY.items():
        expr = F.when(stage == name, rank) if expr is None else expr.when(stage == name, rank)
    return expr.otherwise(OTHER_STAGE_PRIORITY)


def best_opportunity_per_lead(opportunities: DataFrame) -> DataFrame:
    """One opportunity per lead: stage priority, then amount desc (NULL
    last), then opportunity_id."""
    key = F.struct(
        _stage_priority(F.col("stage")).alias("k1"),
        F.col("amount").isNull().alias("k2"),
        (-F.col("amount")).alias("k3"),
        *[F.col(c) for c in BEST_OPP_COLS],
    )
    return (
        opportunities.where(F.col("lead_id").isNotNull())
        .groupBy("lead_id").agg(F.min(key).alias("b"))
        .select("lead_id", *[F.col(f"b.{c}").alias(c) for c in BEST_OPP_COLS])
    )


def left_join_spread(left: DataFrame, right: DataFrame, key: str, own: str) -> DataFrame:
    """Left join on ``key``; left rows without a key match nothing, so they are
    dealt out by ``own`` (their own id) instead of meeting in one partition."""
    spread = F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col(own)))
    other = right.where(F.col(key).isNotNull()).withColumnRenamed(key, "_of")
    return left.withColumn("_key", spread).join(other, F.col("_key") == F.col("_of"), "left").drop("_key", "_of")


LEAD_COLS = [
    "lead_id", "contact_id", "campaign_id", "lead_source", "lead_status", "assigned_rep",
    "lead_created_at", "converted_at", "is_converted", "is_conversion_date_missing",
    "days_to_convert", "campaign_name", "campaign_type", "campaign_status", "channel",
    "campaign_variant", "budget", "actual_spend", "budget_utilisation_pct",
    "is_spend_missing", "account_id", "is_decision_maker", "opportunity_id",
]


def int_leads_with_campaigns(leads: DataFrame, campaigns: DataFrame,
                             opportunities: DataFrame, contacts: DataFrame,
                             with_contact: Callable[[DataFrame], DataFrame] | None = None,
                             with_opportunity: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """D5. ``with_contact`` and ``with_opportunity`` may join more columns to
    the contacts and to the chosen opportunities, which are smaller than the
    leads; the columns are carried along. The contact adds the fewest columns
    and comes first, the campaign adds the most and comes last, so that the
    leads move while they are narrow."""
    ct = contacts.where(~F.col("is_orphaned")).select("contact_id", "account_id",
                                                     "is_decision_maker")
    o = best_opportunity_per_lead(opportunities)
    plain = set(ct.columns) | set(o.columns)
    ct = with_contact(ct) if with_contact else ct
    o = with_opportunity(o) if with_opportunity else o
    more = [c for c in (*ct.columns, *o.columns) if c not in plain]
    c = campaigns.select(
        "campaign_id", "campaign_name", "campaign_type", "campaign_status", "channel",
        "campaign_variant", round2(F.col("budget")).alias("budget"),
        round2(F.col("actual_spend")).alias("actual_spend"), "budget_utilisation_pct",
        "is_spend_missing")
    l = leads.select(
        "lead_id", "contact_id", "campaign_id", "lead_source", "lead_status",
        "assigned_rep", F.col("created_at").alias("lead_created_at"), "converted_at",
        "is_converted", "is_conversion_date_missing", "days_to_convert")
    j = left_join_spread(left_join_spread(l, ct, "contact_id", "lead_id").join(o, "lead_id", "left"),
                         c, "campaign_id", "lead_id")
    return j.select(
        *LEAD_COLS,
        F.col("stage").alias("opportunity_stage"),
        round2(F.col("amount")).alias("opportunity_amount"),
        round2(F.col("weighted_amount").cast(MONEY)).alias("weighted_amount"),
        "is_won", "is_lost", "is_open", "close_date", "probability",
        F.when(F.col("campaign_id").isNotNull(), "campaign").otherwise("organic")
         .alias("attribution_type"),
        F.when(F.col("is_won"), "closed_won").when(F.col("is_lost"), "closed_lost")
         .when(F.col("is_converted"), "in_pipeline").otherwise("not_converted")
         .alias("lead_outcome"),
        *more,
    )
