"""Stored views of the staging and intermediate models.

``create_views`` stores the 14 staging and 5 intermediate models as SQL views
over catalog tables, in databases of their own, so any session that shares the
catalog reads ``intermediate.int_payment_health`` by name. Nothing is
materialised; a view is planned like the DataFrame model of its name, which
stays the source the marts are built from. Both give the same rows and types
(tests, and the registered entry ``s2_stored_views``). The texts move rows in the
same columns and order as the models do, so a query that reads a view and its model
shuffles the rows of the large tables once (Spark reuses equal exchanges, unless a
final sort-based aggregate lies below: then view and model each have their own).

The texts use the session's UTC zone and ANSI mode as the models do
(``session.configure``); "today" is the reader's date, or a fixed one if the
views are created with ``as_of``. In ``{...}`` stand the databases and the
expressions that many columns share.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from tidemark.functions.expr import WHITESPACE
from tidemark.operators.intermediate import OTHER_STAGE_PRIORITY, STAGE_PRIORITY
from tidemark.operators.staging import (
    CLOSED_STAGES, CONVERSION_EVENTS, DECISION_MAKER_TITLES, HIGH_TOUCH_TYPES, POSITIVE_OUTCOMES, STAGING,
)

_WHITE = "".join(f"\\u{ord(c):04x}" for c in WHITESPACE)


def _clean(c: str) -> str:
    return f"lower(btrim({c}, '{_WHITE}'))"


def _flag(condition: str) -> str:
    return f"coalesce({condition}, false)"


def _money(c: str) -> str:
    return f"cast({c} as decimal(20,9))"


def _whole(c: str) -> str:
    return f"cast(round({c}) as bigint)"


def _ts(c: str) -> str:
    return f"cast({c} as timestamp)"


def _date(c: str) -> str:
    return f"cast({c} as date)"


def _in(c: str, values) -> str:
    return f"{c} in ({', '.join(repr(v) for v in values)})"


def _elapsed(unit: str, start: str, end: str) -> str:
    return f"case when {end} is not null and {start} is not null then timestampdiff({unit}, {start}, {end}) end"


def _ratio(num: str, den: str, times: int = 1) -> str:
    """round(num / den * times, 2) of money, rounded once (see ``expr.exact_ratio``)."""
    n, d = f"abs(cast({num} as decimal(30,9)))", f"cast({den} as decimal(30,9))"
    twice, over = f"({n} * {200 * times}BD + {d})", f"({d} * 2BD)"
    hundredths = f"cast(({twice} - {twice} % {over}) / {over} as decimal(30,0))"
    return f"cast((case when {num} < 0 then -{hundredths} else {hundredths} end) / 100BD as decimal(32,2))"


# Staging: column -> SQL, where a bare name is taken over as it is.
def _staging(today: str) -> dict[str, list[tuple[str, str]]]:
    same = lambda *names: [(n, n) for n in names]
    clean = lambda *names: [(n, _clean(n)) for n in names]
    status, stage = _clean("status"), _clean("stage")
    pay, order = _clean("payment_status"), _clean("order_status")
    seconds = _whole("session_duration_seconds")
    start, end = _date("start_date"), _date("end_date")
    created, price = _ts("created_at"), _money("unit_price")
    tier, usage = _clean("tier"), _whole("usage_count")
    return {
        "stg_crm__accounts": [
            *same("account_id", "account_name"), *clean("industry", "country", "account_status", "tier"),
            ("employee_count", _whole("employee_count")), ("created_at", created),
            ("is_churned", _flag(f"{_clean('account_status')} = 'churned'")),
            ("tier_rank", f"case {tier} when 'enterprise' then 3 when 'growth' then 2 when 'starter' then 1 else 0 end")],
        "stg_crm__contacts": [
            *same("contact_id", "account_id", "full_name"), *clean("email", "job_title"), *same("phone"),
            ("created_at", created), ("is_orphaned", "account_id is null"),
            ("is_decision_maker", _flag(_in(_clean("job_title"), DECISION_MAKER_TITLES)))],
        "stg_crm__leads": [
            *same("lead_id", "contact_id", "campaign_id"), *clean("lead_source"), ("lead_status", status),
            *same("assigned_rep"), ("created_at", created), ("converted_at", _ts("converted_at")),
            ("is_conversion_date_missing", _flag(f"{status} = 'converted' and converted_at is null")),
            ("is_converted", _flag(f"{status} = 'converted'")),
            ("days_to_convert", _elapsed("DAY", created, _ts("converted_at")))],
        "stg_crm__opportunities": [
            *same("opportunity_id", "account_id", "lead_id"), *clean("stage", "currency"),
            ("amount", _money("amount")), ("probability", "cast(probability as double)"),
            ("close_date", _date("close_date")), ("created_at", created),
            ("is_close_date_missing", _flag(f"{_in(stage, CLOSED_STAGES)} and close_date is null")),
            ("is_won", _flag(f"{stage} = 'closed won'")), ("is_lost", _flag(f"{stage} = 'closed lost'")),
            ("is_open", _flag(f"not ({_in(stage, CLOSED_STAGES)})")),
            ("weighted_amount", f"round(cast({_money('amount')} as double) * cast(probability as double) / 100, 2)")],
        "stg_crm__campaigns": [
            *same("campaign_id", "campaign_name"), *clean("campaign_type"), ("campaign_status", status),
            *clean("channel"), *same("owner"), *clean("campaign_variant"), ("budget", _money("budget")),
            ("actual_spend", _money("actual_spend")), ("target_leads", _whole("target_leads")),
            ("start_date", start), ("end_date", end), ("is_spend_missing", "actual_spend is null"),
            ("budget_utilisation_pct", f"case when actual_spend is not null and {_money('budget')} > 0 then "
                                       f"{_ratio(_money('actual_spend'), _money('budget'), 100)} end"),
            ("is_completed", _flag(f"{end} < {today}"))],
        "stg_crm__activities": [
            *same("activity_id", "contact_id", "opportunity_id", "account_id"), *clean("activity_type", "outcome"),
            *same("assigned_rep", "notes"), ("duration_minutes", _whole("duration_minutes")),
            ("activity_date", _date("activity_date")), ("created_at", created),
            ("is_date_missing", "activity_date is null"),
            ("is_positive_outcome", _flag(_in(_clean("outcome"), POSITIVE_OUTCOMES))),
            ("is_high_touch", _flag(_in(_clean("activity_type"), HIGH_TOUCH_TYPES)))],
        "stg_crm__support_tickets": [
            *same("ticket_id", "account_id", "contact_id"), *clean("category", "priority"), ("ticket_status", status),
            *same("agent"), ("csat_score", _whole("csat_score")),
            ("first_response_hours", "cast(first_response_hours as double)"), ("created_at", created),
            ("resolved_at", _ts("resolved_at")),
            ("is_csat_missing", _flag(f"{status} in ('resolved', 'closed') and csat_score is null")),
            ("is_low_csat", _flag(f"csat_score is not null and {_whole('csat_score')} <= 2")),
            ("is_high_priority", _flag(f"{_clean('priority')} in ('high', 'critical')")),
            ("resolution_hours", _elapsed("HOUR", created, _ts("resolved_at")))],
        "stg_erp__products": [
            *same("product_id", "product_name"), *clean("category", "billing_type"), ("unit_price", price),
            ("is_recurring", _flag(f"{_clean('billing_type')} = 'subscription'")),
            ("price_tier", f"case when {price} >= 5000 then 'enterprise' when {price} >= 500 then 'mid-market' else 'smb' end")],
        "stg_erp__orders": [
            *same("order_id", "account_id", "product_id", "opportunity_id"), *clean("order_status"),
            ("quantity", _whole("quantity")), ("unit_price", price), ("total_amount", _money("total_amount")),
            ("order_date", _date("order_date")), ("is_refund", _flag(f"{price} < 0")),
            ("is_completed", _flag(f"{order} = 'completed'")), ("is_cancelled", _flag(f"{order} = 'cancelled'")),
            ("recognised_revenue", f"case when {order} = 'completed' and {price} > 0 then {_money('total_amount')} "
                                   f"else {_money('0')} end")],
        "stg_erp__invoices": [
            *same("invoice_id", "subscription_id", "account_id"), ("amount_due", _money("amount_due")),
            ("amount_paid", _money("amount_paid")), ("due_date", _date("due_date")), ("paid_date", _date("paid_date")),
            *clean("payment_status"),
            ("is_payment_null", _flag(f"{pay} in ('overdue', 'unpaid') and amount_paid is null")),
            ("is_paid", _flag(f"{pay} = 'paid'")), ("is_overdue", _flag(f"{pay} = 'overdue'")),
            ("outstanding_amount", f"case when amount_paid is not null then cast(round({_money('amount_due')} - "
                                   f"{_money('amount_paid')}, 2) as decimal(20,9)) else {_money('amount_due')} end"),
            ("days_overdue", f"cast(case when {pay} = 'overdue' then datediff({today}, {_date('due_date')}) else 0 end as bigint)")],
        "stg_erp__subscriptions": [
            *same("subscription_id", "account_id", "product_id", "opportunity_id"), ("subscription_status", status),
            *clean("billing_cycle"), ("mrr", _money("mrr")), ("start_date", start), ("end_date", end),
            ("is_date_inverted", _flag(f"{end} < {start}")), ("is_active", _flag(f"{status} = 'active'")),
            ("is_churned", _flag(f"{status} = 'churned'")), ("arr", f"round({_money('mrr')} * 12, 2)"),
            ("subscription_duration_days", f"cast(case when {end} >= {start} then datediff({end}, {start}) end as bigint)")],
        "stg_erp__payments": [
            *same("payment_id", "invoice_id", "account_id"), *clean("payment_method", "payment_status"),
            *same("failure_reason", "gateway_ref"), ("amount", _money("amount")),
            ("retry_count", _whole("retry_count")), ("payment_date", _date("payment_date")), ("created_at", created),
            ("is_payment_date_missing", _flag(f"{pay} = 'successful' and payment_date is null")),
            ("is_successful", _flag(f"{pay} = 'successful'")), ("is_failed", _flag(f"{pay} = 'failed'")),
            ("is_repeat_failure", _flag(f"{_whole('retry_count')} >= 2"))],
        "stg_web__web_events": [
            *same("event_id", "contact_id"), *clean("event_type"), *same("page_url", "session_id"),
            *clean("utm_source", "utm_campaign"), ("event_timestamp", _ts("event_timestamp")),
            ("event_date", f"to_date({_ts('event_timestamp')})"),
            ("event_hour", f"cast(hour({_ts('event_timestamp')}) as bigint)"),
            ("event_month", f"date_format({_ts('event_timestamp')}, 'yyyy-MM')"),
            ("is_page_view", _flag(f"{_clean('event_type')} = 'page_view'")),
            ("is_conversion_event", _flag(_in(_clean("event_type"), CONVERSION_EVENTS))),
            ("is_pricing_page", _flag(f"{_clean('page_url')} = '/pricing'"))],
        "stg_web__feature_usage": [
            *same("usage_id", "account_id", "contact_id"), *clean("feature_name", "device_type"),
            ("usage_count", usage), ("session_duration_seconds", seconds), ("usage_date", _date("usage_date")),
            ("created_at", created), ("is_date_missing", "usage_date is null"), ("is_zero_usage", _flag(f"{usage} = 0")),
            ("engagement_level", f"case when {usage} >= 100 then 'power' when {usage} >= 20 then 'regular' "
                                 f"when {usage} >= 1 then 'light' else 'inactive' end"),
            ("session_duration_minutes", f"case when {seconds} is not null then round({seconds} / 60, 2) end")],
    }


_INVOICES = """
  select account_id, count(invoice_id) as total_invoices, count_if(is_paid) as paid_invoices,
         count_if(is_overdue) as overdue_invoices, round(sum(amount_due), 2) as total_billed,
         round(sum(coalesce(amount_paid, cast(0 as decimal(20,9)))), 2) as total_collected,
         round(sum(outstanding_amount), 2) as total_outstanding, max(days_overdue) as max_days_overdue
  from {staging}.stg_erp__invoices where account_id is not null group by account_id"""

# What needs no order of the payments: one aggregate, combined in the tasks before anything moves.
_PAYMENT_COUNTS = """
  select account_id, count(payment_id) as total_payments, count_if(is_successful) as successful_payments,
         count_if(is_failed) as failed_payments, count_if(is_repeat_failure) as repeat_failures,
         round(cast(sum(case when is_successful then amount else cast(0 as decimal(20,9)) end) as decimal(38,9)), 2)
           as total_payment_amount
  from {staging}.stg_erp__payments where account_id is not null group by account_id"""

# Payments in equal ranges of (account, time): values of a whole range, of which the last row stays.
_RANGES = """
  select *, spark_partition_id() as chunk from (
    select /*+ REPARTITION_BY_RANGE(account_id, created_at, payment_id) */ account_id, payment_id, created_at,
           payment_date, amount, failure_reason, is_successful, is_failed, is_repeat_failure
    from {staging}.stg_erp__payments where account_id is not null)"""
_IN_RANGE = """
  select *, lag(is_failed) over (partition by account_id, chunk order by created_at, payment_id) as previous_failed
  from ranges"""
_RANGE_TOTALS = """
  select * from (
    select account_id, chunk, is_failed, lead(1) over in_time is null as at_end,
           count(payment_id) over all_rows as n, count_if(is_successful) over all_rows as n_ok,
           count_if(is_failed) over all_rows as n_failed, count_if(is_repeat_failure) over all_rows as n_repeat,
           sum(case when is_successful then amount else cast(0 as decimal(20,9)) end) over all_rows as ok_amount,
           count(case when is_successful then amount end) over all_rows as n_amounts,
           max(payment_date) over all_rows as latest, min(payment_date) over all_rows as earliest,
           last(case when is_failed then struct(created_at, payment_id, failure_reason) end) ignore nulls
             over all_rows as failure,
           count_if(is_failed and previous_failed) over all_rows as inner_pairs,
           first(is_failed) over all_rows as first_failed
    from in_range
    window in_time as (partition by account_id, chunk order by created_at, payment_id),
           all_rows as (partition by account_id, chunk order by created_at, payment_id
                        rows between unbounded preceding and unbounded following))
  where at_end"""
_PAIRED = """
  select *, inner_pairs + coalesce(cast(first_failed and lag(is_failed) over (partition by account_id order by chunk)
                                        as bigint), 0) as pairs
  from range_totals"""
_PAYMENTS = """
  select account_id, n as total_payments, n_ok as successful_payments, n_failed as failed_payments,
         n_repeat as repeat_failures, round(ok_amount, 2) as total_payment_amount,
         case when n_amounts > 0 then {average} end as avg_payment_amount, latest as latest_payment_date,
         earliest as first_payment_date, failure.failure_reason as most_recent_failure_reason,
         pairs as consecutive_failure_count
  from (select account_id, lead(1) over (partition by account_id order by chunk) is null as at_end,
               sum(n) over all_rows as n, sum(n_ok) over all_rows as n_ok, sum(n_failed) over all_rows as n_failed,
               sum(n_repeat) over all_rows as n_repeat, sum(ok_amount) over all_rows as ok_amount,
               sum(n_amounts) over all_rows as n_amounts, max(latest) over all_rows as latest,
               min(earliest) over all_rows as earliest, last(failure) ignore nulls over all_rows as failure,
               sum(pairs) over all_rows as pairs
        from paired
        window all_rows as (partition by account_id order by chunk
                            rows between unbounded preceding and unbounded following))
  where at_end"""
_PAYMENT_PARTS = [("invoices", _INVOICES), ("ranges", _RANGES), ("in_range", _IN_RANGE),
                  ("range_totals", _RANGE_TOTALS), ("paired", _PAIRED), ("payments", _PAYMENTS)]

# Intermediate: CTEs and the final select.
_INTERMEDIATE: dict[str, tuple[list[tuple[str, str]], str]] = {
    "int_accounts_with_subscriptions": ([("invoices", _INVOICES), ("payments", _PAYMENT_COUNTS), ("subscriptions", """
  select account_id, count(subscription_id) as total_subscriptions, count_if(is_active) as active_subscriptions,
         count_if(is_churned) as churned_subscriptions, round(sum(mrr), 2) as total_mrr, round(sum(arr), 2) as total_arr,
         max(start_date) as latest_subscription_start, min(start_date) as earliest_subscription_start,
         avg(subscription_duration_days) as avg_subscription_duration_days
  from {staging}.stg_erp__subscriptions where not is_date_inverted and account_id is not null group by account_id""")], """
select a.account_id, a.account_name, a.industry, a.country, a.account_status, a.tier, a.tier_rank, a.is_churned,
       a.created_at, coalesce(s.total_subscriptions, 0) as total_subscriptions,
       coalesce(s.active_subscriptions, 0) as active_subscriptions,
       coalesce(s.churned_subscriptions, 0) as churned_subscriptions,
       coalesce(s.total_mrr, cast(0 as decimal(20,9))) as total_mrr,
       coalesce(s.total_arr, cast(0 as decimal(20,9))) as total_arr,
       s.latest_subscription_start, s.earliest_subscription_start,
       coalesce(s.avg_subscription_duration_days, 0D) as avg_subscription_duration_days,
       coalesce(i.total_invoices, 0) as total_invoices, coalesce(i.paid_invoices, 0) as paid_invoices,
       coalesce(i.overdue_invoices, 0) as overdue_invoices,
       coalesce(i.total_billed, cast(0 as decimal(20,9))) as total_billed,
       coalesce(i.total_collected, cast(0 as decimal(20,9))) as total_collected,
       coalesce(i.total_outstanding, cast(0 as decimal(20,9))) as total_outstanding,
       coalesce(i.max_days_overdue, 0L) as max_days_overdue, coalesce(p.total_payments, 0) as total_payments,
       coalesce(p.successful_payments, 0) as successful_payments, coalesce(p.failed_payments, 0) as failed_payments,
       coalesce(p.repeat_failures, 0) as repeat_failures,
       coalesce(p.total_payment_amount, cast(0 as decimal(20,9))) as total_payment_amount,
       case when i.total_billed > 0 then {collected} else 0 end as collection_rate_pct,
       case when p.total_payments > 0 then round(p.failed_payments / p.total_payments * 100, 2) else 0D end
         as payment_failure_rate_pct
from {staging}.stg_crm__accounts a
left join subscriptions s on a.account_id = s.account_id
left join invoices i on a.account_id = i.account_id
left join payments p on a.account_id = p.account_id"""),
    "int_payment_health": (_PAYMENT_PARTS, """
select p.account_id, p.total_payments, p.successful_payments, p.failed_payments, p.repeat_failures,
       p.failed_payments as total_cumulative_failures, p.total_payment_amount as total_collected, p.avg_payment_amount,
       p.latest_payment_date, p.first_payment_date, p.consecutive_failure_count, p.most_recent_failure_reason,
       i.total_invoices, i.overdue_invoices, i.total_billed, i.total_outstanding, i.max_days_overdue,
       round(100BD - least(cast(p.failed_payments as decimal(20,9)) * 5, 30BD)
                   - least(cast(p.consecutive_failure_count as decimal(20,9)) * 10, 30BD)
                   - if(i.overdue_invoices is null, null, least(cast(i.overdue_invoices as decimal(20,9)) * 3, 20BD))
                   - if(i.max_days_overdue is null, null, least(cast(i.max_days_overdue as decimal(20,9)) * 0.5BD, 20BD)), 2)
         as payment_health_score,
       case when p.consecutive_failure_count >= 3 then 'critical' when p.failed_payments >= 5 then 'poor'
            when p.failed_payments >= 2 then 'at_risk' else 'healthy' end as payment_health_band
from payments p left join invoices i on p.account_id = i.account_id"""),
    "int_customer_health": ([("tickets", """
  select account_id, count(ticket_id) as total_tickets, count_if(is_high_priority) as high_priority_tickets,
         count_if(is_low_csat) as low_csat_tickets, count_if(ticket_status = 'escalated') as escalated_tickets,
         count_if(ticket_status = 'open') as open_tickets, avg(csat_score) as avg_csat_score,
         avg(resolution_hours) as avg_resolution_hours, max(created_at) as latest_ticket_date
  from {staging}.stg_crm__support_tickets where account_id is not null group by account_id"""), ("usage", """
  select account_id, count(distinct feature_name) as distinct_features_used, sum(usage_count) as total_usage_count,
         count_if(engagement_level = 'power') as power_usage_days,
         count_if(engagement_level = 'inactive') as inactive_days, max(usage_date) as latest_usage_date,
         avg(session_duration_minutes) as avg_session_duration_minutes
  from {staging}.stg_web__feature_usage where account_id is not null and not is_date_missing group by account_id"""),
        ("joined", """
  select a.account_id, a.account_name, a.industry, a.tier, a.tier_rank, a.account_status, a.is_churned,
         round(s.total_mrr, 2) as total_mrr, round(s.total_arr, 2) as total_arr, s.active_subscriptions,
         s.collection_rate_pct, s.payment_failure_rate_pct, s.overdue_invoices, s.repeat_failures,
         coalesce(t.total_tickets, 0) as total_tickets, coalesce(t.high_priority_tickets, 0) as high_priority_tickets,
         coalesce(t.low_csat_tickets, 0) as low_csat_tickets, coalesce(t.escalated_tickets, 0) as escalated_tickets,
         coalesce(t.open_tickets, 0) as open_tickets, t.avg_csat_score, t.avg_resolution_hours, t.latest_ticket_date,
         coalesce(u.distinct_features_used, 0) as distinct_features_used,
         coalesce(u.total_usage_count, 0L) as total_usage_count, coalesce(u.power_usage_days, 0) as power_usage_days,
         coalesce(u.inactive_days, 0) as inactive_days, u.latest_usage_date, u.avg_session_duration_minutes
  from {staging}.stg_crm__accounts a
  left join {intermediate}.int_accounts_with_subscriptions s on a.account_id = s.account_id
  left join tickets t on a.account_id = t.account_id
  left join usage u on a.account_id = u.account_id"""), ("scored", """
  select *, cast(round(
      least(cast(payment_failure_rate_pct as decimal(18,2)) * 0.5BD, 15BD)
      + least(cast(coalesce(overdue_invoices, 0) as decimal(20,9)) * 2, 10BD)
      + least(cast(coalesce(repeat_failures, 0) as decimal(20,9)) * 5, 10BD)
      + least(cast(low_csat_tickets as decimal(20,9)) * 3, 15BD)
      + least(cast(high_priority_tickets as decimal(20,9)) * 2, 10BD)
      + least(cast(escalated_tickets as decimal(20,9)) * 5, 10BD)
      + cast(case when total_usage_count = 0 then 30 when total_usage_count < 10 then 20
                  when total_usage_count < 50 then 10 else 0 end as decimal(20,9)), 2) as double) as churn_risk_score
  from joined""")], """
select *, case when churn_risk_score >= 60 then 'critical' when churn_risk_score >= 40 then 'high'
               when churn_risk_score >= 20 then 'medium' else 'low' end as churn_risk_band
from scored"""),
    "int_sales_activity": ([("counted", """
  select * from {staging}.stg_crm__activities where not is_date_missing and account_id is not null"""), ("per_pair", """
  select *, round(positive_outcomes / nullif(total_activities, 0) * 100, 2) as positive_outcome_rate
  from (select opportunity_id, account_id, count(activity_id) as total_activities,
               count_if(is_high_touch) as high_touch_activities, count_if(is_positive_outcome) as positive_outcomes,
               count_if(activity_type = 'call') as total_calls, count_if(activity_type = 'meeting') as total_meetings,
               count_if(activity_type = 'demo') as total_demos, count_if(activity_type = 'email') as total_emails,
               count(distinct assigned_rep) as reps_involved, avg(duration_minutes) as avg_activity_duration,
               max(activity_date) as latest_activity_date, min(activity_date) as first_activity_date
        from counted where opportunity_id is not null group by opportunity_id, account_id)"""), ("per_opportunity", """
  select opportunity_id, b.total_activities, b.high_touch_activities, b.positive_outcomes, b.total_calls,
         b.total_meetings, b.total_demos, b.total_emails, b.reps_involved, b.avg_activity_duration,
         b.positive_outcome_rate, b.latest_activity_date, b.first_activity_date
  from (select opportunity_id, max(struct(latest_activity_date as k1, account_id as k2, total_activities,
                 high_touch_activities, positive_outcomes, total_calls, total_meetings, total_demos, total_emails,
                 reps_involved, avg_activity_duration, positive_outcome_rate, latest_activity_date,
                 first_activity_date)) as b
        from per_pair group by opportunity_id)"""), ("per_account", """
  select account_id, count(activity_id) as total_account_activities,
         count_if(is_high_touch) as account_high_touch_count, max(activity_date) as latest_account_activity_date,
         count(distinct assigned_rep) as total_reps_engaged
  from counted group by account_id"""), ("account", """
  select account_id, b.account_name, b.tier, b.tier_rank
  from (select account_id, min(struct(account_name, tier, tier_rank)) as b
        from {staging}.stg_crm__accounts group by account_id)"""), ("opportunity", """
  select opportunity_id, b.opportunity_created_at, b.account_id, b.stage, b.amount, b.weighted_amount,
         b.probability, b.is_won, b.is_lost, b.is_open, b.close_date
  from (select opportunity_id, min(struct(opportunity_created_at, account_id, stage, amount, weighted_amount,
                 probability, is_won, is_lost, is_open, close_date)) as b
        from (select opportunity_id, account_id, stage, round(amount, 2) as amount,
                     round(cast(weighted_amount as decimal(20,9)), 2) as weighted_amount, probability, is_won, is_lost,
                     is_open, close_date, created_at as opportunity_created_at
              from {staging}.stg_crm__opportunities) group by opportunity_id)""")], """
select o.opportunity_id, o.account_id, o.stage, o.amount, o.weighted_amount, o.probability, o.is_won,
       o.is_lost, o.is_open, o.close_date, o.opportunity_created_at, a.account_name, a.tier,
       a.tier_rank, coalesce(p.total_activities, 0) as total_activities,
       coalesce(p.high_touch_activities, 0) as high_touch_activities,
       coalesce(p.positive_outcomes, 0) as positive_outcomes, coalesce(p.total_calls, 0) as total_calls,
       coalesce(p.total_meetings, 0) as total_meetings, coalesce(p.total_demos, 0) as total_demos,
       coalesce(p.total_emails, 0) as total_emails, coalesce(p.reps_involved, 0) as reps_involved,
       p.avg_activity_duration, p.positive_outcome_rate, p.latest_activity_date, p.first_activity_date,
       coalesce(t.total_account_activities, 0) as total_account_activities,
       coalesce(t.account_high_touch_count, 0) as account_high_touch_count, t.latest_account_activity_date,
       coalesce(t.total_reps_engaged, 0) as total_reps_engaged,
       cast(datediff({today}, p.latest_activity_date) as bigint) as days_since_last_activity,
       case when coalesce(p.total_activities, 0) = 0 then 'no_engagement'
            when p.high_touch_activities >= 5 then 'high' when p.high_touch_activities >= 2 then 'medium'
            else 'low' end as engagement_quality
from opportunity o
left join per_opportunity p on o.opportunity_id = p.opportunity_id
left join per_account t on o.account_id = t.account_id
left join account a on o.account_id = a.account_id"""),
    "int_leads_with_campaigns": ([("chosen", """
  select lead_id, b.opportunity_id, b.stage, b.amount, b.weighted_amount, b.is_won, b.is_lost, b.is_open,
         b.close_date, b.probability
  from (select lead_id, min(struct({priority} as k1, amount is null as k2, -amount as k3, opportunity_id, stage,
                 amount, weighted_amount, is_won, is_lost, is_open, close_date, probability)) as b
        from {staging}.stg_crm__opportunities where lead_id is not null group by lead_id)"""), ("with_contact", """
  select * from (
    select lead_id, contact_id, campaign_id, lead_source, lead_status, assigned_rep, created_at as lead_created_at,
           converted_at, is_converted, is_conversion_date_missing, days_to_convert,
           coalesce(contact_id, concat('\\u0000', lead_id)) as own_contact
    from {staging}.stg_crm__leads) l
  left join (select contact_id as known, account_id, is_decision_maker from {staging}.stg_crm__contacts
             where not is_orphaned and contact_id is not null) t on own_contact = t.known"""), ("with_opportunity", """
  select l.*, o.opportunity_id, o.stage, o.amount, o.weighted_amount, o.is_won, o.is_lost, o.is_open, o.close_date,
         o.probability, coalesce(l.campaign_id, concat('\\u0000', l.lead_id)) as own_campaign
  from with_contact l left join chosen o on l.lead_id = o.lead_id"""), ("campaign", """
  select campaign_id as known, campaign_name, campaign_type, campaign_status, channel, campaign_variant,
         round(budget, 2) as budget, round(actual_spend, 2) as actual_spend, budget_utilisation_pct, is_spend_missing
  from {staging}.stg_crm__campaigns where campaign_id is not null""")], """
select l.lead_id, l.contact_id, l.campaign_id, l.lead_source, l.lead_status, l.assigned_rep,
       l.lead_created_at, l.converted_at, l.is_converted, l.is_conversion_date_missing, l.days_to_convert,
       c.campaign_name, c.campaign_type, c.campaign_status, c.channel, c.campaign_variant,
       c.budget, c.actual_spend, c.budget_utilisation_pct, c.is_spend_missing, l.account_id, l.is_decision_maker,
       l.opportunity_id, l.stage as opportunity_stage, round(l.amount, 2) as opportunity_amount,
       round(cast(l.weighted_amount as decimal(20,9)), 2) as weighted_amount, l.is_won, l.is_lost, l.is_open,
       l.close_date, l.probability,
       case when l.campaign_id is not null then 'campaign' else 'organic' end as attribution_type,
       case when l.is_won then 'closed_won' when l.is_lost then 'closed_lost' when l.is_converted then 'in_pipeline'
            else 'not_converted' end as lead_outcome
from with_opportunity l
left join campaign c on l.own_campaign = c.known"""),
}

LAYERS = {"staging": tuple(STAGING), "intermediate": tuple(_INTERMEDIATE)}


def view_sql(name: str, raw: str = "raw", staging: str = "staging", intermediate: str = "intermediate",
             as_of: dt.date | None = None) -> str:
    """The query of a stored view over catalog tables."""
    today = f"DATE '{as_of.isoformat()}'" if as_of else "current_date()"
    if name in STAGING:
        columns = ",\n       ".join(sql if sql == out else f"{sql} as {out}" for out, sql in _staging(today)[name])
        return f"select {columns}\nfrom {raw}.{STAGING[name][0]}"
    parts, final = _INTERMEDIATE[name]
    priority = " ".join(f"when '{s}' then {n}" for s, n in STAGE_PRIORITY.items())
    values = {"staging": staging, "intermediate": intermediate, "today": today,
              "average": _ratio("ok_amount", "n_amounts"),
              "collected": _ratio("coalesce(i.total_collected, cast(0 as decimal(20,9)))", "i.total_billed", 100),
              "priority": f"case stage {priority} else {OTHER_STAGE_PRIORITY} end"}
    text = "with " + ",\n".join(f"{n} as ({sql})" for n, sql in parts) + final if parts else final
    for key, value in values.items():
        text = text.replace("{" + key + "}", value)
    return text


def create_views(spark: SparkSession, raw: str = "raw", staging: str = "staging",
                 intermediate: str = "intermediate", as_of: dt.date | None = None) -> list[str]:
    """Store (or replace) all staging and intermediate views; their names, in order of need."""
    from tidemark.plans.models import MODELS
    from tidemark.sources.publish import sql_string

    made = []
    for database, names in ((staging, LAYERS["staging"]), (intermediate, LAYERS["intermediate"])):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name in names:
            comment = f"COMMENT {sql_string(MODELS[name].description)} " if MODELS[name].description else ""
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} {comment}AS "
                      + view_sql(name, raw, staging, intermediate, as_of))
            made.append(f"{database}.{name}")
    return made
