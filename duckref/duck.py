"""Independent DuckDB SQL for every registered query.

Written directly from the model definitions, not from the Spark code:
fixture CTEs map the pre-registered test views (customer, orders, ...)
to the 14 raw tables, then staging, intermediate and mart CTEs follow.
``sql_for(name)`` assembles a statement with only the CTEs ``name``
needs (found by scanning each CTE body for other CTE names).

Conventions shared with the Spark side for comparison only: the run's
"current date" is pinned to AS_OF and the run timestamp to RUN_TS, and
decimal columns are returned as DOUBLE. Decimal ratios are rounded
exactly with integer arithmetic, because DuckDB divides decimals in
floating point. Conditional counts are written ``count(CASE WHEN c THEN
1 END)``: the warehouse's countif is 0 when no row is true, while
DuckDB's ``count_if`` is NULL when every condition is NULL.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2002-01-01'"
RUN_TS = "TIMESTAMP '2002-01-01 00:00:00'"
M = "DECIMAL(20,9)"
RAWM = "DECIMAL(18,2)"


# The code points TRIM removes (Unicode white space).
WHITE = " || ".join(f"chr({c})" for c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                          0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def clean(x: str) -> str:
    return f"lower(trim({x}, {WHITE}))"


def b(cond: str) -> str:
    return f"coalesce({cond}, false)"


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS HUGEINT)"


def rdiv(num: str, den: str, mult: int = 1) -> str:
    """round(num / den * mult, 2) for num >= 0, den > 0 with <= 2 decimals."""
    return (f"(CAST(({cents(num)} * {200 * mult} + {cents(den)}) "
            f"// (2 * {cents(den)}) AS DOUBLE) / 100)")


def round_double(x: str) -> str:
    """round(x, 2) of a double by its shortest decimal form, half away from zero."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,14)), 2) AS DOUBLE)"


def ravg(x: str) -> str:
    """round(avg(x), 2) exactly, for non-negative x with <= 2 decimals."""
    return (f"CASE WHEN count({x}) > 0 THEN CAST((CAST(round(sum({x}) * 100) AS HUGEINT) * 2 "
            f"+ count({x})) // (2 * count({x})) AS DOUBLE) / 100 END")


def pick(idx: str, values: list) -> str:
    items = ", ".join("NULL" if v is None else "'" + v + "'" for v in values)
    return f"[{items}][{idx} + 1]"


CTES: dict[str, str] = {}

# ------------------------------------------------------------------ raw
CTES["raw_accounts"] = f"""
SELECT concat('A', c.c_custkey) AS account_id, c.c_name AS account_name,
  ' ' || c.c_mktsegment AS industry, n.n_name || ' ' AS country,
  CASE c.c_custkey % 10 WHEN 0 THEN 'Churned' WHEN 1 THEN 'prospect'
    ELSE CASE WHEN c.c_custkey % 4 = 0 THEN chr(160) || 'ACTIVE' || chr(8195) ELSE ' ACTIVE' END END
    AS account_status,
  {pick('c.c_custkey % 3', ['Starter', 'GROWTH ', 'enterprise'])} AS tier,
  CAST(1 + c.c_custkey * 7 % 5000 AS BIGINT) AS employee_count,
  TIMESTAMP '1994-06-01' + to_days(CAST(c.c_custkey % 200 AS INTEGER)) AS created_at
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

CTES["raw_contacts"] = f"""
SELECT concat('C', c_custkey) AS contact_id,
  CASE WHEN c_custkey % 20 = 7 THEN NULL ELSE concat('A', c_custkey) END AS account_id,
  concat('Contact ', c_custkey) AS full_name,
  concat(' USER', c_custkey, '@Example.com') AS email,
  {pick('c_custkey % 8', ['CEO', 'CTO ', 'cfo', 'VP of Sales', 'Head of Operations',
                          'Sales Director', 'analyst', 'engineer'])} AS job_title,
  concat('000-', c_custkey) AS phone,
  TIMESTAMP '1994-07-01' + to_days(CAST(c_custkey % 100 AS INTEGER)) AS created_at
FROM customer"""

CTES["raw_campaigns"] = f"""
SELECT concat('M', s_suppkey) AS campaign_id, s_name AS campaign_name,
  {pick('s_suppkey % 3', ['Email', 'Webinar ', 'PAID'])} AS campaign_type,
  {pick('s_suppkey % 2', ['Active', 'done'])} AS status,
  {pick('s_suppkey % 3', ['Search', 'Social ', 'Partner'])} AS channel,
  concat('owner', s_suppkey % 3) AS owner,
  {pick('s_suppkey % 3', ['Control', 'TREATMENT', None])} AS campaign_variant,
  CAST(CASE WHEN k = 7 THEN 0 ELSE 1000 * (k + 1) END AS {RAWM}) AS budget,
  CAST(CASE WHEN k = 5 THEN NULL WHEN k = 3 THEN 0 ELSE 800 * (k + 1) END AS {RAWM}) AS actual_spend,
  CAST(10 * k AS BIGINT) AS target_leads,
  DATE '1995-01-01' + CAST(200 * k AS INTEGER) AS start_date,
  CASE WHEN k = 9 THEN DATE '2002-06-01'
       ELSE DATE '1995-01-01' + CAST(200 * k + 90 AS INTEGER) END AS end_date
FROM (SELECT *, s_suppkey % 10 AS k FROM supplier)"""

CTES["raw_leads"] = f"""
SELECT concat('L', o_orderkey) AS lead_id, concat('C', o_custkey) AS contact_id,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('M', o_custkey // 15) END AS campaign_id,
  {pick('o_orderkey % 4', ['Web', 'referral ', 'EVENT', 'ads'])} AS lead_source,
  {pick('o_orderkey % 5', [' Converted', 'NEW', 'working', 'nurturing ', 'Disqualified'])}
    AS status,
  concat('rep', o_orderkey % 7) AS assigned_rep,
  o_orderdate + to_hours(20) AS created_at,
  CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 35 <> 0
       THEN o_orderdate + to_hours(CAST(29 + o_orderkey % 400 AS INTEGER)) END AS converted_at
FROM orders"""

CTES["raw_opportunities"] = f"""
SELECT concat('O', o_orderkey) AS opportunity_id, concat('A', o_custkey) AS account_id,
  CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE concat('L', o_orderkey - o_orderkey % 4) END
    AS lead_id,
  CASE WHEN o_orderstatus = 'F' THEN
         CASE WHEN o_orderkey % 3 = 0 THEN 'Closed Lost' ELSE 'Closed Won ' END
       WHEN o_orderstatus = 'O' THEN
         {pick('o_orderkey % 4', ['prospecting', 'Qualification', 'PROPOSAL', 'negotiation'])}
       ELSE 'prospecting' END AS stage,
  'GBP ' AS currency,
  CAST(floor(o_totalprice) AS {RAWM}) AS amount,
  CAST(CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 100 END
            ELSE 10 + 20 * (o_orderkey % 5) END AS DOUBLE) AS probability,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 13 <> 0
       THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 300 - 20 AS INTEGER) END AS close_date,
  o_orderdate AS created_at
FROM orders"""

CTES["raw_activities"] = f"""
SELECT concat('V', event_id) AS activity_id, concat('C', user_id) AS contact_id,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('O', 8 * user_id + event_id % 5) END
    AS opportunity_id,
  CASE WHEN event_id % 7 = 0 THEN concat('A', (user_id + 1) % 10) ELSE concat('A', user_id) END
    AS account_id,
  CASE event_type WHEN 'click' THEN 'Call' WHEN 'view' THEN 'email ' WHEN 'signup' THEN 'MEETING'
       WHEN 'purchase' THEN 'demo' WHEN 'error' THEN 'note' END AS activity_type,
  {pick('event_id % 6', ['Meeting Booked', 'interested ', 'SENT', 'opened', 'no answer',
                         'declined'])} AS outcome,
  concat('rep', event_id % 4) AS assigned_rep, 'n' AS notes,
  CAST(5 + event_id % 55 AS BIGINT) AS duration_minutes,
  CASE WHEN event_id % 11 = 0 OR (user_id % 7 = 2 AND event_id % 4 <> 0)
         OR (user_id % 4 = 1 AND event_id % 6 <> 0) THEN NULL
       ELSE CAST(ts AS DATE) END AS activity_date,
  ts AS created_at
FROM events"""

CTES["raw_support_tickets"] = f"""
SELECT concat('T', event_id) AS ticket_id,
  concat('A', CASE WHEN user_id % 5 = 0 THEN user_id + 1 ELSE user_id END) AS account_id,
  concat('C', user_id) AS contact_id,
  {pick('event_id % 2', ['Billing', 'bug '])} AS category,
  CASE WHEN faulty THEN {pick('event_id % 4', ['Low', 'medium', 'HIGH ', 'critical'])}
       ELSE 'Low' END AS priority,
  CASE WHEN faulty THEN {pick('event_id % 6', ['Escalated', 'open', 'resolved ', 'Closed', 'OPEN', 'resolved'])}
       ELSE 'CLOSED' END AS status,
  concat('agent', event_id % 5) AS agent,
  CAST(CASE WHEN event_id % 7 = 0 THEN NULL WHEN faulty THEN event_id % 5 + 1 ELSE 5 END AS BIGINT)
    AS csat_score,
  CAST(event_id % 48 AS DOUBLE) / 2 AS first_response_hours,
  ts AS created_at,
  CASE WHEN NOT faulty OR event_id % 6 IN (2, 3, 5)
       THEN ts + to_minutes(CAST(90 * (event_id % 50) AS INTEGER)) END AS resolved_at
FROM (SELECT *, event_type = 'error' AND event_id % 3 = user_id % 3 AS faulty FROM events)"""

CTES["raw_feature_usage"] = f"""
SELECT concat('F', event_id) AS usage_id, concat('A', user_id) AS account_id,
  concat('C', user_id) AS contact_id, concat('Feat', event_id % 6) AS feature_name,
  {pick('event_id % 2', ['Mobile', 'desktop '])} AS device_type,
  CAST(CASE user_id % 6 WHEN 0 THEN 0 WHEN 1 THEN event_id % 2 WHEN 2 THEN event_id % 5
       ELSE CASE WHEN event_id % 9 = 0 THEN 150 WHEN event_id % 9 < 4 THEN 30
                 ELSE event_id % 20 END END AS BIGINT) AS usage_count,
  CAST(CASE WHEN event_id % 10 = 0 THEN NULL ELSE 30 * (event_id % 40) END AS BIGINT)
    AS session_duration_seconds,
  CASE WHEN event_id % 12 <> 5 AND event_type IN ('click', 'view') AND user_id % 9 <> 8
        AND (user_id % 6 NOT IN (1, 2) OR event_id % 8 = 0) THEN CAST(ts AS DATE) END AS usage_date,
  ts AS created_at
FROM events"""

CTES["raw_web_events"] = f"""
SELECT concat('W', event_id) AS event_id, concat('C', user_id) AS contact_id,
  {pick('event_id % 7', ['Page_View', 'form_submit ', 'DEMO_REQUEST', 'pricing_view',
                         'blog_view', 'login', 'feature_use'])} AS event_type,
  {pick('event_id % 3', ['/Pricing ', '/blog', '/'])} AS page_url,
  concat('s', user_id, '-', event_id % 10) AS session_id,
  {pick('event_id % 4', ['google', 'Google', 'GOOGLE ', 'bing'])} AS utm_source,
  concat('Camp', event_id % 3) AS utm_campaign,
  ts AS event_timestamp
FROM events"""

CTES["raw_products"] = f"""
SELECT concat('R', p_partkey) AS product_id, p_name AS product_name,
  p_type || ' ' AS category,
  {pick('p_partkey % 2', ['Subscription ', 'one-time'])} AS billing_type,
  CAST(CASE p_partkey % 3 WHEN 0 THEN floor(p_retailprice / 10) WHEN 1 THEN floor(p_retailprice)
       ELSE 6 * floor(p_retailprice) END AS {RAWM}) AS unit_price
FROM part"""

CTES["raw_orders"] = f"""
SELECT concat('D', o_orderkey) AS order_id, concat('A', o_custkey) AS account_id,
  concat('R', 4 * o_custkey // 3) AS product_id,
  CASE WHEN o_orderkey % 8 < 5 THEN concat('O', o_orderkey) END AS opportunity_id,
  CASE o_orderstatus WHEN 'F' THEN 'Completed ' WHEN 'O' THEN 'pending'
       WHEN 'P' THEN 'CANCELLED' END AS order_status,
  CAST(1 + o_orderkey % 5 AS BIGINT) AS quantity,
  CAST(sgn * floor(o_totalprice / 10) AS {RAWM}) AS unit_price,
  CAST((1 + o_orderkey % 5) * sgn * floor(o_totalprice / 10) AS {RAWM}) AS total_amount,
  CAST(o_orderdate AS DATE) AS order_date
FROM (SELECT *, CASE WHEN o_orderkey % 12 = 0 THEN -1 ELSE 1 END AS sgn FROM orders)"""

CTES["raw_subscriptions"] = f"""
SELECT concat('S', o_orderkey) AS subscription_id,
  concat('A', CASE WHEN o_custkey % 13 = 5 THEN o_custkey - 1 ELSE o_custkey END) AS account_id,
  concat('R', 4 * o_custkey // 3) AS product_id,
  CASE WHEN o_orderkey % 8 < 5 THEN concat('O', o_orderkey) END AS opportunity_id,
  CASE WHEN o_orderkey % 8 = 0 THEN 'Churned' WHEN o_orderkey % 20 = 4 THEN 'trial'
       WHEN o_orderkey % 12 = 4 THEN 'paused' ELSE ' ACTIVE' END AS status,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Monthly' ELSE 'annual ' END AS billing_cycle,
  CAST(floor(o_totalprice / 100) AS {RAWM}) AS mrr,
  CAST(o_orderdate AS DATE) AS start_date,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL
       WHEN o_orderkey % 11 = 0 THEN CAST(o_orderdate AS DATE) - 5
       ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 700 AS INTEGER) END AS end_date
FROM orders"""

CTES["raw_invoices"] = f"""
SELECT concat('I', o_orderkey) AS invoice_id,
  concat('S', o_orderkey - o_orderkey % 4) AS subscription_id,
  concat('A', CASE WHEN o_custkey % 17 = 4 THEN o_custkey - 1 ELSE o_custkey END) AS account_id,
  amount_due,
  CAST(CASE st WHEN 'Paid ' THEN amount_due WHEN 'partial' THEN amount_due * 0.4 END AS {RAWM})
    AS amount_paid,
  d + 30 AS due_date, CASE WHEN st = 'Paid ' THEN d + 20 END AS paid_date,
  st AS payment_status
FROM (
  SELECT *, CAST(o_orderdate AS DATE) AS d, CAST(floor(o_totalprice / 10) AS {RAWM}) AS amount_due,
    CASE WHEN o_custkey % 6 = 1 THEN 'overdue'
         WHEN (o_orderkey + o_custkey) % (2 + o_custkey % 5) = 0 THEN 'OVERDUE '
         WHEN o_orderkey % 5 = 1 THEN 'partial' WHEN o_orderkey % 9 = 2 THEN 'unpaid'
         ELSE 'Paid ' END AS st
  FROM orders)"""

CTES["raw_payments"] = f"""
SELECT concat('P', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS payment_id,
  concat('I', l_orderkey) AS invoice_id,
  concat('A', CASE WHEN a % 19 = 6 THEN a - 1 ELSE a END) AS account_id,
  {pick('x % 2', ['Card', 'bank '])} AS payment_method, st AS payment_status,
  CASE WHEN st = 'FAILED' AND x % 6 <> 0
       THEN {pick('x % 3', ['insufficient funds', 'expired card', 'fraud'])} END AS failure_reason,
  concat('g', l_orderkey) AS gateway_ref,
  CAST(floor(l_extendedprice / 10) AS {RAWM}) AS amount,
  CAST(x % 4 AS BIGINT) AS retry_count,
  CASE WHEN st = 'pending' OR x % 21 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS payment_date,
  l_shipdate AS created_at
FROM (
  SELECT *, CASE WHEN (x + 7 * a) % (2 + a % 9) = 0 OR (a % 8 = 3 AND x % 2 = 0) THEN 'FAILED'
                 WHEN x % 15 = 1 THEN 'refunded'
                 WHEN x % 15 = 2 THEN 'pending' ELSE 'Successful' END AS st
  FROM (SELECT *, l_orderkey + l_linenumber AS x, 3 * l_partkey // 4 AS a FROM lineitem))"""

# -------------------------------------------------------------- staging
CTES["stg_crm__accounts"] = f"""
SELECT account_id, account_name, {clean('industry')} AS industry,
  {clean('country')} AS country, {clean('account_status')} AS account_status,
  {clean('tier')} AS tier, CAST(employee_count AS BIGINT) AS employee_count,
  CAST(created_at AS TIMESTAMP) AS created_at,
  {b(clean('account_status') + " = 'churned'")} AS is_churned,
  CASE {clean('tier')} WHEN 'enterprise' THEN 3 WHEN 'growth' THEN 2 WHEN 'starter' THEN 1
       ELSE 0 END AS tier_rank
FROM raw_accounts"""

CTES["stg_crm__contacts"] = f"""
SELECT contact_id, account_id, full_name, {clean('email')} AS email,
  {clean('job_title')} AS job_title, phone, CAST(created_at AS TIMESTAMP) AS created_at,
  account_id IS NULL AS is_orphaned,
  {b(clean('job_title') + " IN ('ceo', 'cto', 'cfo', 'vp of sales', 'head of operations', 'sales director')")}
    AS is_decision_maker
FROM raw_contacts"""

CTES["stg_crm__leads"] = f"""
SELECT lead_id, contact_id, campaign_id, {clean('lead_source')} AS lead_source,
  {clean('status')} AS lead_status, assigned_rep,
  CAST(created_at AS TIMESTAMP) AS created_at, CAST(converted_at AS TIMESTAMP) AS converted_at,
  {b(clean('status') + " = 'converted' AND converted_at IS NULL")} AS is_conversion_date_missing,
  {b(clean('status') + " = 'converted'")} AS is_converted,
  datesub('day', CAST(created_at AS TIMESTAMP), CAST(converted_at AS TIMESTAMP))
    AS days_to_convert
FROM raw_leads"""

CTES["stg_crm__opportunities"] = f"""
SELECT opportunity_id, account_id, lead_id, {clean('stage')} AS stage,
  {clean('currency')} AS currency, CAST(amount AS {M}) AS amount,
  CAST(probability AS DOUBLE) AS probability, CAST(close_date AS DATE) AS close_date,
  CAST(created_at AS TIMESTAMP) AS created_at,
  {b(clean('stage') + " IN ('closed won', 'closed lost') AND close_date IS NULL")}
    AS is_close_date_missing,
  {b(clean('stage') + " = 'closed won'")} AS is_won,
  {b(clean('stage') + " = 'closed lost'")} AS is_lost,
  {b(clean('stage') + " NOT IN ('closed won', 'closed lost')")} AS is_open,
  round(CAST(amount AS DOUBLE) * CAST(probability AS DOUBLE) / 100, 2) AS weighted_amount
FROM raw_opportunities"""

CTES["stg_crm__campaigns"] = f"""
SELECT campaign_id, campaign_name, {clean('campaign_type')} AS campaign_type,
  {clean('status')} AS campaign_status, {clean('channel')} AS channel, owner,
  {clean('campaign_variant')} AS campaign_variant,
  CAST(budget AS {M}) AS budget, CAST(actual_spend AS {M}) AS actual_spend,
  CAST(target_leads AS BIGINT) AS target_leads,
  CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date,
  actual_spend IS NULL AS is_spend_missing,
  CASE WHEN actual_spend IS NOT NULL AND budget > 0
       THEN {rdiv('actual_spend', 'budget', 100)} END AS budget_utilisation_pct,
  {b('CAST(end_date AS DATE) < ' + AS_OF)} AS is_completed
FROM raw_campaigns"""

CTES["stg_crm__activities"] = f"""
SELECT activity_id, contact_id, opportunity_id, account_id,
  {clean('activity_type')} AS activity_type, {clean('outcome')} AS outcome,
  assigned_rep, notes, CAST(duration_minutes AS BIGINT) AS duration_minutes,
  CAST(activity_date AS DATE) AS activity_date, CAST(created_at AS TIMESTAMP) AS created_at,
  activity_date IS NULL AS is_date_missing,
  {b(clean('outcome') + " IN ('meeting booked', 'interested', 'sent', 'opened')")}
    AS is_positive_outcome,
  {b(clean('activity_type') + " IN ('call', 'meeting', 'demo')")} AS is_high_touch
FROM raw_activities"""

CTES["stg_crm__support_tickets"] = f"""
SELECT ticket_id, account_id, contact_id, {clean('category')} AS category,
  {clean('priority')} AS priority, {clean('status')} AS ticket_status, agent,
  CAST(csat_score AS BIGINT) AS csat_score,
  CAST(first_response_hours AS DOUBLE) AS first_response_hours,
  CAST(created_at AS TIMESTAMP) AS created_at, CAST(resolved_at AS TIMESTAMP) AS resolved_at,
  {b(clean('status') + " IN ('resolved', 'closed') AND csat_score IS NULL")} AS is_csat_missing,
  {b('csat_score <= 2')} AS is_low_csat,
  {b(clean('priority') + " IN ('high', 'critical')")} AS is_high_priority,
  datesub('hour', CAST(created_at AS TIMESTAMP), CAST(resolved_at AS TIMESTAMP))
    AS resolution_hours
FROM raw_support_tickets"""

CTES["stg_erp__products"] = f"""
SELECT product_id, product_name, {clean('category')} AS category,
  {clean('billing_type')} AS billing_type, CAST(unit_price AS {M}) AS unit_price,
  {b(clean('billing_type') + " = 'subscription'")} AS is_recurring,
  CASE WHEN unit_price >= 5000 THEN 'enterprise' WHEN unit_price >= 500 THEN 'mid-market'
       ELSE 'smb' END AS price_tier
FROM raw_products"""

CTES["stg_erp__orders"] = f"""
SELECT order_id, account_id, product_id, opportunity_id,
  {clean('order_status')} AS order_status, CAST(quantity AS BIGINT) AS quantity,
  CAST(unit_price AS {M}) AS unit_price, CAST(total_amount AS {M}) AS total_amount,
  CAST(order_date AS DATE) AS order_date,
  {b('unit_price < 0')} AS is_refund,
  {b(clean('order_status') + " = 'completed'")} AS is_completed,
  {b(clean('order_status') + " = 'cancelled'")} AS is_cancelled,
  CASE WHEN {clean('order_status')} = 'completed' AND unit_price > 0
       THEN CAST(total_amount AS {M}) ELSE CAST(0 AS {M}) END AS recognised_revenue
FROM raw_orders"""

CTES["stg_erp__invoices"] = f"""
SELECT invoice_id, subscription_id, account_id,
  CAST(amount_due AS {M}) AS amount_due, CAST(amount_paid AS {M}) AS amount_paid,
  CAST(due_date AS DATE) AS due_date, CAST(paid_date AS DATE) AS paid_date,
  {clean('payment_status')} AS payment_status,
  {b(clean('payment_status') + " IN ('overdue', 'unpaid') AND amount_paid IS NULL")}
    AS is_payment_null,
  {b(clean('payment_status') + " = 'paid'")} AS is_paid,
  {b(clean('payment_status') + " = 'overdue'")} AS is_overdue,
  CASE WHEN amount_paid IS NOT NULL
       THEN CAST(round(CAST(amount_due AS {M}) - CAST(amount_paid AS {M}), 2) AS {M})
       ELSE CAST(amount_due AS {M}) END AS outstanding_amount,
  CASE WHEN {clean('payment_status')} = 'overdue'
       THEN date_diff('day', CAST(due_date AS DATE), {AS_OF}) ELSE 0 END AS days_overdue
FROM raw_invoices"""

CTES["stg_erp__subscriptions"] = f"""
SELECT subscription_id, account_id, product_id, opportunity_id,
  {clean('status')} AS subscription_status, {clean('billing_cycle')} AS billing_cycle,
  CAST(mrr AS {M}) AS mrr, CAST(start_date AS DATE) AS start_date,
  CAST(end_date AS DATE) AS end_date,
  {b('end_date < start_date')} AS is_date_inverted,
  {b(clean('status') + " = 'active'")} AS is_active,
  {b(clean('status') + " = 'churned'")} AS is_churned,
  round(CAST(mrr AS {M}) * 12, 2) AS arr,
  CASE WHEN end_date >= start_date THEN date_diff('day', start_date, end_date) END
    AS subscription_duration_days
FROM raw_subscriptions"""

CTES["stg_erp__payments"] = f"""
SELECT payment_id, invoice_id, account_id, {clean('payment_method')} AS payment_method,
  {clean('payment_status')} AS payment_status, failure_reason, gateway_ref,
  CAST(amount AS {M}) AS amount, CAST(retry_count AS BIGINT) AS retry_count,
  CAST(payment_date AS DATE) AS payment_date, CAST(created_at AS TIMESTAMP) AS created_at,
  {b(clean('payment_status') + " = 'successful' AND payment_date IS NULL")}
    AS is_payment_date_missing,
  {b(clean('payment_status') + " = 'successful'")} AS is_successful,
  {b(clean('payment_status') + " = 'failed'")} AS is_failed,
  {b('retry_count >= 2')} AS is_repeat_failure
FROM raw_payments"""

CTES["stg_web__web_events"] = f"""
SELECT event_id, contact_id, {clean('event_type')} AS event_type, page_url, session_id,
  {clean('utm_source')} AS utm_source, {clean('utm_campaign')} AS utm_campaign,
  CAST(event_timestamp AS TIMESTAMP) AS event_timestamp,
  CAST(event_timestamp AS DATE) AS event_date,
  CAST(hour(event_timestamp) AS BIGINT) AS event_hour,
  strftime(event_timestamp, '%Y-%m') AS event_month,
  {b(clean('event_type') + " = 'page_view'")} AS is_page_view,
  {b(clean('event_type') + " IN ('demo_request', 'form_submit')")} AS is_conversion_event,
  {b(clean('page_url') + " = '/pricing'")} AS is_pricing_page
FROM raw_web_events"""

CTES["stg_web__feature_usage"] = f"""
SELECT usage_id, account_id, contact_id, {clean('feature_name')} AS feature_name,
  {clean('device_type')} AS device_type, CAST(usage_count AS BIGINT) AS usage_count,
  CAST(session_duration_seconds AS BIGINT) AS session_duration_seconds,
  CAST(usage_date AS DATE) AS usage_date, CAST(created_at AS TIMESTAMP) AS created_at,
  usage_date IS NULL AS is_date_missing,
  {b('usage_count = 0')} AS is_zero_usage,
  CASE WHEN usage_count >= 100 THEN 'power' WHEN usage_count >= 20 THEN 'regular'
       WHEN usage_count >= 1 THEN 'light' ELSE 'inactive' END AS engagement_level,
  round(session_duration_seconds / 60, 2) AS session_duration_minutes
FROM raw_feature_usage"""

# --------------------------------------------------------- intermediate
CTES["int_accounts_with_subscriptions"] = f"""
SELECT a.account_id, a.account_name, a.industry, a.country, a.account_status, a.tier,
  a.tier_rank, a.is_churned, a.created_at,
  coalesce(s.n, 0) AS total_subscriptions, coalesce(s.n_active, 0) AS active_subscriptions,
  coalesce(s.n_churned, 0) AS churned_subscriptions,
  coalesce(s.mrr, 0) AS total_mrr, coalesce(s.arr, 0) AS total_arr,
  s.latest AS latest_subscription_start, s.earliest AS earliest_subscription_start,
  coalesce(s.avg_days, 0) AS avg_subscription_duration_days,
  coalesce(i.n, 0) AS total_invoices, coalesce(i.n_paid, 0) AS paid_invoices,
  coalesce(i.n_overdue, 0) AS overdue_invoices,
  coalesce(i.billed, 0) AS total_billed, coalesce(i.collected, 0) AS total_collected,
  coalesce(i.outstanding, 0) AS total_outstanding,
  coalesce(i.max_overdue, 0) AS max_days_overdue,
  coalesce(p.n, 0) AS total_payments, coalesce(p.n_ok, 0) AS successful_payments,
  coalesce(p.n_failed, 0) AS failed_payments, coalesce(p.n_repeat, 0) AS repeat_failures,
  coalesce(p.ok_amount, 0) AS total_payment_amount,
  CASE WHEN coalesce(i.billed, 0) > 0 THEN {rdiv('coalesce(i.collected, 0)', 'i.billed', 100)}
       ELSE 0 END AS collection_rate_pct,
  CASE WHEN coalesce(p.n, 0) > 0 THEN round(coalesce(p.n_failed, 0) / p.n * 100, 2)
       ELSE 0 END AS payment_failure_rate_pct
FROM stg_crm__accounts a
LEFT JOIN (
  SELECT account_id, count(subscription_id) AS n, count(CASE WHEN is_active THEN 1 END) AS n_active,
    count(CASE WHEN is_churned THEN 1 END) AS n_churned, round(sum(mrr), 2) AS mrr, round(sum(arr), 2) AS arr,
    max(start_date) AS latest, min(start_date) AS earliest,
    avg(subscription_duration_days) AS avg_days
  FROM stg_erp__subscriptions WHERE NOT is_date_inverted AND account_id IS NOT NULL
  GROUP BY account_id) s ON a.account_id = s.account_id
LEFT JOIN (
  SELECT account_id, count(invoice_id) AS n, count(CASE WHEN is_paid THEN 1 END) AS n_paid,
    count(CASE WHEN is_overdue THEN 1 END) AS n_overdue, round(sum(amount_due), 2) AS billed,
    round(sum(coalesce(amount_paid, 0)), 2) AS collected,
    round(sum(outstanding_amount), 2) AS outstanding, max(days_overdue) AS max_overdue
  FROM stg_erp__invoices WHERE account_id IS NOT NULL GROUP BY account_id) i
  ON a.account_id = i.account_id
LEFT JOIN (
  SELECT account_id, count(payment_id) AS n, count(CASE WHEN is_successful THEN 1 END) AS n_ok,
    count(CASE WHEN is_failed THEN 1 END) AS n_failed, count(CASE WHEN is_repeat_failure THEN 1 END) AS n_repeat,
    round(sum(CASE WHEN is_successful THEN amount ELSE 0 END), 2) AS ok_amount
  FROM stg_erp__payments WHERE account_id IS NOT NULL GROUP BY account_id) p
  ON a.account_id = p.account_id"""

CTES["int_payment_health"] = f"""
SELECT ph.*, lf.failure_reason AS most_recent_failure_reason,
  inv.total_invoices, inv.overdue_invoices, round(inv.billed, 2) AS total_billed,
  round(inv.outstanding, 2) AS total_outstanding, inv.max_days_overdue,
  round(100 - least(CAST(ph.failed_payments AS {M}) * 5, 30)
            - least(CAST(ph.consecutive_failure_count AS {M}) * 10, 30)
            - CASE WHEN inv.overdue_invoices IS NULL THEN NULL
                   ELSE least(CAST(inv.overdue_invoices AS {M}) * 3, 20) END
            - CASE WHEN inv.max_days_overdue IS NULL THEN NULL
                   ELSE least(CAST(inv.max_days_overdue AS {M}) * 0.5, 20) END, 2)
    AS payment_health_score,
  CASE WHEN ph.consecutive_failure_count >= 3 THEN 'critical'
       WHEN ph.failed_payments >= 5 THEN 'poor'
       WHEN ph.failed_payments >= 2 THEN 'at_risk' ELSE 'healthy' END AS payment_health_band
FROM (
  SELECT account_id, count(payment_id) AS total_payments,
    count(CASE WHEN is_successful THEN 1 END) AS successful_payments, count(CASE WHEN is_failed THEN 1 END) AS failed_payments,
    count(CASE WHEN is_repeat_failure THEN 1 END) AS repeat_failures,
    CAST(max(running_failures) AS BIGINT) AS total_cumulative_failures,
    round(sum(CASE WHEN is_successful THEN amount ELSE 0 END), 2) AS total_collected,
    {ravg('CASE WHEN is_successful THEN amount END')} AS avg_payment_amount,
    max(payment_date) AS latest_payment_date, min(payment_date) AS first_payment_date,
    count(CASE WHEN is_failed AND prev_failed THEN 1 END) AS consecutive_failure_count
  FROM (
    SELECT *,
      sum(CASE WHEN is_failed THEN 1 ELSE 0 END) OVER (
        PARTITION BY account_id ORDER BY created_at, payment_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_failures,
      lag(is_failed) OVER (PARTITION BY account_id ORDER BY created_at, payment_id)
        AS prev_failed
    FROM stg_erp__payments WHERE account_id IS NOT NULL)
  GROUP BY account_id) ph
LEFT JOIN (
  SELECT account_id, failure_reason FROM stg_erp__payments
  WHERE account_id IS NOT NULL AND is_failed
  QUALIFY row_number() OVER (PARTITION BY account_id
                             ORDER BY created_at DESC, payment_id DESC) = 1) lf
  ON ph.account_id = lf.account_id
LEFT JOIN (
  SELECT account_id, count(invoice_id) AS total_invoices, count(CASE WHEN is_overdue THEN 1 END) AS overdue_invoices,
    sum(amount_due) AS billed, sum(outstanding_amount) AS outstanding,
    max(days_overdue) AS max_days_overdue
  FROM stg_erp__invoices WHERE account_id IS NOT NULL GROUP BY account_id) inv
  ON ph.account_id = inv.account_id"""

CTES["int_customer_health"] = f"""
SELECT *,
  CASE WHEN churn_risk_score >= 60 THEN 'critical' WHEN churn_risk_score >= 40 THEN 'high'
       WHEN churn_risk_score >= 20 THEN 'medium' ELSE 'low' END AS churn_risk_band
FROM (
SELECT a.account_id, a.account_name, a.industry, a.tier, a.tier_rank, a.account_status,
  a.is_churned, round(s.total_mrr, 2) AS total_mrr, round(s.total_arr, 2) AS total_arr,
  s.active_subscriptions, s.collection_rate_pct, s.payment_failure_rate_pct,
  s.overdue_invoices, s.repeat_failures,
  coalesce(t.n, 0) AS total_tickets, coalesce(t.n_high, 0) AS high_priority_tickets,
  coalesce(t.n_low_csat, 0) AS low_csat_tickets, coalesce(t.n_esc, 0) AS escalated_tickets,
  coalesce(t.n_open, 0) AS open_tickets, t.avg_csat AS avg_csat_score,
  t.avg_res AS avg_resolution_hours, t.latest AS latest_ticket_date,
  coalesce(u.n_features, 0) AS distinct_features_used,
  CAST(coalesce(u.usage, 0) AS BIGINT) AS total_usage_count,
  coalesce(u.n_power, 0) AS power_usage_days, coalesce(u.n_inactive, 0) AS inactive_days,
  u.latest AS latest_usage_date, u.avg_minutes AS avg_session_duration_minutes,
  CAST(round(
      least(CAST(s.payment_failure_rate_pct AS DECIMAL(18,2)) * 0.5, 15)
    + least(coalesce(s.overdue_invoices, 0) * 2, 10)
    + least(coalesce(s.repeat_failures, 0) * 5, 10)
    + least(coalesce(t.n_low_csat, 0) * 3, 15)
    + least(coalesce(t.n_high, 0) * 2, 10)
    + least(coalesce(t.n_esc, 0) * 5, 10)
    + CASE WHEN coalesce(u.usage, 0) = 0 THEN 30 WHEN coalesce(u.usage, 0) < 10 THEN 20
           WHEN coalesce(u.usage, 0) < 50 THEN 10 ELSE 0 END, 2) AS DOUBLE) AS churn_risk_score
FROM stg_crm__accounts a
LEFT JOIN int_accounts_with_subscriptions s ON a.account_id = s.account_id
LEFT JOIN (
  SELECT account_id, count(ticket_id) AS n, count(CASE WHEN is_high_priority THEN 1 END) AS n_high,
    count(CASE WHEN is_low_csat THEN 1 END) AS n_low_csat, count(CASE WHEN ticket_status = 'escalated' THEN 1 END) AS n_esc,
    count(CASE WHEN ticket_status = 'open' THEN 1 END) AS n_open, avg(csat_score) AS avg_csat,
    avg(resolution_hours) AS avg_res, max(created_at) AS latest
  FROM stg_crm__support_tickets WHERE account_id IS NOT NULL GROUP BY account_id) t
  ON a.account_id = t.account_id
LEFT JOIN (
  SELECT account_id, count(DISTINCT feature_name) AS n_features, sum(usage_count) AS usage,
    count(CASE WHEN engagement_level = 'power' THEN 1 END) AS n_power,
    count(CASE WHEN engagement_level = 'inactive' THEN 1 END) AS n_inactive,
    max(usage_date) AS latest, avg(session_duration_minutes) AS avg_minutes
  FROM stg_web__feature_usage WHERE account_id IS NOT NULL AND NOT is_date_missing
  GROUP BY account_id) u ON a.account_id = u.account_id)"""

CTES["int_sales_activity"] = f"""
SELECT o.opportunity_id, o.account_id, o.stage, round(o.amount, 2) AS amount,
  round(CAST(o.weighted_amount AS {M}), 2) AS weighted_amount, o.probability,
  o.is_won, o.is_lost, o.is_open, o.close_date, o.created_at AS opportunity_created_at,
  a.account_name, a.tier, a.tier_rank,
  coalesce(oa.total_activities, 0) AS total_activities,
  coalesce(oa.high_touch_activities, 0) AS high_touch_activities,
  coalesce(oa.positive_outcomes, 0) AS positive_outcomes,
  coalesce(oa.total_calls, 0) AS total_calls, coalesce(oa.total_meetings, 0) AS total_meetings,
  coalesce(oa.total_demos, 0) AS total_demos, coalesce(oa.total_emails, 0) AS total_emails,
  coalesce(oa.reps_involved, 0) AS reps_involved,
  oa.avg_activity_duration, oa.positive_outcome_rate, oa.latest_activity_date,
  oa.first_activity_date,
  coalesce(aa.n, 0) AS total_account_activities,
  coalesce(aa.n_high, 0) AS account_high_touch_count,
  aa.latest AS latest_account_activity_date, coalesce(aa.n_reps, 0) AS total_reps_engaged,
  date_diff('day', oa.latest_activity_date, {AS_OF}) AS days_since_last_activity,
  CASE WHEN coalesce(oa.total_activities, 0) = 0 THEN 'no_engagement'
       WHEN coalesce(oa.high_touch_activities, 0) >= 5 THEN 'high'
       WHEN coalesce(oa.high_touch_activities, 0) >= 2 THEN 'medium' ELSE 'low' END
    AS engagement_quality
FROM stg_crm__opportunities o
LEFT JOIN (
  SELECT account_id, count(activity_id) AS n, count(CASE WHEN is_high_touch THEN 1 END) AS n_high,
    max(activity_date) AS latest, count(DISTINCT assigned_rep) AS n_reps
  FROM stg_crm__activities WHERE NOT is_date_missing AND account_id IS NOT NULL
  GROUP BY account_id) aa ON o.account_id = aa.account_id
LEFT JOIN (
  SELECT opportunity_id, account_id AS activity_account_id,
    count(activity_id) AS total_activities, count(CASE WHEN is_high_touch THEN 1 END) AS high_touch_activities,
    count(CASE WHEN is_positive_outcome THEN 1 END) AS positive_outcomes,
    count(CASE WHEN activity_type = 'call' THEN 1 END) AS total_calls,
    count(CASE WHEN activity_type = 'meeting' THEN 1 END) AS total_meetings,
    count(CASE WHEN activity_type = 'demo' THEN 1 END) AS total_demos,
    count(CASE WHEN activity_type = 'email' THEN 1 END) AS total_emails,
    count(DISTINCT assigned_rep) AS reps_involved,
    avg(duration_minutes) AS avg_activity_duration,
    max(activity_date) AS latest_activity_date, min(activity_date) AS first_activity_date,
    round(count(CASE WHEN is_positive_outcome THEN 1 END) / nullif(count(activity_id), 0) * 100, 2)
      AS positive_outcome_rate
  FROM stg_crm__activities
  WHERE NOT is_date_missing AND account_id IS NOT NULL AND opportunity_id IS NOT NULL
  GROUP BY opportunity_id, account_id) oa ON o.opportunity_id = oa.opportunity_id
LEFT JOIN stg_crm__accounts a ON o.account_id = a.account_id
QUALIFY row_number() OVER (PARTITION BY o.opportunity_id
  ORDER BY o.created_at NULLS FIRST, o.account_id NULLS FIRST, o.stage NULLS FIRST,
           o.amount NULLS FIRST, oa.latest_activity_date DESC NULLS LAST,
           oa.activity_account_id DESC NULLS LAST, a.account_name NULLS FIRST,
           a.tier NULLS FIRST) = 1"""

CTES["int_leads_with_campaigns"] = f"""
SELECT l.lead_id, l.contact_id, l.campaign_id, l.lead_source, l.lead_status, l.assigned_rep,
  l.created_at AS lead_created_at, l.converted_at, l.is_converted,
  l.is_conversion_date_missing, l.days_to_convert,
  c.campaign_name, c.campaign_type, c.campaign_status, c.channel, c.campaign_variant,
  round(c.budget, 2) AS budget, round(c.actual_spend, 2) AS actual_spend,
  c.budget_utilisation_pct, c.is_spend_missing,
  ct.account_id, ct.is_decision_maker,
  o.opportunity_id, o.stage AS opportunity_stage, round(o.amount, 2) AS opportunity_amount,
  round(CAST(o.weighted_amount AS {M}), 2) AS weighted_amount,
  o.is_won, o.is_lost, o.is_open, o.close_date, o.probability,
  CASE WHEN l.campaign_id IS NOT NULL THEN 'campaign' ELSE 'organic' END AS attribution_type,
  CASE WHEN o.is_won THEN 'closed_won' WHEN o.is_lost THEN 'closed_lost'
       WHEN l.is_converted THEN 'in_pipeline' ELSE 'not_converted' END AS lead_outcome
FROM stg_crm__leads l
LEFT JOIN stg_crm__campaigns c ON l.campaign_id = c.campaign_id
LEFT JOIN (SELECT contact_id, account_id, is_decision_maker FROM stg_crm__contacts
           WHERE NOT is_orphaned) ct ON l.contact_id = ct.contact_id
LEFT JOIN (
  SELECT * FROM stg_crm__opportunities
  QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY
    CASE stage WHEN 'closed won' THEN 1 WHEN 'negotiation' THEN 2 WHEN 'proposal' THEN 3
               WHEN 'qualification' THEN 4 WHEN 'prospecting' THEN 5 WHEN 'closed lost' THEN 6
               ELSE 7 END,
    amount DESC NULLS LAST, opportunity_id) = 1) o ON l.lead_id = o.lead_id"""

# ---------------------------------------------------------------- marts
CTES["mart_customer_churn"] = f"""
SELECT ch.account_id, ch.account_name, ch.industry, ch.tier, ch.tier_rank, ch.account_status,
  ch.is_churned, ch.total_mrr, ch.total_arr, ch.active_subscriptions,
  s.total_subscriptions, s.churned_subscriptions, s.earliest_subscription_start,
  s.latest_subscription_start, s.avg_subscription_duration_days,
  ch.collection_rate_pct, ch.payment_failure_rate_pct, ch.overdue_invoices, ch.repeat_failures,
  s.total_billed, s.total_collected, s.total_outstanding, s.max_days_overdue,
  ph.payment_health_score, ph.payment_health_band, ph.consecutive_failure_count,
  ph.total_cumulative_failures, ph.most_recent_failure_reason, ph.latest_payment_date,
  ph.total_payments, ph.successful_payments, ph.failed_payments,
  ch.total_tickets, ch.high_priority_tickets, ch.low_csat_tickets, ch.escalated_tickets,
  ch.open_tickets, ch.avg_csat_score, ch.avg_resolution_hours, ch.latest_ticket_date,
  ch.distinct_features_used, ch.total_usage_count, ch.power_usage_days, ch.inactive_days,
  ch.latest_usage_date, ch.avg_session_duration_minutes,
  ch.churn_risk_score, ch.churn_risk_band,
  date_diff('day', CAST(ch.latest_ticket_date AS DATE), {AS_OF}) AS days_since_last_ticket,
  date_diff('day', CAST(ch.latest_usage_date AS DATE), {AS_OF}) AS days_since_last_usage,
  date_diff('day', CAST(ph.latest_payment_date AS DATE), {AS_OF}) AS days_since_last_payment,
  CASE ch.churn_risk_band WHEN 'critical' THEN ch.total_mrr
       WHEN 'high' THEN round(ch.total_mrr * 0.75, 2)
       WHEN 'medium' THEN round(ch.total_mrr * 0.40, 2) ELSE 0 END AS mrr_at_risk,
  CASE ch.churn_risk_band WHEN 'critical' THEN ch.total_arr
       WHEN 'high' THEN round(ch.total_arr * 0.75, 2)
       WHEN 'medium' THEN round(ch.total_arr * 0.40, 2) ELSE 0 END AS arr_at_risk,
  CASE ch.churn_risk_band
       WHEN 'critical' THEN 'Immediate intervention — assign CSM, escalate to leadership'
       WHEN 'high' THEN 'Urgent outreach — schedule executive business review'
       WHEN 'medium' THEN 'Proactive check-in — review feature adoption and resolve tickets'
       ELSE 'Monitor — maintain regular cadence' END AS recommended_action,
  {RUN_TS} AS mart_updated_at
FROM int_customer_health ch
LEFT JOIN int_payment_health ph ON ch.account_id = ph.account_id
LEFT JOIN int_accounts_with_subscriptions s ON ch.account_id = s.account_id"""

CTES["mart_revenue"] = f"""
SELECT mr.account_id, mr.account_name, mr.industry, mr.country, mr.tier, mr.tier_rank,
  mr.account_status, mr.is_churned, mr.created_at, mr.total_subscriptions,
  mr.active_subscriptions, mr.churned_subscriptions, mr.total_mrr, mr.total_arr,
  mr.earliest_subscription_start, mr.latest_subscription_start,
  mr.avg_subscription_duration_days, mr.total_invoices, mr.paid_invoices,
  mr.overdue_invoices, mr.total_billed, mr.total_collected, mr.total_outstanding,
  mr.max_days_overdue, mr.collection_rate_pct, mr.payment_failure_rate_pct,
  mr.total_payments, mr.successful_payments, mr.failed_payments, mr.repeat_failures,
  mr.total_payment_amount,
  ph.payment_health_score, ph.payment_health_band, ph.consecutive_failure_count,
  ph.total_cumulative_failures, ph.most_recent_failure_reason, ph.latest_payment_date,
  ph.first_payment_date, ph.avg_payment_amount,
  CASE WHEN mr.active_subscriptions = 0 THEN 'no_revenue'
       WHEN mr.collection_rate_pct >= 90 AND ph.payment_health_band = 'healthy' THEN 'healthy'
       WHEN mr.collection_rate_pct >= 70
            AND ph.payment_health_band IN ('healthy', 'at_risk') THEN 'stable'
       WHEN mr.collection_rate_pct >= 50 OR ph.payment_health_band = 'at_risk' THEN 'at_risk'
       ELSE 'critical' END AS revenue_health_band,
  CASE WHEN mr.collection_rate_pct < 50 THEN mr.total_arr
       WHEN mr.collection_rate_pct < 70 THEN round(mr.total_arr * 0.50, 2)
       WHEN mr.collection_rate_pct < 90 THEN round(mr.total_arr * 0.20, 2)
       ELSE 0 END AS arr_at_risk,
  round(mr.total_collected - mr.total_outstanding, 2) AS net_revenue,
  CASE WHEN mr.total_billed > 0 THEN {rdiv('mr.total_outstanding', 'mr.total_billed', 100)}
       ELSE 0 END AS outstanding_pct,
  CASE WHEN mr.avg_subscription_duration_days > 0
       THEN {round_double('CAST(mr.total_mrr AS DOUBLE) * (mr.avg_subscription_duration_days / 30.0)')}
       ELSE 0 END AS estimated_clv,
  date_diff('day', mr.earliest_subscription_start, {AS_OF}) AS customer_tenure_days,
  date_diff('day', mr.latest_subscription_start, {AS_OF}) AS days_since_latest_subscription,
  {b('mr.total_subscriptions > 1 AND mr.earliest_subscription_start != mr.latest_subscription_start')}
    AS has_expanded,
  {b('mr.churned_subscriptions > 0 AND mr.active_subscriptions > 0')} AS has_contracted,
  {RUN_TS} AS mart_updated_at
FROM int_accounts_with_subscriptions mr
LEFT JOIN int_payment_health ph ON mr.account_id = ph.account_id"""

CTES["mart_sales_funnel"] = f"""
SELECT acc.account_name, acc.tier, acc.tier_rank, acc.industry,
  ls.lead_id, ls.contact_id, ls.account_id, ls.campaign_id, ls.campaign_name,
  ls.campaign_type, ls.channel, ls.lead_source, ls.lead_status, ls.assigned_rep,
  ls.attribution_type, ls.lead_outcome, ls.lead_created_at, ls.converted_at, ls.is_converted,
  ls.days_to_convert, ls.is_decision_maker, ls.budget, ls.actual_spend,
  ls.budget_utilisation_pct, ls.opportunity_id, ls.opportunity_stage, ls.opportunity_amount,
  ls.weighted_amount, ls.is_won, ls.is_lost, ls.is_open, ls.close_date, ls.probability,
  CASE WHEN ls.is_won THEN '4_closed_won' WHEN ls.is_lost THEN '4_closed_lost'
       WHEN ls.is_open THEN '3_in_pipeline' WHEN ls.is_converted THEN '2_converted'
       ELSE '1_lead' END AS funnel_stage,
  coalesce(oa.total_activities, 0) AS total_activities,
  coalesce(oa.high_touch_activities, 0) AS high_touch_activities,
  coalesce(oa.positive_outcomes, 0) AS positive_outcomes,
  coalesce(oa.total_calls, 0) AS total_calls, coalesce(oa.total_meetings, 0) AS total_meetings,
  coalesce(oa.total_demos, 0) AS total_demos, coalesce(oa.total_emails, 0) AS total_emails,
  coalesce(oa.reps_involved, 0) AS reps_involved,
  oa.avg_activity_duration, oa.positive_outcome_rate, oa.engagement_quality,
  oa.days_since_last_activity, oa.latest_activity_date, oa.first_activity_date,
  CASE WHEN ls.is_won AND ls.close_date IS NOT NULL
        AND date_diff('day', CAST(ls.lead_created_at AS DATE), ls.close_date) >= 0
       THEN date_diff('day', CAST(ls.lead_created_at AS DATE), ls.close_date) END
    AS days_lead_to_close,
  CASE WHEN ls.is_won AND ls.converted_at IS NOT NULL AND ls.close_date IS NOT NULL
        AND date_diff('day', CAST(ls.converted_at AS DATE), ls.close_date) >= 0
       THEN date_diff('day', CAST(ls.converted_at AS DATE), ls.close_date) END
    AS days_convert_to_close,
  CASE WHEN ls.actual_spend > 0 THEN round(ls.actual_spend, 2) END AS campaign_spend,
  CASE WHEN ls.actual_spend > 0 AND ls.is_won
       THEN {rdiv('ls.opportunity_amount', 'ls.actual_spend')} END AS revenue_per_spend,
  {RUN_TS} AS mart_updated_at
FROM int_leads_with_campaigns ls
LEFT JOIN int_sales_activity oa ON ls.opportunity_id = oa.opportunity_id
LEFT JOIN stg_crm__accounts acc ON ls.account_id = acc.account_id"""

# Decimal columns each model returns (cast to DOUBLE in compared output).
MONEY_COLUMNS = {
    "stg_crm__opportunities": ["amount"],
    "stg_crm__campaigns": ["budget", "actual_spend"],
    "stg_erp__products": ["unit_price"],
    "stg_erp__orders": ["unit_price", "total_amount", "recognised_revenue"],
    "stg_erp__invoices": ["amount_due", "amount_paid", "outstanding_amount"],
    "stg_erp__subscriptions": ["mrr", "arr"],
    "stg_erp__payments": ["amount"],
    "int_accounts_with_subscriptions": ["total_mrr", "total_arr", "total_billed",
                                        "total_collected", "total_outstanding",
                                        "total_payment_amount"],
    "int_payment_health": ["total_collected", "total_billed", "total_outstanding",
                           "payment_health_score"],
    "int_customer_health": ["total_mrr", "total_arr"],
    "int_sales_activity": ["amount", "weighted_amount"],
    "int_leads_with_campaigns": ["budget", "actual_spend", "opportunity_amount",
                                 "weighted_amount"],
    "mart_customer_churn": ["total_mrr", "total_arr", "total_billed", "total_collected",
                            "total_outstanding", "payment_health_score", "mrr_at_risk",
                            "arr_at_risk"],
    "mart_revenue": ["total_mrr", "total_arr", "total_billed", "total_collected",
                     "total_outstanding", "total_payment_amount", "payment_health_score",
                     "arr_at_risk", "net_revenue"],
    "mart_sales_funnel": ["budget", "actual_spend", "opportunity_amount", "weighted_amount",
                          "campaign_spend"],
}

# Extra statements that read the marts (queries, rollups, checks) are
# registered here by name -> SELECT over the CTE names above.
FINAL: dict[str, str] = {}


def _deps(body: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", body)]


def _ordered(body: str) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        for d in _deps(CTES[n]):
            if d != n and d not in seen:
                visit(d)
        if n not in seen:
            seen.append(n)

    for n in _deps(body):
        visit(n)
    return seen


def with_ctes(body: str) -> str:
    names = _ordered(body)
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in names) + "\n" + body


def model_select(name: str) -> str:
    cols = MONEY_COLUMNS.get(name, [])
    if cols:
        repl = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
        return f"SELECT * REPLACE ({repl}) FROM {name}"
    return f"SELECT * FROM {name}"


def sql_for(name: str) -> str:
    body = FINAL[name] if name in FINAL else model_select(name)
    return with_ctes(body)


MODEL_NAMES = [n for n in CTES if not n.startswith("raw_")]
