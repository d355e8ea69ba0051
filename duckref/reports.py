"""DuckDB SQL for the curated queries, dashboard rollups and check suite.

Each statement reads the oracle's own mart CTEs (see ``duckref.duck``).
Decimal results are cast to DOUBLE, as on the Spark side; ratios of
money are rounded exactly with ``rdiv`` and averages of 2-decimal values
with ``ravg``. Top-k lists order like the Spark side: the sort column
with NULLs last on DESC (first on ASC), then the key.
"""

from __future__ import annotations

from duckref.duck import CTES, FINAL, ravg, rdiv, sql_for  # noqa: F401  (sql_for re-exported)

D = "AS DOUBLE)"

# Parameters of the registered curated queries.
LOOKUP_ACCOUNT = "A7"
RISK_BAND = "high"
HEALTH_BAND = "at_risk"
LEAD_OUTCOME = "closed_won"
ATTRIBUTION = "campaign"
ROW_LIMIT = 20

REPORTS: dict[str, str] = {}

# ------------------------------------------------------------ curated
REPORTS["q1_get_account_churn_risk"] = f"""
SELECT account_id, account_name, tier, churn_risk_score, churn_risk_band, payment_health_band,
  CAST(mrr_at_risk {D} AS mrr_at_risk, CAST(arr_at_risk {D} AS arr_at_risk, recommended_action
FROM mart_customer_churn WHERE account_id = '{LOOKUP_ACCOUNT}'"""

REPORTS["q2_list_high_risk_accounts"] = f"""
SELECT account_id, account_name, tier, churn_risk_score, churn_risk_band,
  CAST(mrr_at_risk {D} AS mrr_at_risk, CAST(arr_at_risk {D} AS arr_at_risk, recommended_action
FROM mart_customer_churn WHERE churn_risk_band = '{RISK_BAND}'
ORDER BY mrr_at_risk DESC NULLS LAST, account_id LIMIT {ROW_LIMIT}"""

REPORTS["q3_get_account_revenue_health"] = f"""
SELECT account_id, account_name, tier, revenue_health_band,
  CAST(total_mrr {D} AS total_mrr, CAST(total_arr {D} AS total_arr,
  CAST(collection_rate_pct {D} AS collection_rate_pct,
  CAST(outstanding_pct {D} AS outstanding_pct, CAST(net_revenue {D} AS net_revenue,
  CAST(estimated_clv {D} AS estimated_clv
FROM mart_revenue WHERE account_id = '{LOOKUP_ACCOUNT}'"""

REPORTS["q4_list_accounts_by_revenue_health"] = f"""
SELECT account_id, account_name, tier, revenue_health_band,
  CAST(total_mrr {D} AS total_mrr, CAST(total_arr {D} AS total_arr,
  CAST(arr_at_risk {D} AS arr_at_risk, CAST(collection_rate_pct {D} AS collection_rate_pct
FROM mart_revenue WHERE revenue_health_band = '{HEALTH_BAND}'
ORDER BY arr_at_risk DESC NULLS LAST, account_id LIMIT {ROW_LIMIT}"""

REPORTS["q5_get_funnel_summary_by_stage"] = f"""
SELECT funnel_stage, count(*) AS lead_count,
  CAST(sum(opportunity_amount) {D} AS total_opportunity_amount,
  CAST(sum(weighted_amount) {D} AS total_weighted_amount
FROM mart_sales_funnel GROUP BY funnel_stage ORDER BY funnel_stage"""

REPORTS["q6_list_leads_by_outcome"] = f"""
SELECT lead_id, account_name, tier, lead_source, attribution_type, lead_outcome,
  CAST(opportunity_amount {D} AS opportunity_amount, CAST(weighted_amount {D} AS weighted_amount,
  days_lead_to_close
FROM mart_sales_funnel
WHERE lead_outcome = '{LEAD_OUTCOME}' AND ('{ATTRIBUTION}' = 'all' OR attribution_type = '{ATTRIBUTION}')
ORDER BY opportunity_amount DESC NULLS LAST, lead_id LIMIT {ROW_LIMIT}"""

REPORTS["q6_list_leads_by_outcome_any_attribution"] = f"""
SELECT lead_id, account_name, tier, lead_source, attribution_type, lead_outcome,
  CAST(opportunity_amount {D} AS opportunity_amount, CAST(weighted_amount {D} AS weighted_amount,
  days_lead_to_close
FROM mart_sales_funnel
WHERE lead_outcome = 'in_pipeline' AND ('all' = 'all' OR attribution_type = 'all')
ORDER BY opportunity_amount DESC NULLS LAST, lead_id LIMIT 200"""

REPORTS["q7_average_churn_risk_by_tier"] = f"""
SELECT tier, count(*) AS accounts, {ravg('churn_risk_score')} AS avg_churn_risk_score,
  CAST(sum(mrr_at_risk) {D} AS mrr_at_risk
FROM mart_customer_churn GROUP BY tier"""

# ------------------------------------------------------------ rollups
REPORTS["r1_churn_kpis"] = f"""
SELECT count(*) AS accounts, count(CASE WHEN churn_risk_band <> 'low' THEN 1 END)
    AS accounts_at_risk,
  CAST(sum(total_mrr) {D} AS total_mrr, CAST(sum(mrr_at_risk) {D} AS mrr_at_risk,
  CAST(sum(arr_at_risk) {D} AS arr_at_risk
FROM mart_customer_churn"""

REPORTS["r2_churn_by_band"] = f"""
SELECT churn_risk_band, count(*) AS accounts, CAST(sum(total_mrr) {D} AS total_mrr,
  CAST(sum(mrr_at_risk) {D} AS mrr_at_risk, CAST(sum(arr_at_risk) {D} AS arr_at_risk
FROM mart_customer_churn GROUP BY churn_risk_band"""

REPORTS["r3_highest_risk_accounts"] = f"""
SELECT account_id, account_name, tier, churn_risk_score, churn_risk_band,
  CAST(mrr_at_risk {D} AS mrr_at_risk, recommended_action
FROM mart_customer_churn
ORDER BY churn_risk_score DESC NULLS LAST, mrr_at_risk DESC NULLS LAST, account_id
LIMIT {ROW_LIMIT}"""

REPORTS["r3_risk_bubble"] = f"""
SELECT account_id, account_name, total_usage_count, churn_risk_score,
  CAST(total_mrr {D} AS total_mrr, churn_risk_band
FROM mart_customer_churn"""

REPORTS["r4_revenue_kpis"] = f"""
SELECT CAST(sum(total_mrr) {D} AS total_mrr, CAST(sum(total_arr) {D} AS total_arr,
  count(*) AS accounts,
  CASE WHEN sum(total_billed) > 0
       THEN {rdiv('sum(total_collected)', 'sum(total_billed)', 100)} END AS collection_rate_pct,
  CAST(sum(total_outstanding) {D} AS total_outstanding
FROM mart_revenue"""

REPORTS["r5_revenue_by_health_band"] = f"""
SELECT revenue_health_band, count(*) AS accounts, CAST(sum(total_arr) {D} AS total_arr,
  CAST(sum(arr_at_risk) {D} AS arr_at_risk
FROM mart_revenue GROUP BY revenue_health_band"""

REPORTS["r6_poor_collection_accounts"] = f"""
SELECT account_id, account_name, tier, CAST(collection_rate_pct {D} AS collection_rate_pct,
  CAST(total_billed {D} AS total_billed, CAST(total_outstanding {D} AS total_outstanding,
  revenue_health_band
FROM mart_revenue WHERE total_billed > 0
ORDER BY collection_rate_pct ASC NULLS FIRST, total_outstanding DESC NULLS LAST, account_id
LIMIT {ROW_LIMIT}"""

REPORTS["r7_funnel_kpis"] = f"""
SELECT l.leads, l.won_deals, CAST(l.won_revenue {D} AS won_revenue,
  l.avg_days_lead_to_close, CAST(s.total_spend {D} AS total_spend,
  CASE WHEN s.total_spend > 0
       THEN {rdiv('l.campaign_won_revenue', 's.total_spend')} END AS revenue_per_spend
FROM (
  SELECT count(*) AS leads, count(CASE WHEN is_won THEN 1 END) AS won_deals,
    sum(CASE WHEN is_won THEN opportunity_amount END) AS won_revenue,
    CAST(sum(days_lead_to_close) AS DOUBLE) / CAST(count(days_lead_to_close) AS DOUBLE)
      AS avg_days_lead_to_close,
    sum(CASE WHEN is_won AND campaign_id IS NOT NULL THEN opportunity_amount END)
      AS campaign_won_revenue
  FROM mart_sales_funnel) l,
  (SELECT sum(spend) AS total_spend FROM (
     SELECT DISTINCT campaign_id, campaign_spend AS spend FROM mart_sales_funnel
     WHERE campaign_id IS NOT NULL)) s"""

REPORTS["r8_leads_per_month"] = """
SELECT strftime(lead_created_at, '%Y-%m') AS lead_month, count(*) AS leads,
  count(CASE WHEN is_converted THEN 1 END) AS converted_leads
FROM mart_sales_funnel GROUP BY 1"""

REPORTS["r9_conversion_by_source"] = """
SELECT lead_source, count(*) AS leads,
  CAST(count(CASE WHEN is_converted THEN 1 END) AS DOUBLE) / CAST(count(*) AS DOUBLE)
    AS conversion_rate,
  CAST(count(CASE WHEN is_won THEN 1 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS win_rate
FROM mart_sales_funnel GROUP BY lead_source"""

REPORTS["r10_return_by_campaign"] = f"""
SELECT campaign_id, campaign_name, channel, leads, won_deals,
  CAST(won_revenue {D} AS won_revenue, CAST(total_spend {D} AS total_spend,
  CASE WHEN total_spend > 0 THEN {rdiv('won_revenue', 'total_spend')} END
    AS revenue_per_spend
FROM (
  SELECT campaign_id, max(campaign_name) AS campaign_name, max(channel) AS channel,
    count(*) AS leads, count(CASE WHEN is_won THEN 1 END) AS won_deals,
    sum(CASE WHEN is_won THEN opportunity_amount END) AS won_revenue,
    max(campaign_spend) AS total_spend
  FROM mart_sales_funnel WHERE campaign_id IS NOT NULL GROUP BY campaign_id)"""

REPORTS["r10_return_by_channel"] = f"""
SELECT l.channel, l.leads, l.won_deals, CAST(l.won_revenue {D} AS won_revenue,
  CAST(s.total_spend {D} AS total_spend,
  CASE WHEN s.total_spend > 0 THEN {rdiv('l.won_revenue', 's.total_spend')} END
    AS revenue_per_spend
FROM (
  SELECT channel, count(*) AS leads, count(CASE WHEN is_won THEN 1 END) AS won_deals,
    sum(CASE WHEN is_won THEN opportunity_amount END) AS won_revenue
  FROM mart_sales_funnel WHERE campaign_id IS NOT NULL GROUP BY channel) l
LEFT JOIN (
  SELECT channel, sum(spend) AS total_spend FROM (
    SELECT DISTINCT campaign_id, channel, campaign_spend AS spend FROM mart_sales_funnel
    WHERE campaign_id IS NOT NULL) GROUP BY channel) s
  ON l.channel IS NOT DISTINCT FROM s.channel"""

REPORTS["r10_return_by_source"] = f"""
SELECT lead_source, count(*) AS leads, count(CASE WHEN is_won THEN 1 END) AS won_deals,
  CAST(sum(CASE WHEN is_won THEN opportunity_amount END) {D} AS won_revenue
FROM mart_sales_funnel GROUP BY lead_source"""

REPORTS["r11_top_won_deals"] = f"""
SELECT lead_id, opportunity_id, account_name, lead_source, channel,
  CAST(opportunity_amount {D} AS opportunity_amount, close_date, days_lead_to_close
FROM mart_sales_funnel WHERE is_won
ORDER BY opportunity_amount DESC NULLS LAST, lead_id LIMIT {ROW_LIMIT}"""


# ------------------------------------------------------------- checks
def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The declared checks, as text. U unique and not null, N not null,
# V accepted values, R relationship, E expression.
DECLARED = """
stg_crm__accounts U account_id
stg_crm__accounts V account_status active|churned|prospect
stg_crm__accounts V tier starter|growth|enterprise
stg_crm__contacts U contact_id
stg_crm__contacts R account_id stg_crm__accounts.account_id
stg_crm__leads U lead_id
stg_crm__leads N contact_id
stg_crm__leads R contact_id stg_crm__contacts.contact_id
stg_crm__leads V lead_status new|working|nurturing|disqualified|converted
stg_crm__opportunities U opportunity_id
stg_crm__opportunities N account_id
stg_crm__opportunities R account_id stg_crm__accounts.account_id
stg_crm__opportunities V stage prospecting|qualification|proposal|negotiation|closed won|closed lost
stg_crm__campaigns U campaign_id
stg_crm__activities U activity_id
stg_crm__activities N account_id
stg_crm__support_tickets U ticket_id
stg_crm__support_tickets N account_id
stg_crm__support_tickets V priority low|medium|high|critical
stg_erp__products U product_id
stg_erp__products V billing_type subscription|one-time
stg_erp__orders U order_id
stg_erp__orders N account_id
stg_erp__invoices U invoice_id
stg_erp__invoices N account_id
stg_erp__invoices V payment_status paid|unpaid|overdue|partial
stg_erp__subscriptions U subscription_id
stg_erp__subscriptions N account_id
stg_erp__subscriptions R account_id stg_crm__accounts.account_id
stg_erp__subscriptions V subscription_status active|churned|paused|trial
stg_erp__payments U payment_id
stg_erp__payments N account_id
stg_erp__payments V payment_status successful|failed|refunded|pending
stg_web__web_events U event_id
stg_web__web_events V event_type page_view|form_submit|demo_request|pricing_view|blog_view|login|feature_use
stg_web__feature_usage U usage_id
stg_web__feature_usage N account_id
stg_web__feature_usage V engagement_level power|regular|light|inactive
int_accounts_with_subscriptions U account_id
int_customer_health U account_id
int_customer_health V churn_risk_band critical|high|medium|low
int_leads_with_campaigns U lead_id
int_leads_with_campaigns V lead_outcome closed_won|closed_lost|in_pipeline|not_converted
int_payment_health U account_id
int_payment_health V payment_health_band critical|poor|at_risk|healthy
int_sales_activity U opportunity_id
int_sales_activity V engagement_quality no_engagement|high|medium|low
mart_customer_churn U account_id
mart_customer_churn N account_name
mart_customer_churn N churn_risk_score
mart_customer_churn N churn_risk_band
mart_customer_churn N recommended_action
mart_customer_churn N mart_updated_at
mart_customer_churn V tier starter|growth|enterprise
mart_customer_churn V payment_health_band critical|poor|at_risk|healthy
mart_customer_churn V churn_risk_band critical|high|medium|low
mart_revenue U account_id
mart_revenue N revenue_health_band
mart_revenue N mart_updated_at
mart_revenue V tier starter|growth|enterprise
mart_revenue V payment_health_band critical|poor|at_risk|healthy
mart_revenue V revenue_health_band healthy|stable|at_risk|critical|no_revenue
mart_sales_funnel U lead_id
mart_sales_funnel N attribution_type
mart_sales_funnel N lead_outcome
mart_sales_funnel N funnel_stage
mart_sales_funnel N mart_updated_at
mart_sales_funnel V attribution_type campaign|organic
mart_sales_funnel V lead_outcome closed_won|closed_lost|in_pipeline|not_converted
mart_sales_funnel V funnel_stage 1_lead|2_converted|3_in_pipeline|4_closed_won|4_closed_lost
mart_sales_funnel V engagement_quality no_engagement|high|medium|low
mart_sales_funnel E days_lead_to_close days_lead_to_close >= 0 OR days_lead_to_close IS NULL
mart_sales_funnel E days_convert_to_close days_convert_to_close >= 0 OR days_convert_to_close IS NULL
"""


def check_sql() -> list[str]:
    """One statement per declared check: model, column_name, test, failures."""
    out = []
    for line in DECLARED.strip().splitlines():
        m, kind, c, *rest = line.split(" ", 3)
        arg = rest[0] if rest else ""
        head = f"SELECT {_q(m)} AS model, {_q(c)} AS column_name, "
        if kind == "U":
            out.append(f"{head}'unique' AS test, count(*) AS failures FROM (SELECT {c} FROM {m} "
                       f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        if kind in "UN":
            out.append(f"{head}'not_null' AS test, count(*) AS failures FROM {m} WHERE {c} IS NULL")
        elif kind == "V":
            values = ", ".join(_q(v) for v in arg.split("|"))
            out.append(f"{head}'accepted_values' AS test, count(*) AS failures FROM "
                       f"(SELECT DISTINCT {c} FROM {m}) WHERE {c} NOT IN ({values})")
        elif kind == "R":
            parent, key = arg.split(".")
            out.append(f"{head}'relationships' AS test, count(*) AS failures FROM {m} ch WHERE ch.{c} IS NOT NULL "
                       f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = ch.{c})")
        elif kind == "E":
            out.append(f"{head}'expression_is_true' AS test, count(*) AS failures FROM {m} WHERE NOT ({arg})")
    return out


REPORTS["v6_quality_suite"] = (
    "SELECT model, column_name, test, failures, "
    "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n"
    + "\nUNION ALL\n".join(check_sql()) + "\n)"
)

# Failing rows of single checks on raw tables.
REPORTS["v1_unique"] = """
SELECT contact_id, count(*) AS n_records FROM raw_leads
WHERE contact_id IS NOT NULL GROUP BY contact_id HAVING count(*) > 1"""
REPORTS["v2_not_null"] = "SELECT * FROM raw_contacts WHERE account_id IS NULL"
REPORTS["v3_accepted_values"] = """
SELECT account_status, count(*) AS n_records FROM raw_accounts
WHERE account_status NOT IN ('active', 'churned', 'prospect') GROUP BY account_status"""
REPORTS["v4_relationships"] = """
SELECT account_id, count(*) AS n_records FROM raw_feature_usage u
WHERE NOT EXISTS (SELECT 1 FROM raw_contacts c WHERE c.account_id = u.account_id) GROUP BY account_id"""
REPORTS["v5_expression_is_true"] = """
SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount)
FROM raw_orders WHERE NOT (unit_price >= 0)"""

REPORTS["d2_payment_sequence"] = """
SELECT payment_id, account_id, created_at, payment_status, is_failed,
  CAST(sum(CASE WHEN is_failed THEN 1 ELSE 0 END) OVER (in_time ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_failures,
  row_number() OVER in_time AS payment_sequence, lag(is_failed) OVER in_time AS previous_failed
FROM stg_erp__payments WHERE account_id IS NOT NULL
WINDOW in_time AS (PARTITION BY account_id ORDER BY created_at NULLS FIRST, payment_id)"""

# The written marts as the catalog describes them: all columns are documented.
REPORTS["s5_described_marts"] = "\nUNION ALL\n".join(
    f"SELECT '{m}' AS table_name, (SELECT count(*) FROM {m}) AS n_rows, CAST({n} AS BIGINT) AS n_columns, "
    f"CAST({n} AS BIGINT) AS n_documented, '{text}' AS description, '{key}' AS key_description"
    for m, n, text, key in (
        ("mart_customer_churn", 55, "One row per account: churn risk score, band, revenue at risk.",
         "Account key; one row per account."),
        ("mart_revenue", 49, "One row per account: billing health and revenue at risk.",
         "Account key; one row per account."),
        ("mart_sales_funnel", 53, "One row per lead: funnel stage, deal and engagement.",
         "Lead key; one row per lead, so account columns repeat.")))

# The raw tables with their numbers of columns.
REPORTS["s1_raw_tables"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM raw_{t}) AS n_rows, CAST({n} AS BIGINT) AS n_columns"
    for t, n in (("accounts", 8), ("contacts", 7), ("leads", 8), ("opportunities", 9), ("campaigns", 12),
                 ("activities", 11), ("support_tickets", 11), ("products", 5), ("orders", 9), ("invoices", 8),
                 ("subscriptions", 9), ("payments", 11), ("web_events", 8), ("feature_usage", 9)))

# Every stored view holds its model's rows.
REPORTS["s2_stored_views"] = "\nUNION ALL\n".join(
    f"SELECT '{v}' AS view_name, (SELECT count(*) FROM {v}) AS n_rows, true AS same"
    for v in [c for c in CTES if c.startswith(("stg_", "int_"))])

# The ranked lists and KPIs as the tables built with the marts give them.
REPORTS["s3_served_lists"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS list_name, CAST(row_number() OVER (ORDER BY {order}, {key}) AS INTEGER) AS place, "
    f"{key} AS key FROM ({REPORTS[of]}) AS shown"
    for name, of, key, order in (
        ("accounts_by_risk", "q2_list_high_risk_accounts", "account_id", "mrr_at_risk DESC NULLS LAST"),
        ("accounts_by_health", "q4_list_accounts_by_revenue_health", "account_id", "arr_at_risk DESC NULLS LAST"),
        ("leads_by_outcome", "q6_list_leads_by_outcome", "lead_id", "opportunity_amount DESC NULLS LAST"),
        ("leads_any_attribution", "q6_list_leads_by_outcome_any_attribution", "lead_id",
         "opportunity_amount DESC NULLS LAST"),
        ("highest_risk", "r3_highest_risk_accounts", "account_id",
         "churn_risk_score DESC NULLS LAST, mrr_at_risk DESC NULLS LAST"),
        ("poor_collection", "r6_poor_collection_accounts", "account_id",
         "collection_rate_pct NULLS FIRST, total_outstanding DESC NULLS LAST"),
        ("won_deals", "r11_top_won_deals", "lead_id", "opportunity_amount DESC NULLS LAST")))

REPORTS["s3_served_kpis"] = "\nUNION ALL\n".join(
    f"SELECT '{page}' AS page, '{k}' AS kpi, CAST({k} AS DOUBLE) AS value FROM ({REPORTS[of]}) AS shown"
    for page, of, kpis in (
        ("churn", "r1_churn_kpis", "accounts accounts_at_risk total_mrr mrr_at_risk arr_at_risk"),
        ("revenue", "r4_revenue_kpis", "total_mrr total_arr accounts collection_rate_pct total_outstanding"),
        ("funnel", "r7_funnel_kpis", "leads won_deals won_revenue avg_days_lead_to_close total_spend revenue_per_spend"))
    for k in kpis.split())

FINAL.update(REPORTS)
