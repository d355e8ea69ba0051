"""Column descriptions stored with the marts (our own wording).

``GLOSSARY`` describes a column wherever it appears; ``MART_NOTES``
overrides it for a mart where the same name means something else
(``arr_at_risk``) or needs a grain warning. NULL meanings are stated
because several columns are NULL on purpose.
"""

from __future__ import annotations

GLOSSARY: dict[str, str] = {
    # account attributes
    "account_id": "Account key.",
    "account_name": "Account display name.",
    "industry": "Industry segment, lower case.",
    "country": "Country, lower case.",
    "tier": "Customer tier: starter, growth or enterprise.",
    "tier_rank": "Tier as a number: enterprise 3, growth 2, starter 1, other 0.",
    "account_status": "CRM status: active, churned or prospect.",
    "is_churned": "True when the CRM status is churned.",
    "created_at": "When the account was created (UTC).",
    # subscriptions
    "total_subscriptions": "Subscriptions of the account, inverted date ranges excluded.",
    "active_subscriptions": "Subscriptions with status active.",
    "churned_subscriptions": "Subscriptions with status churned.",
    "total_mrr": "Sum of monthly recurring revenue over subscriptions, 2 decimals.",
    "total_arr": "Sum of annual recurring revenue (12 x MRR), 2 decimals.",
    "earliest_subscription_start": "First subscription start date; NULL without subscriptions.",
    "latest_subscription_start": "Latest subscription start date; NULL without subscriptions.",
    "avg_subscription_duration_days": "Average length of subscriptions with an end date, "
                                      "in days; 0 when none has one.",
    # invoices
    "total_invoices": "Invoices of the account.",
    "paid_invoices": "Invoices with status paid.",
    "overdue_invoices": "Invoices with status overdue.",
    "total_billed": "Sum of amounts due on invoices.",
    "total_collected": "Sum of amounts paid on invoices (missing payments count as 0).",
    "total_outstanding": "Sum of unpaid invoice balances.",
    "max_days_overdue": "Largest days overdue of an overdue invoice, counted to the run "
                        "date; negative when due later; 0 without overdue invoices.",
    "collection_rate_pct": "Collected over billed, percent, 2 decimals; 0 when nothing "
                           "was billed.",
    # payments
    "payment_failure_rate_pct": "Failed payments over all payments, percent; 0 without "
                                "payments.",
    "total_payments": "Payment attempts of the account.",
    "successful_payments": "Payments with status successful.",
    "failed_payments": "Payments with status failed.",
    "repeat_failures": "Payments retried at least twice, whatever their status.",
    "total_payment_amount": "Sum of successful payment amounts.",
    "payment_health_score": "100 minus penalties for failures, consecutive failures, "
                            "overdue invoices and days overdue; NULL when the account has "
                            "payments but no invoices, or no payments.",
    "payment_health_band": "critical (3+ consecutive failures), poor (5+ failures), "
                           "at_risk (2+ failures) or healthy; NULL without payments.",
    "consecutive_failure_count": "Failed payments directly preceded by another failed "
                                 "payment, in creation order.",
    "total_cumulative_failures": "Final value of the running count of failed payments.",
    "most_recent_failure_reason": "Reason recorded on the newest failed payment; NULL when "
                                  "that payment has no reason, even if older ones do.",
    "latest_payment_date": "Date of the newest payment.",
    "first_payment_date": "Date of the oldest payment.",
    "avg_payment_amount": "Average successful payment amount, 2 decimals.",
    # support
    "total_tickets": "Support tickets of the account.",
    "high_priority_tickets": "Tickets with priority high or critical.",
    "low_csat_tickets": "Tickets rated 1 or 2 for satisfaction.",
    "escalated_tickets": "Tickets with status escalated.",
    "open_tickets": "Tickets with status open.",
    "avg_csat_score": "Average satisfaction rating (1-5) of rated tickets.",
    "avg_resolution_hours": "Average whole hours from creation to resolution.",
    "latest_ticket_date": "Creation time of the newest ticket.",
    # usage
    "distinct_features_used": "Distinct features with dated usage.",
    "total_usage_count": "Sum of usage counts over dated usage rows.",
    "power_usage_days": "Usage rows at power level (100+ uses); counts rows, not days.",
    "inactive_days": "Usage rows with no use; counts rows, not days.",
    "latest_usage_date": "Newest usage date.",
    "avg_session_duration_minutes": "Average session length in minutes.",
    # churn scoring
    "churn_risk_score": "Churn risk points, 0 to 100, higher is riskier: payment, support "
                        "and low-usage signals, each capped.",
    "churn_risk_band": "critical (score >= 60), high (>= 40), medium (>= 20) or low.",
    "days_since_last_ticket": "Days from the newest ticket to the run date.",
    "days_since_last_usage": "Days from the newest usage to the run date.",
    "days_since_last_payment": "Days from the newest payment to the run date.",
    "mrr_at_risk": "MRR weighted by churn band: all for critical, 75% high, 40% medium, "
                   "none for low.",
    "recommended_action": "Suggested next step for the churn band.",
    # revenue health
    "revenue_health_band": "no_revenue (no active subscription), healthy, stable, at_risk "
                           "or critical, from collection rate and payment band.",
    "net_revenue": "Collected minus outstanding.",
    "outstanding_pct": "Outstanding over billed, percent; 0 when nothing was billed.",
    "estimated_clv": "Lifetime value estimate: MRR times average subscription length in "
                     "30-day months; 0 when no length is known.",
    "customer_tenure_days": "Days from the first subscription start to the run date.",
    "days_since_latest_subscription": "Days from the newest subscription start to the run "
                                      "date.",
    "has_expanded": "More than one subscription, started on different dates.",
    "has_contracted": "Has both churned and active subscriptions.",
    # leads and campaigns
    "lead_id": "Lead key.",
    "contact_id": "Contact the lead belongs to.",
    "campaign_id": "Campaign that brought the lead; NULL for organic leads.",
    "campaign_name": "Campaign name.",
    "campaign_type": "Campaign type, lower case.",
    "channel": "Campaign channel, lower case.",
    "lead_source": "Where the lead came from, lower case.",
    "lead_status": "CRM lead status.",
    "assigned_rep": "Sales rep owning the lead.",
    "attribution_type": "campaign when the lead has a campaign, else organic.",
    "lead_outcome": "closed_won, closed_lost, in_pipeline (converted, deal not closed) or "
                    "not_converted.",
    "lead_created_at": "When the lead was created (UTC).",
    "converted_at": "When the lead converted; NULL when it did not or the date is missing.",
    "is_converted": "True when the lead status is converted.",
    "days_to_convert": "Whole days from lead creation to conversion.",
    "is_decision_maker": "Contact holds a decision-making title; NULL when the contact is "
                         "missing or has no account.",
    "budget": "Campaign budget.",
    "actual_spend": "Campaign spend; NULL when not recorded.",
    "budget_utilisation_pct": "Spend over budget, percent.",
    # opportunities
    "opportunity_id": "The lead's chosen opportunity: best stage first, then largest amount.",
    "opportunity_stage": "Stage of that opportunity.",
    "opportunity_amount": "Amount of that opportunity.",
    "weighted_amount": "Amount times win probability.",
    "is_won": "Opportunity closed won.",
    "is_lost": "Opportunity closed lost.",
    "is_open": "Opportunity not closed (false when the stage is unknown).",
    "close_date": "Opportunity close date.",
    "probability": "Win probability, percent.",
    "funnel_stage": "1_lead, 2_converted, 3_in_pipeline, 4_closed_won or 4_closed_lost.",
    # activities
    "total_activities": "Dated activities logged on the opportunity.",
    "high_touch_activities": "Calls, meetings and demos on the opportunity.",
    "positive_outcomes": "Activities with a positive outcome.",
    "total_calls": "Calls on the opportunity.",
    "total_meetings": "Meetings on the opportunity.",
    "total_demos": "Demos on the opportunity.",
    "total_emails": "Emails on the opportunity.",
    "reps_involved": "Distinct reps active on the opportunity.",
    "avg_activity_duration": "Average activity length in minutes.",
    "positive_outcome_rate": "Positive outcomes over activities, percent.",
    "engagement_quality": "no_engagement, low, medium or high by high-touch activities; "
                          "NULL without an opportunity.",
    "days_since_last_activity": "Days from the newest activity to the run date.",
    "latest_activity_date": "Newest activity date.",
    "first_activity_date": "Oldest activity date.",
    "days_lead_to_close": "Days from lead creation to close for won deals; NULL otherwise "
                          "or when the close precedes the lead.",
    "days_convert_to_close": "Days from conversion to close for won deals; NULL otherwise.",
    "campaign_spend": "Campaign spend when above 0; repeats on every lead of the campaign.",
    "revenue_per_spend": "Won amount over campaign spend, for won campaign leads.",
    "mart_updated_at": "When the mart was built (UTC).",
}

MART_NOTES: dict[str, dict[str, str]] = {
    "mart_customer_churn": {
        "account_id": "Account key; one row per account.",
        "arr_at_risk": "ARR weighted by churn band: all for critical, 75% high, 40% medium, "
                       "none for low.",
    },
    "mart_revenue": {
        "account_id": "Account key; one row per account.",
        "arr_at_risk": "ARR at risk by collection rate: all below 50%, half below 70%, a "
                       "fifth below 90%, none above.",
    },
    "mart_sales_funnel": {
        "lead_id": "Lead key; one row per lead, so account columns repeat.",
        "account_id": "Account of the lead's contact.",
    },
}


def describe(mart: str, column: str) -> str | None:
    return MART_NOTES.get(mart, {}).get(column) or GLOSSARY.get(column)
