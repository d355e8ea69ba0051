"""Data-quality checks as Spark jobs: unique, not_null, accepted_values,
relationships and expression_is_true, plus a suite that runs all 95.

Every check reports ``failures``, the number of rows its failing-rows
query returns (0 passes):

* unique: values (non-NULL) that occur more than once;
* not_null: rows where the column is NULL;
* accepted_values: distinct non-NULL values outside the list;
* relationships: non-NULL child rows whose key is missing in the parent;
* expression_is_true: rows where the expression is false (NULL passes).

The suite (``run_checks``) counts the same failures in one pass. Every model is
read once; a row gives one tagged entry for each key that some check needs
grouped (its own key, a key it refers to, a value outside a list) and for each
check it fails by itself. One exchange groups the entries of all models by
(space, key), with a partial stage, so a key that holds a large share of the
rows travels as one row per task; a second one adds up a few numbers per space.
A parent's keys and the keys that refer to it share a space, which decides
relationships without a join, and a unique check reads the same entries.
A Bloom filter of the parents' keys would not save entries: keys that it lets
through, nearly all, need the exact answer anyway.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    values: tuple[str, ...] = ()
    to_model: str = ""
    to_column: str = ""
    expression: str = ""


def _u(model: str, column: str) -> list[Check]:
    return [Check(model, column, "unique"), Check(model, column, "not_null")]


def _nn(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, "not_null") for c in columns]


def _av(model: str, column: str, values: Sequence[str]) -> Check:
    return Check(model, column, "accepted_values", values=tuple(values))


def _rel(model: str, column: str, to_model: str, to_column: str) -> Check:
    return Check(model, column, "relationships", to_model=to_model, to_column=to_column)


def _expr(model: str, column: str, expression: str) -> Check:
    return Check(model, column, "expression_is_true", expression=expression)


# Legal values of the checked categorical columns.
ACCOUNT_STATUS = ("active", "churned", "prospect")
TIER = ("starter", "growth", "enterprise")
LEAD_STATUS = ("new", "working", "nurturing", "disqualified", "converted")
STAGE = ("prospecting", "qualification", "proposal", "negotiation", "closed won",
         "closed lost")
PRIORITY = ("low", "medium", "high", "critical")
BILLING_TYPE = ("subscription", "one-time")
INVOICE_STATUS = ("paid", "unpaid", "overdue", "partial")
SUBSCRIPTION_STATUS = ("active", "churned", "paused", "trial")
PAYMENT_STATUS = ("successful", "failed", "refunded", "pending")
EVENT_TYPE = ("page_view", "form_submit", "demo_request", "pricing_view", "blog_view",
              "login", "feature_use")
ENGAGEMENT_LEVEL = ("power", "regular", "light", "inactive")
CHURN_RISK_BAND = ("critical", "high", "medium", "low")
LEAD_OUTCOME = ("closed_won", "closed_lost", "in_pipeline", "not_converted")
PAYMENT_HEALTH_BAND = ("critical", "poor", "at_risk", "healthy")
ENGAGEMENT_QUALITY = ("no_engagement", "high", "medium", "low")
REVENUE_HEALTH_BAND = ("healthy", "stable", "at_risk", "critical", "no_revenue")
ATTRIBUTION_TYPE = ("campaign", "organic")
FUNNEL_STAGE = ("1_lead", "2_converted", "3_in_pipeline", "4_closed_won", "4_closed_lost")

# The declared checks, per model (52 staging, 14
# intermediate, 29 mart).
CHECKS: tuple[Check, ...] = tuple(
    # staging
    _u("stg_crm__accounts", "account_id")
    + [_av("stg_crm__accounts", "account_status", ACCOUNT_STATUS),
       _av("stg_crm__accounts", "tier", TIER)]
    + _u("stg_crm__contacts", "contact_id")
    + [_rel("stg_crm__contacts", "account_id", "stg_crm__accounts", "account_id")]
    + _u("stg_crm__leads", "lead_id") + _nn("stg_crm__leads", "contact_id")
    + [_rel("stg_crm__leads", "contact_id", "stg_crm__contacts", "contact_id"),
       _av("stg_crm__leads", "lead_status", LEAD_STATUS)]
    + _u("stg_crm__opportunities", "opportunity_id")
    + _nn("stg_crm__opportunities", "account_id")
    + [_rel("stg_crm__opportunities", "account_id", "stg_crm__accounts", "account_id"),
       _av("stg_crm__opportunities", "stage", STAGE)]
    + _u("stg_crm__campaigns", "campaign_id")
    + _u("stg_crm__activities", "activity_id") + _nn("stg_crm__activities", "account_id")
    + _u("stg_crm__support_tickets", "ticket_id")
    + _nn("stg_crm__support_tickets", "account_id")
    + [_av("stg_crm__support_tickets", "priority", PRIORITY)]
    + _u("stg_erp__products", "product_id")
    + [_av("stg_erp__products", "billing_type", BILLING_TYPE)]
    + _u("stg_erp__orders", "order_id") + _nn("stg_erp__orders", "account_id")
    + _u("stg_erp__invoices", "invoice_id") + _nn("stg_erp__invoices", "account_id")
    + [_av("stg_erp__invoices", "payment_status", INVOICE_STATUS)]
    + _u("stg_erp__subscriptions", "subscription_id")
    + _nn("stg_erp__subscriptions", "account_id")
    + [_rel("stg_erp__subscriptions", "account_id", "stg_crm__accounts", "account_id"),
       _av("stg_erp__subscriptions", "subscription_status", SUBSCRIPTION_STATUS)]
    + _u("stg_erp__payments", "payment_id") + _nn("stg_erp__payments", "account_id")
    + [_av("stg_erp__payments", "payment_status", PAYMENT_STATUS)]
    + _u("stg_web__web_events", "event_id")
    + [_av("stg_web__web_events", "event_type", EVENT_TYPE)]
    + _u("stg_web__feature_usage", "usage_id") + _nn("stg_web__feature_usage", "account_id")
    + [_av("stg_web__feature_usage", "engagement_level", ENGAGEMENT_LEVEL)]
    # intermediate
    + _u("int_accounts_with_subscriptions", "account_id")
    + _u("int_customer_health", "account_id")
    + [_av("int_customer_health", "churn_risk_band", CHURN_RISK_BAND)]
    + _u("int_leads_with_campaigns", "lead_id")
    + [_av("int_leads_with_campaigns", "lead_outcome", LEAD_OUTCOME)]
    + _u("int_payment_health", "account_id")
    + [_av("int_payment_health", "payment_health_band", PAYMENT_HEALTH_BAND)]
    + _u("int_sales_activity", "opportunity_id")
    + [_av("int_sales_activity", "engagement_quality", ENGAGEMENT_QUALITY)]
    # marts
    + _u("mart_customer_churn", "account_id")
    + _nn("mart_customer_churn", "account_name", "churn_risk_score", "churn_risk_band",
          "recommended_action", "mart_updated_at")
    + [_av("mart_customer_churn", "tier", TIER),
       _av("mart_customer_churn", "payment_health_band", PAYMENT_HEALTH_BAND),
       _av("mart_customer_churn", "churn_risk_band", CHURN_RISK_BAND)]
    + _u("mart_revenue", "account_id")
    + _nn("mart_revenue", "revenue_health_band", "mart_updated_at")
    + [_av("mart_revenue", "tier", TIER),
       _av("mart_revenue", "payment_health_band", PAYMENT_HEALTH_BAND),
       _av("mart_revenue", "revenue_health_band", REVENUE_HEALTH_BAND)]
    + _u("mart_sales_funnel", "lead_id")
    + _nn("mart_sales_funnel", "attribution_type", "lead_outcome", "funnel_stage",
          "mart_updated_at")
    + [_av("mart_sales_funnel", "attribution_type", ATTRIBUTION_TYPE),
       _av("mart_sales_funnel", "lead_outcome", LEAD_OUTCOME),
       _av("mart_sales_funnel", "funnel_stage", FUNNEL_STAGE),
       _av("mart_sales_funnel", "engagement_quality", ENGAGEMENT_QUALITY),
       _expr("mart_sales_funnel", "days_lead_to_close",
             "days_lead_to_close >= 0 or days_lead_to_close is null"),
       _expr("mart_sales_funnel", "days_convert_to_close",
             "days_convert_to_close >= 0 or days_convert_to_close is null")]
)

# ------------------------------------------------------- single checks
def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """V1: the duplicated non-NULL values of ``column`` with their counts."""
    c = F.col(column)
    return df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_records")) \
        .where(F.col("n_records") > 1)


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """V2: rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """V3: values outside ``values`` (NULL passes), with their row counts."""
    c = F.col(column)
    return df.where(c.isNotNull() & ~c.isin(*values)).groupBy(c) \
        .agg(F.count(F.lit(1)).alias("n_records"))


def relationships_failures(child: DataFrame, column: str, parent: DataFrame,
                           to_column: str) -> DataFrame:
    """V4: child keys (non-NULL) missing from the parent, with row counts."""
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")) \
        .agg(F.count(F.lit(1)).alias("n_records"))
    parent_keys = parent.select(F.col(to_column).alias("_k"))
    return keys.join(parent_keys, "_k", "left_anti").withColumnRenamed("_k", column)


def expression_failures(df: DataFrame, expression: str) -> DataFrame:
    """V5: rows where ``expression`` is false (NULL passes)."""
    return df.where(~F.expr(expression))


# ---------------------------------------------------------------- suite
def failures(df: DataFrame, check: Check, resolve: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """The failing rows (or values with counts) of one check."""
    if check.test == "unique":
        return unique_failures(df, check.column)
    if check.test == "not_null":
        return not_null_failures(df, check.column)
    if check.test == "accepted_values":
        return accepted_values_failures(df, check.column, check.values)
    if check.test == "expression_is_true":
        return expression_failures(df, check.expression)
    if check.test == "relationships":
        if resolve is None:
            raise ValueError("relationships checks need a model resolver")
        return relationships_failures(df, check.column, resolve(check.to_model), check.to_column)
    raise ValueError(check.test)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of same-schema frames as a balanced tree.

    A left-deep chain re-analyses an ever larger plan at each step; the
    tree keeps the driver-side planning cost near-linear in the number
    of checks. The optimizer flattens nested unions either way.
    """
    level = list(frames)
    while len(level) > 1:
        level = [level[i].unionByName(level[i + 1]) if i + 1 < len(level) else level[i]
                 for i in range(0, len(level), 2)]
    return level[0]


class _Spaces:
    """Which entries the checks need: a space for the keys of (model, column), for
    the bad values of a check, or for the rows that fail it. Relationships on one
    parent column have a space each, the first that of its keys: the parent says
    its few keys more often, so that an entry of the large models has two numbers."""

    def __init__(self, checks: Sequence[Check]):
        self.numbers: dict[tuple, int] = {}
        self.of: list[tuple[Check, int]] = []   # check and its space
        self.owned: dict[str, list[tuple[str, int]]] = {}   # model -> key columns and their spaces
        referred: dict[tuple[str, str], int] = {}   # parent column -> relationships on it
        for i, check in enumerate(checks):
            if check.test == "unique":
                space = self._keys(check.model, check.column)
            elif check.test == "relationships":
                parent = check.to_model, check.to_column
                space = self._keys(*parent, referred.get(parent, 0))
                referred[parent] = referred.get(parent, 0) + 1
            else:
                space = self._number((check.test, i))
            self.of.append((check, space))

    def _number(self, name: tuple) -> int:
        return self.numbers.setdefault(name, len(self.numbers))

    def _keys(self, model: str, column: str, which: int = 0) -> int:
        space = self._number(("keys", model, column, which))
        if (column, space) not in self.owned.setdefault(model, []):
            self.owned[model].append((column, space))
        return space

    def _entry(self, when: str, space: int, key: str, own: bool = True) -> str:
        return (f"if({when}, named_struct('space', {space}, 'key', cast({key} as string), "
                f"'own', {int(own)}L, 'refers', {int(not own)}L), null)")

    def entries(self, model: str) -> list[str]:
        """What each row of a model says (SQL expressions); NULL where it says nothing."""
        out = [self._entry(f"`{c}` is not null", space, f"`{c}`") for c, space in self.owned.get(model, [])]
        for check, space in self.of:
            if check.model != model or check.test == "unique":
                continue
            c = f"`{check.column}`"
            if check.test == "relationships":
                out.append(self._entry(f"{c} is not null", space, c, own=False))
            elif check.test == "accepted_values":
                values = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in check.values)
                out.append(self._entry(f"{c} not in ({values})", space, c))
            else:
                failing = f"{c} is null" if check.test == "not_null" else f"not ({check.expression})"
                out.append(self._entry(failing, space, "null"))
        return out

    def models(self) -> list[str]:
        return list(dict.fromkeys([c.model for c, _ in self.of] + [c.to_model for c, _ in self.of if c.to_model]))


def run_checks(models: Mapping[str, DataFrame] | Callable[[str], DataFrame],
               checks: Sequence[Check] = CHECKS) -> DataFrame:
    """V6: one row per check: model, column_name, test, failures, status."""
    resolve = models if callable(models) else models.__getitem__
    spaces = _Spaces(checks)
    frames = [resolve(m).selectExpr(f"inline(array_compact(array({', '.join(spaces.entries(m))})))")
              for m in spaces.models()]
    keys = union_all(frames).groupBy("space", "key").agg(F.sum("own").alias("own"), F.sum("refers").alias("refers"))
    counts = keys.groupBy("space").agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("own") > 1).alias("n_repeated"),
        F.sum("own").alias("n_rows"), F.sum(F.when(F.col("own") == 0, F.col("refers")).otherwise(0)).alias("n_missing"))
    listed = frames[0].sparkSession.createDataFrame(
        [(c.model, c.column, c.test, space) for c, space in spaces.of],
        "model string, column_name string, test string, of int")
    found = (F.when(F.col("test") == "unique", F.col("n_repeated"))
             .when(F.col("test") == "accepted_values", F.col("n_keys"))
             .when(F.col("test") == "relationships", F.col("n_missing"))
             .otherwise(F.col("n_rows")))
    return (listed.join(F.broadcast(counts), F.col("of") == F.col("space"), "left")   # a row per space
            .select("model", "column_name", "test", F.coalesce(found, F.lit(0)).alias("failures"))
            .withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail")))
