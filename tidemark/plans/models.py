"""Model registry: name, layer, tags and inputs of every model.

A ``Warehouse`` holds the 14 raw DataFrames and builds models lazily by
name, memoising each DataFrame so a model read by several others is one
logical sub-plan. Building a model is only composing DataFrames; Spark
runs nothing until an action.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.operators import intermediate as I
from tidemark.operators import marts as M
from tidemark.operators.staging import STAGING
from tidemark.session import colocated, written


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    tags: tuple[str, ...]
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    dated: bool = False  # takes as_of
    stamped: bool = False  # takes run_ts
    description: str = ""
    shared: tuple[tuple[str, str], ...] = ()  # (keyword, helper model) passed in
    alone: "Model | None" = None  # how it is built while its helper is not written


def _staging_models() -> list[Model]:
    out = []
    for name, (raw, fn, dated) in STAGING.items():
        group = name.split("_")[1]
        out.append(Model(name, "staging", (group, "staging"), (f"raw.{raw}",), fn,
                         dated=dated))
    return out


ROLLUPS = (("invoice_totals", "account_invoice_totals"),
           ("payment_totals", "account_payment_totals"))

MODELS: dict[str, Model] = {m.name: m for m in _staging_models() + [
    # Helpers: per-account invoice and payment totals read by both D1 and
    # D2. Not models of their own in the layer sense; sharing them lets a
    # full build aggregate each fact table once.
    Model("account_invoice_totals", "helper", ("helper",), ("stg_erp__invoices",),
          I.invoice_rollup),
    Model("account_payment_totals", "helper", ("helper",), ("stg_erp__payments",),
          I.payment_rollup),
    # D1 with what the marts take from D2, from one join of the rollups.
    Model("account_billing", "helper", ("helper",),
          ("stg_crm__accounts", "stg_erp__subscriptions", "stg_erp__invoices",
           "stg_erp__payments"), I.account_billing, shared=ROLLUPS),
    Model("int_accounts_with_subscriptions", "intermediate", ("intermediate",),
          ("account_billing",), lambda wide: wide.drop(*I.HEALTH_COLS),
          description="One row per account: subscription, invoice and payment rollups.",
          alone=Model("int_accounts_with_subscriptions", "intermediate", (),
                      ("stg_crm__accounts", "stg_erp__subscriptions", "stg_erp__invoices",
                       "stg_erp__payments"), I.int_accounts_with_subscriptions)),
    Model("int_payment_health", "intermediate", ("intermediate",),
          ("stg_erp__payments", "stg_erp__invoices"), I.int_payment_health, shared=ROLLUPS,
          description="One row per paying account: failure pattern, score and band."),
    Model("customer_health_with_billing", "helper", ("helper",),
          ("stg_crm__accounts", "stg_crm__support_tickets", "stg_web__feature_usage",
           "account_billing"), I.customer_health_with_billing),
    Model("int_customer_health", "intermediate", ("intermediate",),
          ("customer_health_with_billing",),
          lambda wide: wide.drop(*I.CARRIED_COLS),
          description="One row per account: support and usage signals, churn risk.",
          alone=Model("int_customer_health", "intermediate", (),
                      ("stg_crm__accounts", "stg_crm__support_tickets", "stg_web__feature_usage",
                       "int_accounts_with_subscriptions"), I.int_customer_health)),
    Model("int_sales_activity", "intermediate", ("intermediate",),
          ("stg_crm__activities", "stg_crm__opportunities", "stg_crm__accounts"),
          I.int_sales_activity, dated=True,
          description="One row per opportunity: activity engagement."),
    Model("int_leads_with_campaigns", "intermediate", ("intermediate",),
          ("stg_crm__leads", "stg_crm__campaigns", "stg_crm__opportunities",
           "stg_crm__contacts"), I.int_leads_with_campaigns,
          description="One row per lead: campaign, contact and best opportunity."),
    Model("mart_customer_churn", "marts", ("core", "marts"),
          ("customer_health_with_billing", "stg_crm__accounts"),
          M.mart_customer_churn_shared, dated=True, stamped=True,
          description="One row per account: churn risk score, band, revenue at risk."),
    Model("mart_revenue", "marts", ("finance", "marts"),
          ("account_billing",),
          M.mart_revenue_shared, dated=True, stamped=True,
          description="One row per account: billing health and revenue at risk."),
    Model("mart_sales_funnel", "marts", ("marketing", "marts"),
          ("stg_crm__leads", "stg_crm__campaigns", "stg_crm__opportunities",
           "stg_crm__contacts", "stg_crm__accounts", "stg_crm__activities"),
          M.mart_sales_funnel_shared, dated=True, stamped=True,
          description="One row per lead: funnel stage, deal and engagement."),
]}

# Models read by more than one downstream model; written once in a build, in
# buckets of their account. All are one row per account, small next to the
# fact tables.
SHARED = ("account_invoice_totals", "account_payment_totals", "account_billing")


def by_tag(tag: str) -> list[str]:
    return [m.name for m in MODELS.values() if tag in m.tags]


def upstream(name: str) -> list[str]:
    """All models ``name`` depends on, in dependency order, itself last."""
    seen: list[str] = []

    def visit(n: str) -> None:
        deps = list(MODELS[n].inputs) + [helper for _, helper in MODELS[n].shared]
        for dep in deps:
            if not dep.startswith("raw.") and dep not in seen:
                visit(dep)
        if n not in seen:
            seen.append(n)

    visit(name)
    return seen


@dataclass
class Warehouse:
    raw: Mapping[str, DataFrame]
    as_of: dt.date | None = None
    run_ts: dt.datetime | None = None
    _built: dict[str, DataFrame] = field(default_factory=dict)
    _written: set[str] = field(default_factory=set)

    def model(self, name: str) -> DataFrame:
        if name not in self._built:
            m = MODELS[name]
            # its own columns cost less than a helper's, unless the helper is there
            m = m.alone if m.alone and not self._written.intersection(m.inputs) else m
            args = [self.raw[d[4:]] if d.startswith("raw.") else self.model(d)
                    for d in m.inputs]
            kwargs = {kw: self.model(helper) for kw, helper in m.shared}
            if m.dated:
                kwargs["as_of"] = self.as_of
            if m.stamped:
                kwargs["run_ts"] = self.run_ts
            self._built[name] = m.build(*args, **kwargs)
        return self._built[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.model(name)

    def write_shared(self) -> None:
        """Evaluate the models several marts read once, co-located by account.
        The totals read different fact tables and are written side by side."""
        totals = [helper for _, helper in ROLLUPS]
        for name in totals:
            self.model(name)  # plan on one thread
        with ThreadPoolExecutor(max_workers=len(totals)) as pool:
            list(pool.map(self._write, totals))
        for name in SHARED:
            self._write(name)

    def write_checked(self, layers: tuple[str, ...] = ("helper",)) -> None:
        """Evaluate every model of the layers once, in dependency order, into
        the shared folder; later reads see the written rows. The checks read each
        model once, so only helpers, which several models read, gain from it."""
        self.write_shared()
        for name in [n for n, m in MODELS.items() if m.layer in layers]:
            self._write(name)

    def _write(self, name: str) -> None:
        if name not in self._written:
            df = self.model(name)
            self._built[name] = (colocated(df, name, "account_id") if MODELS[name].layer == "helper"
                                 else written(df, name))
            self._written.add(name)

    def register_views(self, layer: str | None = None) -> list[str]:
        """Expose models as temp views (the view sink)."""
        names = [n for n, m in MODELS.items() if layer is None or m.layer == layer]
        for n in names:
            self.model(n).createOrReplaceTempView(n)
        return names
