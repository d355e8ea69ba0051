"""Map the generated test tables onto the 14 raw CRM / ERP / web tables.

The models read 14 raw tables (accounts, contacts, ... feature_usage).
The test data ships TPC-H-like tables instead, so each raw table is
derived from one of them by a deterministic column mapping (documented
in FIXTURES.md). Every mapping is a narrow projection of all rows of its
source: no filter, no shuffle, and the only join (customer to nation)
broadcasts the 25-row nation table, whose size is fixed by the TPC-H
schema. Where accounts without subscriptions, invoices, payments or
tickets are wanted, their rows go to the neighbouring account; where
usage or activities should not count, their date is missing.

Dirty text (mixed case, stray spaces) is planted on purpose so the
staging layer's cleaning has something to do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.raw import LazyTables

RAW_TABLES = (
    "accounts", "contacts", "leads", "opportunities", "campaigns",
    "activities", "support_tickets", "products", "orders", "invoices",
    "subscriptions", "payments", "web_events", "feature_usage",
)

# The only test tables the mapping reads; each with the columns used.
SOURCE_COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "nation": ["n_nationkey", "n_name"],
    "supplier": ["s_suppkey", "s_name"],
    "part": ["p_partkey", "p_name", "p_type", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                 "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type"],
}

# Money is decimal(18,2) in the raw tables.
RAW_MONEY = "decimal(18,2)"


def _id(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _pick(index: Column, values: Sequence) -> Column:
    """values[index] for a small non-negative integer index."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def _days(base: str, n: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), n.cast("int"))


def _ts_days(base: str, n: Column) -> Column:
    return F.timestamp_add("DAY", n, F.lit(base).cast("timestamp"))


def _div(c: Column, n: int) -> Column:
    """Whole quotient of a non-negative key."""
    return F.floor(c / n).cast("long")


def _floor_money(c: Column) -> Column:
    return F.floor(c).cast(RAW_MONEY)


class TestData:
    """Reads the generated parquet tables of one scale factor.

    Each source file is opened once (several raw tables derive from
    ``orders`` and ``events``); Catalyst still prunes every scan to the
    columns its raw table uses.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._sources: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._sources:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._sources[name] = df.select(*SOURCE_COLUMNS[name])
        return self._sources[name]

    # -- crm -----------------------------------------------------------
    def accounts(self) -> DataFrame:
        c = self.table("customer")
        n = F.broadcast(self.table("nation"))
        ck = F.col("c_custkey")
        return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
            _id("A", ck).alias("account_id"),
            F.col("c_name").alias("account_name"),
            F.concat(F.lit(" "), F.col("c_mktsegment")).alias("industry"),
            F.concat(F.col("n_name"), F.lit(" ")).alias("country"),
            F.when(ck % 10 == 0, "Churned").when(ck % 10 == 1, "prospect")
             .when(ck % 4 == 0, "\u00a0ACTIVE\u2003").otherwise(" ACTIVE").alias("account_status"),
            _pick(ck % 3, ["Starter", "GROWTH ", "enterprise"]).alias("tier"),
            (F.lit(1) + (ck * 7) % 5000).cast("long").alias("employee_count"),
            _ts_days("1994-06-01", ck % 200).alias("created_at"),
        )

    def contacts(self) -> DataFrame:
        ck = F.col("c_custkey")
        return self.table("customer").select(
            _id("C", ck).alias("contact_id"),
            F.when(ck % 20 != 7, _id("A", ck)).alias("account_id"),
            F.concat(F.lit("Contact "), ck.cast("string")).alias("full_name"),
            F.concat(F.lit(" USER"), ck.cast("string"), F.lit("@Example.com")).alias("email"),
            _pick(ck % 8, ["CEO", "CTO ", "cfo", "VP of Sales", "Head of Operations",
                           "Sales Director", "analyst", "engineer"]).alias("job_title"),
            F.concat(F.lit("000-"), ck.cast("string")).alias("phone"),
            _ts_days("1994-07-01", ck % 100).alias("created_at"),
        )

    def campaigns(self) -> DataFrame:
        sk = F.col("s_suppkey")
        k = sk % 10
        start = _days("1995-01-01", k * 200)
        return self.table("supplier").select(
            _id("M", sk).alias("campaign_id"),
            F.col("s_name").alias("campaign_name"),
            _pick(sk % 3, ["Email", "Webinar ", "PAID"]).alias("campaign_type"),
            _pick(sk % 2, ["Active", "done"]).alias("status"),
            _pick(sk % 3, ["Search", "Social ", "Partner"]).alias("channel"),
            _id("owner", sk % 3).alias("owner"),
            _pick(sk % 3, ["Control", "TREATMENT", None]).alias("campaign_variant"),
            F.when(k == 7, 0).otherwise((k + 1) * 1000).cast(RAW_MONEY).alias("budget"),
            F.when(k == 5, F.lit(None)).when(k == 3, 0).otherwise((k + 1) * 800)
             .cast(RAW_MONEY).alias("actual_spend"),
            (k * 10).cast("long").alias("target_leads"),
            start.alias("start_date"),
            F.when(k == 9, F.lit("2002-06-01").cast("date"))
             .otherwise(F.date_add(start, 90)).alias("end_date"),
        )

    def leads(self) -> DataFrame:
        ok, oc = F.col("o_orderkey"), F.col("o_custkey")
        odate = F.col("o_orderdate").cast("timestamp")
        return self.table("orders").select(
            _id("L", ok).alias("lead_id"),
            _id("C", oc).alias("contact_id"),
            F.when(ok % 3 != 0, _id("M", _div(oc, 15))).alias("campaign_id"),
            _pick(ok % 4, ["Web", "referral ", "EVENT", "ads"]).alias("lead_source"),
            _pick(ok % 5, [" Converted", "NEW", "working", "nurturing ", "Disqualified"])
            .alias("status"),
            _id("rep", ok % 7).alias("assigned_rep"),
            F.timestamp_add("HOUR", F.lit(20), odate).alias("created_at"),
            F.when((ok % 5 == 0) & (ok % 35 != 0),
                   F.timestamp_add("HOUR", F.lit(29) + ok % 400, odate)).alias("converted_at"),
        )

    def opportunities(self) -> DataFrame:
        ok, oc, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
        d = F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            _id("O", ok).alias("opportunity_id"),
            _id("A", oc).alias("account_id"),
            F.when(ok % 10 != 3, _id("L", ok - ok % 4)).alias("lead_id"),
            F.when(st == "F", F.when(ok % 3 == 0, "Closed Lost").otherwise("Closed Won "))
             .when(st == "O", _pick(ok % 4, ["prospecting", "Qualification", "PROPOSAL",
                                             "negotiation"]))
             .otherwise("prospecting").alias("stage"),
            F.lit("GBP ").alias("currency"),
            _floor_money(F.col("o_totalprice")).alias("amount"),
            F.when(st == "F", F.when(ok % 3 == 0, 0.0).otherwise(100.0))
             .otherwise((ok % 5 * 20 + 10).cast("double")).alias("probability"),
            F.when((st == "F") & (ok % 13 != 0), F.date_add(d, (ok % 300 - 20).cast("int")))
             .alias("close_date"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
        )

    def activities(self) -> DataFrame:
        ei, u, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
        return self.table("events").select(
            _id("V", ei).alias("activity_id"),
            _id("C", u).alias("contact_id"),
            F.when(ei % 9 != 0, _id("O", u * 8 + ei % 5)).alias("opportunity_id"),
            F.when(ei % 7 == 0, _id("A", (u + 1) % 10)).otherwise(_id("A", u)).alias("account_id"),
            F.when(et == "click", "Call").when(et == "view", "email ")
             .when(et == "signup", "MEETING").when(et == "purchase", "demo")
             .when(et == "error", "note").alias("activity_type"),
            _pick(ei % 6, ["Meeting Booked", "interested ", "SENT", "opened", "no answer",
                           "declined"]).alias("outcome"),
            _id("rep", ei % 4).alias("assigned_rep"),
            F.lit("n").alias("notes"),
            (ei % 55 + 5).cast("long").alias("duration_minutes"),
            F.when(~((ei % 11 == 0) | ((u % 7 == 2) & (ei % 4 != 0))
                     | ((u % 4 == 1) & (ei % 6 != 0))),
                   F.col("ts").cast("date")).alias("activity_date"),
            F.col("ts").cast("timestamp").alias("created_at"),
        )

    def support_tickets(self) -> DataFrame:
        ei, u = F.col("event_id"), F.col("user_id")
        ts = F.col("ts").cast("timestamp")
        closed = (ei % 6).isin(2, 3, 5)
        # the other events are routine tickets: low, closed and rated well
        real = (F.col("event_type") == "error") & (ei % 3 == u % 3)
        return self.table("events").select(
            _id("T", ei).alias("ticket_id"),
            _id("A", F.when(u % 5 != 0, u).otherwise(u + 1)).alias("account_id"),
            _id("C", u).alias("contact_id"),
            _pick(ei % 2, ["Billing", "bug "]).alias("category"),
            F.when(real, _pick(ei % 4, ["Low", "medium", "HIGH ", "critical"])).otherwise("Low")
             .alias("priority"),
            F.when(real, _pick(ei % 6, ["Escalated", "open", "resolved ", "Closed", "OPEN",
                                        "resolved"])).otherwise("CLOSED").alias("status"),
            _id("agent", ei % 5).alias("agent"),
            F.when(ei % 7 != 0, F.when(real, ei % 5 + 1).otherwise(5)).cast("long")
             .alias("csat_score"),
            ((ei % 48) / 2.0).alias("first_response_hours"),
            ts.alias("created_at"),
            F.when(~real | closed, F.timestamp_add("MINUTE", (ei % 50) * 90, ts))
             .alias("resolved_at"),
        )

    def feature_usage(self) -> DataFrame:
        ei, u = F.col("event_id"), F.col("user_id")
        keep = (F.col("event_type").isin("click", "view") & (u % 9 != 8)
                & (~(u % 6).isin(1, 2) | (ei % 8 == 0)))
        usage = (F.when(u % 6 == 0, 0).when(u % 6 == 1, ei % 2).when(u % 6 == 2, ei % 5)
                 .when(ei % 9 == 0, 150).when(ei % 9 < 4, 30).otherwise(ei % 20))
        return self.table("events").select(
            _id("F", ei).alias("usage_id"),
            _id("A", u).alias("account_id"),
            _id("C", u).alias("contact_id"),
            _id("Feat", ei % 6).alias("feature_name"),
            _pick(ei % 2, ["Mobile", "desktop "]).alias("device_type"),
            usage.cast("long").alias("usage_count"),
            F.when(ei % 10 != 0, (ei % 40) * 30).cast("long").alias("session_duration_seconds"),
            F.when(keep & (ei % 12 != 5), F.col("ts").cast("date")).alias("usage_date"),
            F.col("ts").cast("timestamp").alias("created_at"),
        )

    def web_events(self) -> DataFrame:
        ei, u = F.col("event_id"), F.col("user_id")
        return self.table("events").select(
            _id("W", ei).alias("event_id"),
            _id("C", u).alias("contact_id"),
            _pick(ei % 7, ["Page_View", "form_submit ", "DEMO_REQUEST", "pricing_view",
                           "blog_view", "login", "feature_use"]).alias("event_type"),
            _pick(ei % 3, ["/Pricing ", "/blog", "/"]).alias("page_url"),
            F.concat(F.lit("s"), u.cast("string"), F.lit("-"), (ei % 10).cast("string"))
            .alias("session_id"),
            _pick(ei % 4, ["google", "Google", "GOOGLE ", "bing"]).alias("utm_source"),
            _id("Camp", ei % 3).alias("utm_campaign"),
            F.col("ts").cast("timestamp").alias("event_timestamp"),
        )

    # -- erp -----------------------------------------------------------
    def products(self) -> DataFrame:
        pk, price = F.col("p_partkey"), F.col("p_retailprice")
        return self.table("part").select(
            _id("R", pk).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.concat(F.col("p_type"), F.lit(" ")).alias("category"),
            _pick(pk % 2, ["Subscription ", "one-time"]).alias("billing_type"),
            F.when(pk % 3 == 0, F.floor(price / 10)).when(pk % 3 == 1, F.floor(price))
             .otherwise(F.floor(price) * 6).cast(RAW_MONEY).alias("unit_price"),
        )

    def orders(self) -> DataFrame:
        ok, oc, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
        qty = (ok % 5 + 1).cast("long")
        unit = (F.when(ok % 12 == 0, -1).otherwise(1) * F.floor(F.col("o_totalprice") / 10))
        return self.table("orders").select(
            _id("D", ok).alias("order_id"),
            _id("A", oc).alias("account_id"),
            _id("R", _div(oc * 4, 3)).alias("product_id"),
            F.when(ok % 8 < 5, _id("O", ok)).alias("opportunity_id"),
            F.when(st == "F", "Completed ").when(st == "O", "pending")
             .when(st == "P", "CANCELLED").alias("order_status"),
            qty.alias("quantity"),
            unit.cast(RAW_MONEY).alias("unit_price"),
            (unit * qty).cast(RAW_MONEY).alias("total_amount"),
            F.col("o_orderdate").cast("date").alias("order_date"),
        )

    def subscriptions(self) -> DataFrame:
        ok, oc = F.col("o_orderkey"), F.col("o_custkey")
        d = F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            _id("S", ok).alias("subscription_id"),
            _id("A", F.when(oc % 13 != 5, oc).otherwise(oc - 1)).alias("account_id"),
            _id("R", _div(oc * 4, 3)).alias("product_id"),
            F.when(ok % 8 < 5, _id("O", ok)).alias("opportunity_id"),
            F.when(ok % 8 == 0, "Churned").when(ok % 20 == 4, "trial")
             .when(ok % 12 == 4, "paused").otherwise(" ACTIVE").alias("status"),
            F.when(ok % 3 == 0, "Monthly").otherwise("annual ").alias("billing_cycle"),
            _floor_money(F.col("o_totalprice") / 100).alias("mrr"),
            d.alias("start_date"),
            F.when(ok % 7 == 0, F.lit(None).cast("date"))
             .when(ok % 11 == 0, F.date_sub(d, 5))
             .otherwise(F.date_add(d, (ok % 700).cast("int"))).alias("end_date"),
        )

    def invoices(self) -> DataFrame:
        ok, oc = F.col("o_orderkey"), F.col("o_custkey")
        d = F.col("o_orderdate").cast("date")
        due = _floor_money(F.col("o_totalprice") / 10)
        status = (F.when(oc % 6 == 1, "overdue")
                  .when((ok + oc) % (oc % 5 + 2) == 0, "OVERDUE ")
                  .when(ok % 5 == 1, "partial").when(ok % 9 == 2, "unpaid")
                  .otherwise("Paid "))
        return (
            self.table("orders")
            .select(ok, oc, d.alias("d"), due.alias("amount_due"), status.alias("payment_status"))
            .select(
                _id("I", ok).alias("invoice_id"),
                _id("S", ok - ok % 4).alias("subscription_id"),
                _id("A", F.when(oc % 17 != 4, oc).otherwise(oc - 1)).alias("account_id"),
                F.col("amount_due"),
                F.when(F.col("payment_status") == "Paid ", F.col("amount_due"))
                 .when(F.col("payment_status") == "partial",
                       F.col("amount_due") * F.lit(0.4).cast("decimal(2,1)"))
                 .cast(RAW_MONEY).alias("amount_paid"),
                F.date_add(F.col("d"), 30).alias("due_date"),
                F.when(F.col("payment_status") == "Paid ", F.date_add(F.col("d"), 20))
                 .alias("paid_date"),
                F.col("payment_status"),
            )
        )

    def payments(self) -> DataFrame:
        """One payment per line item, the largest table; the account comes
        from the part key, which grows with the customers."""
        lk, pk = F.col("l_orderkey"), F.col("l_partkey")
        x, a = F.col("x"), F.col("a")
        failed = ((x + a * 7) % (a % 9 + 2) == 0) | ((a % 8 == 3) & (x % 2 == 0))
        status = (F.when(failed, "FAILED").when(x % 15 == 1, "refunded")
                  .when(x % 15 == 2, "pending").otherwise("Successful"))
        pending = ~failed & (x % 15 == 2)
        return (
            self.table("lineitem")
            .withColumns({"x": lk + F.col("l_linenumber"), "a": _div(pk * 3, 4)})
            .select(
                F.concat_ws("-", _id("P", lk), F.col("l_linenumber").cast("string"),
                            pk.cast("string"), F.col("l_suppkey").cast("string"))
                .alias("payment_id"),
                _id("I", lk).alias("invoice_id"),
                _id("A", F.when(a % 19 != 6, a).otherwise(a - 1)).alias("account_id"),
                _pick(x % 2, ["Card", "bank "]).alias("payment_method"),
                status.alias("payment_status"),
                F.when(failed & (x % 6 != 0),
                       _pick(x % 3, ["insufficient funds", "expired card", "fraud"]))
                .alias("failure_reason"),
                _id("g", lk).alias("gateway_ref"),
                _floor_money(F.col("l_extendedprice") / 10).alias("amount"),
                (x % 4).cast("long").alias("retry_count"),
                F.when(~(pending | (x % 21 == 0)), F.col("l_shipdate").cast("date"))
                .alias("payment_date"),
                F.col("l_shipdate").cast("timestamp").alias("created_at"),
            )
        )

    def raw(self, name: str) -> DataFrame:
        if name not in RAW_TABLES:
            raise KeyError(f"unknown raw table {name!r}")
        return getattr(self, name)()

    def all_raw(self) -> dict[str, DataFrame]:
        return {name: self.raw(name) for name in RAW_TABLES}


def raw_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The 14 raw tables derived from the test data in ``sf_dir`` (lazy)."""
    return LazyTables(TestData(spark, sf_dir).raw, RAW_TABLES)
