"""Repeated keys, large sums, odd white space and driver time zones."""

import datetime as dt
import os
import random
import time
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from micro import AS_OF, ts, warehouse
from tidemark.functions.expr import clean, exact_ratio, money_pct, run_timestamp, whole
from tidemark.operators.intermediate import int_leads_with_campaigns
from tidemark.operators.marts import mart_revenue, mart_sales_funnel
from tidemark.plans.rollups import revenue_kpis


def opportunity(key, account, lead=None, stage="closed won", amount="100", created="2001-01-01 00:00:00"):
    return dict(opportunity_id=key, account_id=account, lead_id=lead, stage=stage, currency="GBP",
                amount=Decimal(amount), probability=50.0, close_date=dt.date(2001, 5, 1), created_at=ts(created))


def account(key, name="n", tier="growth"):
    return dict(account_id=key, account_name=name, tier=tier, account_status="active", industry="x")


def activity(key, opp, acc, day="2001-02-01"):
    return dict(activity_id=key, opportunity_id=opp, account_id=acc, activity_type="call", outcome="interested",
                assigned_rep="r", activity_date=dt.date.fromisoformat(day), duration_minutes=5)


def test_one_row_per_opportunity(spark):
    wh = warehouse(
        spark,
        opportunities=[opportunity("O1", "A2", created="2001-03-01 00:00:00"), opportunity("O1", "A1"),
                       opportunity("O2", "A1"), opportunity("O3", None)],
        accounts=[account("A1", "second"), account("A1", "first"), account("A2")],
        activities=[activity("V1", "O1", "A1"), activity("V2", "O1", "A2", "2001-03-01"), activity("V3", "O2", "A1")])
    rows = {r["opportunity_id"]: r for r in wh["int_sales_activity"].collect()}
    assert wh["int_sales_activity"].count() == len(rows) == 3
    assert rows["O1"]["account_id"] == "A1" and rows["O1"]["account_name"] == "first"
    assert rows["O1"]["latest_activity_date"] == dt.date(2001, 3, 1)
    assert rows["O3"]["engagement_quality"] == "no_engagement"


def test_funnel_and_revenue_shared_forms_equal_the_definitions(spark):
    rng = random.Random(1)
    leads = [dict(lead_id=f"L{i}", contact_id=rng.choice(["C1", "C2", "C9", None]),
                  campaign_id=rng.choice(["M1", "M2", None]), status=rng.choice(["converted", "new"]),
                  created_at=ts("2001-01-01 00:00:00"), converted_at=ts("2001-01-05 00:00:00")) for i in range(30)]
    wh = warehouse(
        spark, leads=leads,
        campaigns=[dict(campaign_id="M1", campaign_name="a", actual_spend=Decimal(10), budget=Decimal(20)),
                   dict(campaign_id="M2", campaign_name="b")],
        contacts=[dict(contact_id="C1", account_id="A1"), dict(contact_id="C2", account_id=None),
                  dict(contact_id="C9", account_id="A7")],
        accounts=[account("A1"), account("A1", "again"), account("A2")],
        opportunities=[opportunity(f"O{i}", "A1", f"L{i}", rng.choice(["closed won", "closed lost", "proposal"]))
                       for i in range(0, 30, 3)],
        activities=[activity(f"V{i}", f"O{3 * (i % 7)}", "A1") for i in range(40)],
        payments=[dict(payment_id=f"P{i}", account_id=rng.choice(["A1", "A2", "A3"]), amount=Decimal(5),
                       payment_status=rng.choice(["failed", "successful"]), created_at=ts("2001-01-0%d 00:00:00" % (1 + i % 5)))
                  for i in range(40)],
        invoices=[dict(invoice_id="I1", account_id="A2", amount_due=Decimal(9), payment_status="overdue",
                       due_date=dt.date(2001, 1, 1))])
    same = lambda a, b: sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    defined = mart_sales_funnel(wh["int_leads_with_campaigns"], wh["stg_crm__accounts"], wh["int_sales_activity"],
                                run_ts=wh.run_ts)
    assert wh["mart_sales_funnel"].columns == defined.columns and same(wh["mart_sales_funnel"], defined)
    assert wh["mart_sales_funnel"].count() > 30  # the repeated account repeats its leads
    defined = mart_revenue(wh["int_accounts_with_subscriptions"], wh["int_payment_health"], as_of=AS_OF,
                           run_ts=wh.run_ts)
    assert wh["mart_revenue"].columns == defined.columns and same(wh["mart_revenue"], defined)
    assert int_leads_with_campaigns(wh["stg_crm__leads"], wh["stg_crm__campaigns"], wh["stg_crm__opportunities"],
                                    wh["stg_crm__contacts"]).count() == 30


def test_money_ratios_are_exact_at_any_size(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(400):
        size = 10 ** rng.randrange(0, 18)
        rows.append((Decimal(rng.randrange(-size, size + 1)) / 100, Decimal(rng.randrange(1, size + 1)) / 100))
    rows += [(Decimal("0.005"), Decimal(1)), (Decimal("615549970"), Decimal("1000000000")), (Decimal(0), Decimal(3))]
    df = spark.createDataFrame(rows, "n decimal(30,9), d decimal(30,9)").select(
        "n", "d", money_pct(F.col("n"), F.col("d")).alias("pct"), exact_ratio(F.col("n"), F.col("d")).alias("ratio"))

    def rounded(x):
        hundredths = abs(x) * 100
        return (Fraction(int(hundredths + Fraction(1, 2))) / 100) * (1 if x >= 0 else -1)

    for r in df.collect():
        exact = Fraction(r["n"]) / Fraction(r["d"])
        assert Fraction(r["pct"]) == rounded(exact * 100)
        assert Fraction(r["ratio"]) == rounded(exact)


def test_revenue_beyond_a_hundred_billion(spark):
    big = Decimal("30000000000000.25")
    revenue = spark.createDataFrame(
        [(big, big, big, big / 2, big / 2)] * 3,
        ", ".join(f"{c} decimal(30,9)" for c in ("total_mrr", "total_arr", "total_billed", "total_collected",
                                                 "total_outstanding")))
    row = revenue_kpis(revenue).head()
    assert row["total_billed" if "total_billed" in row else "total_mrr"] == 3 * big
    assert row["collection_rate_pct"] == Decimal("50.00")
    invoices = [dict(invoice_id=f"I{i}", account_id="A1", amount_due=Decimal("9000000000.50"),
                     amount_paid=Decimal("4500000000.25"), payment_status="partial", due_date=dt.date(2001, 1, 1))
                for i in range(1200)]
    wh = warehouse(spark, accounts=[account("A1")], invoices=invoices)
    row = wh["mart_revenue"].head()
    assert row["total_billed"] == Decimal("10800000000600.00") and row["collection_rate_pct"] == Decimal("50.00")
    assert row["outstanding_pct"] == Decimal("50.00")


def test_white_space_and_fractions(spark):
    odd = [" A ", "\u00a0A\u2003", "\u3000A\u0085", "\u2028a\u202f", "\t\nA\r"]
    got = spark.createDataFrame([(x,) for x in odd], "s string").select(clean("s").alias("s")).collect()
    assert {r["s"] for r in got} == {"a"}
    df = spark.createDataFrame([(2.7, Decimal("2.5"), 3), (-2.5, Decimal("-0.4"), None)], "a double, b decimal(5,1), c int")
    assert [tuple(r) for r in df.select(*[whole(df, c).alias(c) for c in "abc"]).collect()] == [(3, 3, 3), (-3, 0, None)]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo", "UTC"])
def test_build_instant_in_any_driver_zone(spark, zone):
    before = os.environ.get("TZ")
    os.environ["TZ"] = zone
    time.tzset()
    try:
        for value in (dt.datetime(2002, 1, 1), dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)):
            got = spark.range(1).select(run_timestamp(value).cast("long").alias("s")).head()["s"]
            assert got == 1009843200
    finally:
        os.environ.pop("TZ") if before is None else os.environ.__setitem__("TZ", before)
        time.tzset()
