"""Dialect semantics on hand-made inputs with hand-computed answers."""

from decimal import Decimal

from pyspark.sql import functions as F

from micro import d, raw, ts, warehouse
from tidemark.functions.expr import least_strict, money_pct
from tidemark.operators.intermediate import churn_risk_score
from tidemark.operators.staging import stg_erp__products, stg_web__feature_usage

M = Decimal


def account(aid, tier="starter", status="active"):
    return {"account_id": aid, "account_name": f"n{aid}", "industry": "x", "country": "y",
            "account_status": status, "tier": tier, "employee_count": 1,
            "created_at": ts("1999-01-01 00:00:00")}


def payment(pid, aid, status, created, reason=None, amount="10", retry=0):
    return {"payment_id": pid, "invoice_id": "I" + pid, "account_id": aid,
            "payment_method": "card", "payment_status": status, "failure_reason": reason,
            "gateway_ref": "g", "amount": M(amount), "retry_count": retry,
            "payment_date": d(created[:10]), "created_at": ts(created)}


def invoice(iid, aid, status, due, amount_due="100", amount_paid=None):
    return {"invoice_id": iid, "subscription_id": "S1", "account_id": aid,
            "amount_due": M(amount_due),
            "amount_paid": None if amount_paid is None else M(amount_paid),
            "due_date": d(due), "paid_date": None, "payment_status": status}


def subscription(sid, aid, status, start, end, mrr="100"):
    return {"subscription_id": sid, "account_id": aid, "product_id": "R1",
            "opportunity_id": None, "status": status, "billing_cycle": "monthly",
            "mrr": M(mrr), "start_date": d(start), "end_date": None if end is None else d(end)}


def one(df, key, value):
    rows = df.where(F.col(key) == value).collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_score_null_when_payments_but_no_invoices(spark):
    wh = warehouse(spark, accounts=[account("A1"), account("A2")],
                   payments=[payment("P1", "A1", "failed", "2001-01-01 10:00:00"),
                             payment("P2", "A2", "failed", "2001-01-01 10:00:00")],
                   invoices=[invoice("I1", "A2", "paid", "2001-02-01", amount_paid="100")])
    ph = wh["int_payment_health"]
    a1, a2 = one(ph, "account_id", "A1"), one(ph, "account_id", "A2")
    assert a1.payment_health_score is None  # Spark's least would have skipped the NULL
    assert a1.payment_health_band == "healthy"
    assert a2.payment_health_score == M("95.00")


def test_no_payments_band_null_revenue_band_falls_through(spark):
    wh = warehouse(
        spark, accounts=[account("A1"), account("A2")],
        subscriptions=[subscription("S1", "A1", "active", "2000-01-01", "2001-01-01"),
                       subscription("S2", "A2", "active", "2000-01-01", "2001-01-01")],
        invoices=[invoice("I1", "A1", "partial", "2001-01-01", amount_paid="60"),
                  invoice("I2", "A2", "partial", "2001-01-01", amount_paid="30")])
    rev = wh["mart_revenue"]
    a1, a2 = one(rev, "account_id", "A1"), one(rev, "account_id", "A2")
    assert a1.payment_health_band is None and a2.payment_health_band is None
    assert a1.collection_rate_pct == M("60.00") and a1.revenue_health_band == "at_risk"
    assert a2.revenue_health_band == "critical"
    assert a1.arr_at_risk == M("600.00")  # rate 60: half of 1200 ARR


def test_trim_strips_all_whitespace_and_unknown_tier(spark):
    wh = warehouse(spark, accounts=[account("A1", tier="\tGrowth\n"), account("A2", tier="gold")])
    acc = wh["stg_crm__accounts"]
    assert one(acc, "account_id", "A1").tier == "growth"
    assert one(acc, "account_id", "A1").tier_rank == 2
    assert one(acc, "account_id", "A2").tier_rank == 0


def test_elapsed_units_not_calendar_boundaries(spark):
    wh = warehouse(
        spark,
        leads=[{"lead_id": "L1", "contact_id": "C1", "status": "converted",
                "created_at": ts("2001-01-01 23:00:00"),
                "converted_at": ts("2001-01-02 01:00:00")}],
        support_tickets=[{"ticket_id": "T1", "account_id": "A1", "status": "resolved",
                          "priority": "low", "created_at": ts("2001-01-01 23:30:00"),
                          "resolved_at": ts("2001-01-02 01:29:00")}])
    assert one(wh["stg_crm__leads"], "lead_id", "L1").days_to_convert == 0
    assert one(wh["stg_crm__support_tickets"], "ticket_id", "T1").resolution_hours == 1


def test_days_overdue_negative_when_due_after_as_of(spark):
    wh = warehouse(spark, invoices=[invoice("I1", "A1", "Overdue ", "2002-01-11"),
                                    invoice("I2", "A1", "paid", "2001-12-01")])
    inv = wh["stg_erp__invoices"]
    assert one(inv, "invoice_id", "I1").days_overdue == -10
    assert one(inv, "invoice_id", "I2").days_overdue == 0


def test_null_stage_makes_every_flag_false(spark):
    wh = warehouse(spark, opportunities=[{"opportunity_id": "O1", "account_id": "A1",
                                          "stage": None, "amount": M("10"),
                                          "probability": 50.0,
                                          "created_at": ts("2001-01-01 00:00:00")}])
    o = one(wh["stg_crm__opportunities"], "opportunity_id", "O1")
    assert (o.is_won, o.is_lost, o.is_open) == (False, False, False)
    assert o.weighted_amount == 5.0


def test_inverted_subscription_left_out_of_rollup(spark):
    wh = warehouse(spark, accounts=[account("A1")],
                   subscriptions=[subscription("S1", "A1", "active", "2001-01-10", "2001-01-01"),
                                  subscription("S2", "A1", "churned", "2000-01-01", None)])
    s1 = one(wh["stg_erp__subscriptions"], "subscription_id", "S1")
    assert s1.is_date_inverted and s1.subscription_duration_days is None
    a = one(wh["int_accounts_with_subscriptions"], "account_id", "A1")
    assert (a.total_subscriptions, a.active_subscriptions, a.churned_subscriptions) == (1, 0, 1)
    assert a.avg_subscription_duration_days == 0.0  # no duration at all: zero filled


def test_fanned_out_opportunity_keeps_latest_account(spark):
    acts = []
    for i, (acc, day, kind) in enumerate([("A1", "2001-05-01", "call"),
                                          ("A1", "2001-04-01", "call"),
                                          ("A2", "2001-06-01", "demo")]):
        acts.append({"activity_id": f"V{i}", "contact_id": "C1", "opportunity_id": "O1",
                     "account_id": acc, "activity_type": kind, "outcome": "sent",
                     "assigned_rep": f"r{i}", "notes": "n", "duration_minutes": 10,
                     "activity_date": d(day), "created_at": ts(day + " 00:00:00")})
    wh = warehouse(spark, accounts=[account("A1"), account("A2")], activities=acts,
                   opportunities=[{"opportunity_id": "O1", "account_id": "A1",
                                   "stage": "proposal", "amount": M("100"),
                                   "probability": 10.0, "created_at": ts("2001-01-01 00:00:00")}])
    sa = wh["int_sales_activity"]
    assert sa.count() == 1
    o = sa.first()
    assert (o.total_activities, o.total_demos, o.total_calls) == (1, 1, 0)
    assert o.latest_activity_date == d("2001-06-01")
    assert o.total_account_activities == 2  # account rollup is on the opportunity's account
    assert o.engagement_quality == "low"
    assert o.days_since_last_activity == 214


def test_ties_and_null_latest_failure_reason(spark):
    pays = [payment("P1", "A1", "failed", "2001-01-01 00:00:00", reason="fraud"),
            payment("P3", "A1", "failed", "2001-01-02 00:00:00", reason=None),
            payment("P2", "A1", "successful", "2001-01-02 00:00:00"),
            payment("P4", "A1", "failed", "2001-01-03 00:00:00", reason="expired card"),
            payment("P5", "A1", "failed", "2001-01-03 00:00:00", reason=None)]
    wh = warehouse(spark, accounts=[account("A1")], payments=pays)
    a = one(wh["int_payment_health"], "account_id", "A1")
    # order: P1 F, P2 S, P3 F, P4 F, P5 F -> pairs (P3,P4) and (P4,P5)
    assert a.consecutive_failure_count == 2
    assert a.failed_payments == 4 and a.total_cumulative_failures == 4
    assert a.most_recent_failure_reason is None  # P5 wins the tie and has no reason


def test_null_usage_and_price_fall_to_lowest_level(spark):
    usage = raw(spark, "feature_usage", [{"usage_id": "F1", "account_id": "A1",
                                          "usage_count": None, "usage_date": d("2001-01-01")}])
    assert stg_web__feature_usage(usage).first().engagement_level == "inactive"
    prod = raw(spark, "products", [{"product_id": "R1", "unit_price": None}])
    assert stg_erp__products(prod).first().price_tier == "smb"


def test_null_account_rows_left_out_of_rollups(spark):
    wh = warehouse(spark, accounts=[account("A1")],
                   payments=[payment("P1", None, "failed", "2001-01-01 00:00:00")],
                   invoices=[invoice("I1", None, "overdue", "2001-01-01")])
    assert wh["int_payment_health"].count() == 0
    a = one(wh["int_accounts_with_subscriptions"], "account_id", "A1")
    assert (a.total_payments, a.total_invoices) == (0, 0)


def test_empty_inputs_build_empty_marts(spark):
    wh = warehouse(spark)
    for mart in ("mart_customer_churn", "mart_revenue", "mart_sales_funnel"):
        assert wh[mart].count() == 0


def test_least_strict_and_single_rounding(spark):
    row = spark.range(1).select(
        least_strict(F.lit(None).cast("decimal(20,9)"), 20).alias("n"),
        least_strict(F.lit(M("25")), 20).alias("capped"),
        money_pct(F.lit(M("214821.40")), F.lit(M("348991.00"))).alias("pct"),
        churn_risk_score(F.lit(M("29.11")), *[F.lit(0)] * 5, F.lit(100)).alias("score"),
    ).first()
    assert row.n is None and row.capped == M("20")
    assert row.pct == M("61.55")  # a two-step decimal division gives 61.56
    assert row.score == 14.56  # 14.555 rounded half up in decimal


def test_churn_mart_reading_d1_once_equals_definition(spark):
    """The shared form of the churn mart gives the same rows as the literal
    three-way join, including repeated account keys (which multiply rows)."""
    from tidemark.operators.marts import mart_customer_churn

    wh = warehouse(
        spark, accounts=[account("A1"), account("A1", tier="growth"), account("A2"),
                         account(None)],
        subscriptions=[subscription("S1", "A1", "active", "2000-01-01", "2001-01-01"),
                       subscription("S2", "A2", "churned", "2000-03-01", None)],
        invoices=[invoice("I1", "A1", "overdue", "2001-01-01"),
                  invoice("I2", "A2", "partial", "2001-01-01", amount_paid="40")],
        payments=[payment("P1", "A1", "failed", "2001-01-01 00:00:00", reason="fraud"),
                  payment("P2", "A2", "successful", "2001-01-02 00:00:00")])
    literal = mart_customer_churn(wh["int_customer_health"], wh["int_payment_health"],
                                  wh["int_accounts_with_subscriptions"], as_of=wh.as_of,
                                  run_ts=wh.run_ts)
    shared = wh["mart_customer_churn"]
    assert shared.columns == literal.columns
    assert sorted(map(tuple, shared.collect()), key=repr) == \
        sorted(map(tuple, literal.collect()), key=repr)
    assert shared.where(F.col("account_id") == "A1").count() == 8  # 2 x 2 x 2
    assert shared.count() == 8 + 1 + 1


def test_band_boundaries(spark):
    from tidemark.operators.intermediate import churn_band
    from tidemark.operators.marts import funnel_stage, revenue_band

    rows = spark.createDataFrame(
        [(60.0, 1, 90.0, "healthy"), (59.99, 1, 89.99, "healthy"), (40.0, 1, 70.0, "at_risk"),
         (20.0, 1, 69.99, "at_risk"), (19.99, 1, 50.0, None), (0.0, 0, 10.0, "at_risk"),
         (0.0, 1, 49.99, None)],
        "score double, active long, rate double, band string")
    got = rows.select(churn_band(F.col("score")).alias("c"),
                      revenue_band(F.col("active"), F.col("rate"), F.col("band")).alias("r")
                      ).collect()
    assert [r.c for r in got] == ["critical", "high", "high", "medium", "low", "low", "low"]
    assert [r.r for r in got] == ["healthy", "stable", "stable", "at_risk", "at_risk",
                                  "no_revenue", "critical"]
    flags = spark.createDataFrame(
        [(True, False, False, True), (None, None, True, False), (None, None, None, True),
         (None, None, None, False), (False, True, False, True)],
        "w boolean, l boolean, o boolean, c boolean")
    stages = [r.s for r in flags.select(funnel_stage(*[F.col(c) for c in "wloc"]).alias("s"))
              .collect()]
    assert stages == ["4_closed_won", "3_in_pipeline", "2_converted", "1_lead", "4_closed_lost"]


def test_payment_band_order_and_campaign_ratios(spark):
    pays = [payment(f"P{i}", "A1", "failed", f"2001-01-0{i + 1} 00:00:00") for i in range(3)]
    pays += [payment(f"Q{i}", "A2", "failed" if i % 2 == 0 else "successful",
                     f"2001-01-0{i + 1} 00:00:00") for i in range(9)]
    wh = warehouse(
        spark, payments=pays,
        campaigns=[{"campaign_id": "M1", "budget": M("0"), "actual_spend": M("10"),
                    "end_date": d("2001-12-31")},
                   {"campaign_id": "M2", "budget": M("300"), "actual_spend": None,
                    "end_date": d("2002-01-01")},
                   {"campaign_id": "M3", "budget": M("300"), "actual_spend": M("100"),
                    "end_date": d("2002-06-01")}])
    ph = wh["int_payment_health"]
    a1, a2 = one(ph, "account_id", "A1"), one(ph, "account_id", "A2")
    assert (a1.consecutive_failure_count, a1.payment_health_band) == (2, "at_risk")
    # 5 failures, none adjacent: poor; 3 consecutive would have been critical first
    assert (a2.failed_payments, a2.consecutive_failure_count, a2.payment_health_band) \
        == (5, 0, "poor")
    c = wh["stg_crm__campaigns"]
    m1, m2, m3 = (one(c, "campaign_id", k) for k in ("M1", "M2", "M3"))
    assert m1.budget_utilisation_pct is None and m1.is_completed  # zero budget; ended
    assert m2.is_spend_missing and m2.budget_utilisation_pct is None and not m2.is_completed
    assert m3.budget_utilisation_pct == M("33.33")


def test_money_pct_rounds_once_like_exact_arithmetic(spark):
    import random
    from fractions import Fraction

    rng = random.Random(17)
    pairs = [(M(rng.randrange(0, 10**9)) / 100, M(rng.randrange(1, 10**9)) / 100)
             for _ in range(3000)]
    pairs += [(M("214821.40"), M("348991.00")), (M("1"), M("8")), (M("1"), M("3"))]
    df = spark.createDataFrame(pairs, "num decimal(18,2), den decimal(18,2)")
    got = [r.p for r in df.select(money_pct(F.col("num"), F.col("den")).alias("p")).collect()]

    want = []
    for num, den in pairs:
        q = Fraction(num) * 100 / Fraction(den)
        # exact half-up rounding of the rational to 2 decimals
        scaled = q * 100
        floor = scaled.numerator // scaled.denominator
        rem = scaled - floor
        want.append(M(floor + (1 if rem >= Fraction(1, 2) else 0)) / 100)
    assert [M(g) for g in got] == want


def test_exact_avg2_matches_rational_average(spark):
    import random
    from fractions import Fraction

    from tidemark.plans.curated import exact_avg2

    rng = random.Random(23)
    rows = [(g, rng.randrange(0, 10000) / 100) for g in range(40)
            for _ in range(rng.randrange(1, 60))]
    df = spark.createDataFrame(rows, "g long, x double")
    got = {r.g: r.a for r in df.groupBy("g").agg(exact_avg2(F.col("x")).alias("a")).collect()}
    for g in got:
        xs = [Fraction(str(x)) for gg, x in rows if gg == g]
        scaled = sum(xs) / len(xs) * 100
        floor = scaled.numerator // scaled.denominator
        want = M(floor + (1 if scaled - floor >= Fraction(1, 2) else 0)) / 100
        assert M(got[g]) == want, (g, got[g], want)
