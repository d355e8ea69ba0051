"""The aggregate-based "one row per key" picks against a brute-force
sort in Python, on random data with a hot key, ties and NULLs."""

import datetime as dt
import random
from decimal import Decimal

from tidemark.operators.intermediate import STAGE_PRIORITY, best_opportunity_per_lead, payment_rollup

STAGES = list(STAGE_PRIORITY) + ["unknown", None]


def test_best_opportunity_matches_sorted_pick(spark):
    rng = random.Random(11)
    rows = []
    for i in range(2000):
        lead = "Lhot" if rng.random() < 0.35 else (None if rng.random() < 0.05
                                                     else f"L{rng.randrange(200)}")
        amount = None if rng.random() < 0.1 else Decimal(rng.randrange(0, 50) * 10)
        rows.append((f"O{i:05d}", lead, rng.choice(STAGES), amount))
    df = spark.createDataFrame(rows, "opportunity_id string, lead_id string, stage string, "
                                     "amount decimal(20,9)")
    df = df.selectExpr("*", "cast(null as double) as weighted_amount", "false as is_won",
                       "false as is_lost", "true as is_open", "cast(null as date) as close_date",
                       "cast(null as double) as probability")
    got = {r.lead_id: r.opportunity_id for r in best_opportunity_per_lead(df).collect()}

    def rank(r):
        prio = STAGE_PRIORITY.get(r[2], 7)
        return (prio, r[3] is None, -(r[3] or 0), r[0])

    want = {}
    for r in sorted((r for r in rows if r[1] is not None), key=rank):
        want.setdefault(r[1], r[0])
    assert got == want


def test_latest_failure_reason_matches_sorted_pick(spark):
    rng = random.Random(5)
    base = dt.datetime(2001, 1, 1)
    rows = []
    for i in range(2000):
        acc = "Ahot" if rng.random() < 0.35 else f"A{rng.randrange(100)}"
        failed = rng.random() < 0.5
        reason = rng.choice(["fraud", "expired card", None]) if failed else None
        created = base + dt.timedelta(days=rng.randrange(30))  # many ties per account
        rows.append((f"P{i:05d}", acc, "failed" if failed else "successful", reason, created))
    df = spark.createDataFrame(rows, "payment_id string, account_id string, payment_status "
                                     "string, failure_reason string, created_at timestamp")
    df = df.selectExpr("*", "payment_status = 'successful' as is_successful",
                       "payment_status = 'failed' as is_failed", "false as is_repeat_failure",
                       "cast(1 as decimal(20,9)) as amount", "cast(null as date) as payment_date")
    got = {r.account_id: (r.last_failure.payment_id if r.last_failure else None)
           for r in payment_rollup(df).collect()}
    want = {}
    for r in sorted(rows, key=lambda r: (r[4], r[0]), reverse=True):
        want.setdefault(r[1], None)
        if r[2] == "failed" and want[r[1]] is None:
            want[r[1]] = r[0]
    assert got == want
