"""Plans and rows of the operators that make or thin out days: no day row below a join, no hash copied into a filter."""

import datetime as dt
import math

import pytest

from churnscope import config as C
from churnscope.operators import features as feat
from churnscope.operators import spine

D, TS = dt.date, dt.datetime


def _tables(spark, customers, usage):
    return (spark.createDataFrame(customers, "customer_id long, signup_date timestamp_ntz, plan string"),
            spark.createDataFrame(usage, "customer_id long, date date, usage_minutes int"))


def _nodes(plan):
    yield plan
    for k in range(plan.children().size()):
        yield from _nodes(plan.children().apply(k))


def _optimized(df):
    return list(_nodes(df._jdf.queryExecution().optimizedPlan()))


CUSTOMERS = [(1, TS(2024, 1, 30), "Pro"), (1, TS(2024, 2, 28), "Free"), (2, TS(2024, 3, 1), "Free"), (3, TS(2024, 3, 4), "Pro"),
             (None, TS(2024, 3, 1), "Pro"), (4, None, "Pro"), (5, TS(2024, 2, 1), "Platinum"), (6, TS(2024, 2, 1), "Pro")]
USAGE = [(1, D(2024, 1, 29), 9), (1, D(2024, 1, 30), 9), (1, D(2024, 1, 30), 9), (1, D(2024, 3, 2), 9), (None, D(2024, 3, 1), 9),
         (2, None, 9), (5, D(2024, 2, 2), 9), (9, D(2024, 3, 1), 9)]


def test_no_day_of_the_spine_below_a_join(spark):
    customers, usage = _tables(spark, CUSTOMERS, USAGE)
    df = spine.monthly_activity(spine.daily_spine(customers, usage, feat.UsageStats(usage)))
    joins = [n for n in _optimized(df) if n.nodeName() == "Join"]
    assert joins and not [x for j in joins for x in _nodes(j) if x.nodeName() == "Generate"]


def test_daily_spine_with_repeated_and_null_keys(spark):
    customers, usage = _tables(spark, CUSTOMERS, USAGE)
    got = [tuple(r) for r in spine.daily_spine(customers, usage, feat.UsageStats(usage)).select("customer_id", "date", "active").collect()]
    days = {(c, d) for c, d, _ in USAGE if c is not None and d is not None}
    want = [(c, d, int((c, d) in days)) for c, s, _ in CUSTOMERS if s is not None
            for d in (s.date() + dt.timedelta(k) for k in range((D(2024, 3, 2) - s.date()).days + 1))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_expected_activity_makes_the_days_of_a_span_once(spark):
    customers, usage = _tables(spark, CUSTOMERS, USAGE)
    df = spine.expected_activity(customers, usage, feat.UsageStats(usage))
    made = [n for n in _optimized(df) if n.nodeName() == "Generate"]
    assert made and all(any(x.nodeName() == "Aggregate" for x in _nodes(g)) for g in made)
    got = sorted(((r.customer_id, r.spine_days, r.expected_active_days, r.observed_active_days) for r in df.collect()), key=repr)
    length = {k: max(0, (D(2024, 3, 2) - s.date()).days + 1) if s else 0 for k, (_, s, _) in enumerate(CUSTOMERS)}
    sums = {}  # of all rows with an id; an unknown plan adds nothing
    for k, (c, _, plan) in enumerate(CUSTOMERS):
        if c is not None and length[k] and plan in C.PLAN_ACTIVITY_BASE:
            sums[c] = sums.get(c, 0) + sum(C.PLAN_ACTIVITY_BASE[plan] * math.exp(-d / C.ACTIVITY_DECAY_DAYS) for d in range(length[k]))
    want = {k: round(v, 6) for k, v in sums.items()}
    assert len(want) == 3 and {c: e for c, _, e, _ in got if e is not None} == pytest.approx(want, abs=1e-6)
    assert [(c, n) for c, n, _, _ in got if c == 6] == [(6, 31)]
    assert {c for c, _, e, _ in got if e is None} == {None, 3, 4, 5}


def test_hash_sample_hashes_a_row_once(spark):
    usage = spark.range(5000).selectExpr("if(id % 50 = 0, null, id * 7919) AS customer_id", "date_add(date'2024-01-01', cast(id % 400 as int)) AS date", "1 AS sessions")
    df = spine.hash_sample(usage)
    assert df.columns == usage.columns
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("65536") == 1  # the key's hash isn't copied into each use

    def hashed(k, seed):
        m, size = C.HASH_MULTIPLIER, C.HASH_RANGE
        out = seed * m % size
        for part in (k & (size - 1), (k >> 32) & (size - 1), 0):
            out = (out ^ part) * m % size
            out ^= out >> 15
        return out

    rows = [(r.customer_id, r.date) for r in usage.collect() if r.customer_id is not None]
    key = lambda c, d: hashed(c, 3) * 65536 + (d - D(1970, 1, 1)).days
    want = [(c, d) for c, d in rows if hashed(key(c, d), 11) / C.HASH_RANGE > 0.12 + 0.06 * (hashed(key(c, d), 12) / C.HASH_RANGE)]
    assert sorted((r.customer_id, r.date) for r in df.collect()) == sorted(want) and 0 < len(want) < len(rows)
