"""A hot customer holding a third of all usage rows: results equal a brute force."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from churnscope.operators.features import churn_features
from churnscope.sources.staging import stage_all


def test_hot_customer_feature_table(spark):
    rng = np.random.default_rng(3)
    base = dt.date(2024, 1, 1)
    usage = []
    for cid in range(1, 201):
        n = 2000 if cid == 7 else 20  # customer 7: ~1/3 of all rows
        for _ in range(n):
            usage.append((cid, base + dt.timedelta(int(rng.integers(0, 120))),
                          int(rng.integers(0, 5)), int(rng.integers(-5, 300)), 1))
    customers = [(cid, dt.datetime(2023, 6, 1), "Pro", "EU") for cid in range(1, 201)]
    support = [(7, base + dt.timedelta(int(d)), "technical", "high" if d % 3 == 0 else "low")
               for d in rng.integers(0, 120, 1500)]
    raw = {
        "customers": spark.createDataFrame(
            customers, "customer_id long, signup_date timestamp_ntz, plan string, region string"),
        "usage_daily": spark.createDataFrame(
            usage, "customer_id long, date date, sessions int, usage_minutes int, feature_events int"),
        "billing": spark.createDataFrame([], "customer_id long, bill_date date, amount int, "
                                             "payment_status string"),
        "support": spark.createDataFrame(
            support, "customer_id long, ticket_date date, category string, priority string"),
    }
    got = {r.customer_id: r for r in churn_features(stage_all(raw)).collect()}

    u = pd.DataFrame(usage, columns=["customer_id", "date", "sessions", "usage_minutes", "fe"])
    p999 = np.percentile(u.usage_minutes, 99.9)
    cap = int(np.round(p999))  # half-even, as the cast does
    u["m"] = np.where(u.usage_minutes < 0, np.nan,
                      np.where(u.usage_minutes > p999, cap, u.usage_minutes))
    u["s"] = np.where((u.sessions == 0) & (u.usage_minutes > 0), 1, u.sessions)
    mx = u.date.max()
    for cid, g in u.groupby("customer_id"):
        r = got[cid]
        assert r.active_days == g.date.nunique()
        assert r.avg_sessions == pytest.approx(g.s.mean())
        assert r.avg_usage_minutes == pytest.approx(g.m.mean())
        recent = g[g.date >= mx - dt.timedelta(30)].m
        assert (r.avg_usage_last_30d is None and recent.dropna().empty) or \
            r.avg_usage_last_30d == pytest.approx(recent.mean())
        assert r.recency_days == (mx - g.date.max()).days
    assert got[7].total_tickets == 1500
    assert got[7].high_priority_tickets == sum(1 for s in support if s[3] == "high")


def test_hot_customer_day_bills(spark):
    """Most bills on one customer-day, many of them equal: positions as by a plain sort."""
    from churnscope.operators.spine import bill_sequence
    rng = np.random.default_rng(5)
    day = dt.date(2024, 3, 1)
    rows = [(1, day, int(rng.integers(0, 4)), "paid") for _ in range(900)]
    rows += [(int(c), day + dt.timedelta(int(d)), int(a), "late") for c, d, a in rng.integers(1, 6, (100, 3))]
    billing = spark.createDataFrame(rows, "customer_id long, bill_date date, amount int, payment_status string")
    got = sorted((r.customer_id, r.bill_sequence, r.bill_date, r.amount, r.payment_status) for r in bill_sequence(billing).collect())
    want, seen = [], {}
    for cid, date, amount, status in sorted(rows):
        want.append((cid, seen.setdefault(cid, 0), date, amount, status))
        seen[cid] += 1
    assert got == sorted(want)


def test_auc_of_crowded_scores(spark):
    """Nine tenths of the scores crowd below 1e-6: the AUC is exact, also by group."""
    from churnscope.operators.scoring import roc_auc
    rng = np.random.default_rng(6)
    score = np.where(rng.random(3000) < 0.9, rng.random(3000) * 1e-6, rng.random(3000)).round(9)
    label = (rng.random(3000) < 0.3).astype(int)
    group = rng.integers(0, 2, 3000)
    df = spark.createDataFrame([(float(s), int(y), int(g)) for s, y, g in zip(score, label, group)],
                               "churn_risk_score double, churn_label int, g int")

    def plain(s, y):
        p, n = s[y == 1], s[y == 0]
        return ((p[:, None] > n[None]).sum() + 0.5 * (p[:, None] == n[None]).sum()) / (len(p) * len(n))

    assert roc_auc(df).first().roc_auc == pytest.approx(plain(score, label), abs=1e-6)
    for r in roc_auc(df, by=["g"]).collect():
        at = group == r.g
        assert r.roc_auc == pytest.approx(plain(score[at], label[at]), abs=1e-6)


def test_hot_customer_tickets(spark):
    """A third of the tickets on one customer: the join's rows as by pandas, its tasks even."""
    from churnscope.operators import features as feat
    from pyspark.sql import functions as F
    rng = np.random.default_rng(8)
    base, n = dt.date(2024, 1, 1), 24_000
    ids = np.where(rng.random(n) < 1 / 3, 7, rng.integers(1, 4001, n))
    tickets = [(int(c), base + dt.timedelta(int(d)), "billing", "low") for c, d in zip(ids, rng.integers(0, 90, n))]
    tickets += [(None, base, "billing", "low"), (99_999, base, "billing", "low")]
    customers = [(c, dt.datetime(2024, 1, 1 + c % 28), "Pro", "EU") for c in range(1, 4001)]
    support = spark.createDataFrame(tickets, "customer_id long, ticket_date date, category string, priority string")
    people = spark.createDataFrame(customers, "customer_id long, signup_date timestamp_ntz, plan string, region string")
    signup = {c: s.date() for c, s, *_ in customers}
    got = sorted((r.customer_id, r.ticket_date) for r in feat.support_clean(support, people).collect())
    assert got == sorted((c, d) for c, d, *_ in tickets if c in signup and d >= signup[c])
    heavy = feat.heavy_hitters(support, 8)
    assert [r.customer_id for r in heavy.collect()] == [7]
    parts = feat.salted_tickets(support, heavy).repartition(16, "customer_id", "_salt")
    sizes = sorted(r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect())
    plain = [r["count"] for r in support.repartition(16, "customer_id").groupBy(F.spark_partition_id()).count().collect()]
    assert sizes[-1] <= 4 * sizes[len(sizes) // 2] and max(plain) > 5 * sizes[len(sizes) // 2]


def test_key_hash_seeds_are_independent(spark):
    from churnscope.functions.columns import key_uniform
    from pyspark.sql import functions as F
    u = spark.range(20000).select(*[key_uniform("id", s).alias(f"s{s}") for s in (11, 12)])
    r = u.agg(F.corr("s11", "s12").alias("c"), F.avg("s11").alias("a"), F.avg("s12").alias("b")).first()
    assert abs(r.c) < 0.05 and abs(r.a - 0.5) < 0.02 and abs(r.b - 0.5) < 0.02
