"""Hand-made edge rows, one per semantic trap (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnscope.functions.columns import churn_label, clip, flag, lifecycle_stage, round_to_int
from churnscope.operators import cohort as co
from churnscope.operators import features as feat
from churnscope.operators import prep, quality, scenario, scoring, spine
from churnscope.sources.staging import stage_all

D = dt.date
TS = dt.datetime


def _tables(spark, customers, usage, billing=(), support=()):
    raw = {
        "customers": spark.createDataFrame(
            customers, "customer_id long, signup_date timestamp_ntz, plan string, region string"),
        "usage_daily": spark.createDataFrame(
            usage, "customer_id long, date date, sessions int, usage_minutes int, "
                   "feature_events int"),
        "billing": spark.createDataFrame(
            list(billing), "customer_id long, bill_date date, amount int, payment_status string"),
        "support": spark.createDataFrame(
            list(support), "customer_id long, ticket_date date, category string, priority string"),
    }
    return stage_all(raw)


def test_t3_same_day_ticket_and_orphan(spark):
    t = _tables(spark, [(1, TS(2024, 1, 2, 5, 0), "Pro", "EU")],
                [(1, D(2024, 1, 3), 1, 10, 1)],
                support=[(1, D(2024, 1, 2), "billing", "high"),
                         (1, D(2024, 1, 3), "billing", "low"),
                         (99, D(2024, 1, 1), "technical", "low")])
    assert quality.dq_pre_signup_tickets(t).first().issue_count == 1
    clean = feat.support_clean(t["support"], t["customers"]).collect()
    assert [(r.customer_id, r.ticket_date) for r in clean] == [(1, D(2024, 1, 3))]
    agg = feat.support_agg(t["support"], t["customers"]).first()
    assert (agg.total_tickets, agg.high_priority_tickets) == (1, 0)


def test_t6_half_even_cast(spark):
    row = spark.range(1).select(*[round_to_int(F.lit(x)).alias(f"c{i}")
                                  for i, x in enumerate([2.5, 2.7, 3.5, -2.5])]).first()
    assert tuple(row) == (2, 3, 4, -2)


def test_t6_fractional_cap_in_usage_clean(spark):
    # p99.9 of [0, 10] = 9.99 -> cap CAST(9.99) = 10; minutes 10 > 9.99 -> 10
    t = _tables(spark, [(1, TS(2024, 1, 1), "Pro", "EU")],
                [(1, D(2024, 1, 1), 1, 0, 0), (1, D(2024, 1, 2), 1, 10, 0),
                 (1, D(2024, 1, 3), 0, 5, 0), (1, D(2024, 1, 4), 2, -3, 0)])
    u = t["usage_daily"]
    clean = {r.date: r for r in feat.usage_clean(u, feat.UsageStats(u)).collect()}
    assert clean[D(2024, 1, 2)].usage_minutes_clean == 10
    assert clean[D(2024, 1, 4)].usage_minutes_clean is None
    assert clean[D(2024, 1, 3)].sessions_clean == 1  # repair looks at raw minutes


@pytest.mark.parametrize("rec,label,stage", [
    (29, 0, "Active"), (30, None, "Active"), (31, None, "At Risk (31–45d)"),
    (45, None, "At Risk (31–45d)"), (46, 1, "Churned"), (None, None, "Churned")])
def test_t7_t8_label_and_stage_edges(spark, rec, label, stage):
    df = spark.createDataFrame([(rec,)], "r long")
    row = df.select(churn_label("r").alias("l"), lifecycle_stage("r").alias("s")).first()
    assert (row.l, row.s) == (label, stage)


def test_t10_clip_keeps_null_and_flag_zero(spark):
    df = spark.createDataFrame([(None,), (0.0,), (20.0,)], "x double")
    got = df.select(clip("x", F.lit(1.0), F.lit(15.0)).alias("c"),
                    flag(F.col("x") >= 3).alias("f")).collect()
    assert [(r.c, r.f) for r in got] == [(None, 0), (1.0, 0), (15.0, 1)]


def test_t11_floor_raises_low_probabilities(spark):
    df = spark.createDataFrame([(1, "Pro", 0.02)], "customer_id long, plan string, churn_risk_score double")
    on = scenario.lever_uplift(df, scenario.Levers(15, False, False)).first()
    off = scenario.lever_uplift(df, scenario.Levers(0, False, False)).first()
    assert on.churn_prob_after == pytest.approx(0.05) and on.prob_saved == pytest.approx(-0.03)
    assert off.churn_prob_after == pytest.approx(0.02)


def test_t12_t15_feature_table_edges(spark):
    mx = D(2024, 3, 31)
    usage = [(1, mx, 1, 100, 0), (1, mx - dt.timedelta(30), 1, 10, 0),
             (1, mx - dt.timedelta(31), 1, 20, 0), (1, mx - dt.timedelta(60), 1, 30, 0),
             (1, mx - dt.timedelta(61), 1, 1000, 0)]
    t = _tables(spark, [(1, TS(2023, 1, 1), "Free", "EU"), (2, TS(2023, 1, 1), "Basic", "NA")],
                usage)
    rows = {r.customer_id: r for r in feat.churn_features(t).collect()}
    assert len(rows) == 2
    one = rows[1]
    assert one.avg_usage_last_30d == pytest.approx(55.0)  # max and max-30
    assert one.avg_usage_prev_30d == pytest.approx(25.0)  # max-31 and max-60
    assert one.total_payment_issues is None and one.failed_payments_30d is None  # no bills
    assert one.total_tickets is None
    assert rows[2].recency_days is None and rows[2].churn_label is None


def test_t16_t17_duplicates(spark):
    t = _tables(spark, [(1, TS(2024, 1, 1), "Pro", "EU")], [(1, D(2024, 1, 1), 1, 1, 0)],
                billing=[(1, D(2024, 1, 5), 99, "paid"), (1, D(2024, 2, 5), 99, "paid")])
    assert quality.dq_billing_duplicates(t).first().issue_count is None
    t2 = _tables(spark, [(1, TS(2024, 1, 1), "Pro", "EU")], [(1, D(2024, 1, 1), 1, 1, 0)],
                 billing=[(1, D(2024, 1, 5), 99, "paid"), (1, D(2024, 1, 5), 0, "paid"),
                          (1, D(2024, 1, 5), 0, "paid")])
    assert quality.dq_billing_duplicates(t2).first().issue_count == 2
    assert feat.billing_clean(t2["billing"]).count() == 2
    assert quality.dq_zero_paid(t2).first().issue_count == 2


def test_t13_zero_repeat_gives_no_rows(spark):
    # signup long after the observation date -> negative bill count -> no rows
    t = _tables(spark, [(1, TS(2026, 1, 1), "Pro", "EU"), (2, TS(2023, 12, 1), "Pro", "EU")],
                [(1, D(2024, 1, 1), 1, 1, 0)])
    rows = spine.schedule_expand(t["customers"], feat.UsageStats(t["usage_daily"])).collect()
    assert {r.customer_id for r in rows} == {2}
    assert [r.bill_sequence for r in rows] == [0, 1]  # signup + 13, + 26 <= 2024-01-01


def test_daily_spine_and_its_months(spark):
    t = _tables(spark, [(1, TS(2024, 1, 30, 23, 59), "Pro", "EU"), (2, TS(2024, 3, 1), "Free", "EU"), (3, TS(2024, 3, 4), "Pro", "EU")],
                [(1, D(2024, 1, 29), 1, 9, 0),  # before signup
                 (1, D(2024, 1, 30), 1, 9, 0), (1, D(2024, 1, 30), 2, 9, 0),  # one day, two rows
                 (1, D(2024, 3, 2), 1, 9, 0), (9, D(2024, 3, 1), 1, 9, 0)])
    daily = spine.daily_spine(t["customers"], t["usage_daily"], feat.UsageStats(t["usage_daily"]))
    got = {(r.customer_id, r.date): r.active for r in daily.collect()}
    days = lambda first: [first + dt.timedelta(k) for k in range((D(2024, 3, 2) - first).days + 1)]
    want = {(1, d): int(d in (D(2024, 1, 30), D(2024, 3, 2))) for d in days(D(2024, 1, 30))} | {(2, d): 0 for d in days(D(2024, 3, 1))}
    assert got == want and daily.count() == len(want)  # signups after the last day have no days
    months = {(r.customer_id, r.month): (r.spine_days, r.active_days) for r in spine.monthly_activity(daily).collect()}
    assert months == {(1, D(2024, 1, 1)): (2, 1), (1, D(2024, 2, 1)): (29, 0), (1, D(2024, 3, 1)): (2, 1), (2, D(2024, 3, 1)): (2, 0)}


def _scored_rows(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, plan string, region string, "
                                       "churn_risk_score double, churn_label int")


def test_t19_ties_take_lower_customer_id(spark):
    s = _scored_rows(spark, [(i, "Pro", "EU", 0.9 if i < 3 else 0.7, 1) for i in range(1, 11)]
                     + [(20, "Pro", "EU", 0.7, 0), (15, "Pro", "EU", 0.7, 0)])
    quota = spark.createDataFrame([(4,)], "_take long")
    sel = sorted(r.customer_id for r in
                 co.rank_cutoff(s, "churn_risk_score", "customer_id", quota).where("_selected").collect())
    assert sel == [1, 2, 3, 4]


def test_t20_precision_counts_predicted_positives(spark):
    rows = [(i, "Pro", "EU", 0.45 if i <= 2 else 0.1, 1) for i in range(1, 21)]
    rows[0] = (1, "Pro", "EU", 0.9, 1)
    got = scoring.precision_at_top(_scored_rows(spark, rows)).first()
    assert got.k == 2 and got.predicted_positives == 1 and got.true_positives == 1
    assert got.precision_at_k == 1.0 and got.hit_rate_at_k == 1.0


def test_t24_unseen_level_is_all_zero(spark):
    df = spark.createDataFrame([(1, "Platinum"), (2, "Pro")], "customer_id long, plan string")
    out, names = prep.onehot(df, {"plan": ["Basic", "Enterprise", "Free", "Pro"]})
    assert names == ["plan_Enterprise", "plan_Free", "plan_Pro"]
    got = {r.customer_id: [r[n] for n in names] for r in out.collect()}
    assert got == {1: [0.0, 0.0, 0.0], 2: [0.0, 0.0, 1.0]}


def test_empty_cohort_has_no_division_errors(spark):
    s = _scored_rows(spark, [(1, "Pro", "EU", 0.9, 1)]).withColumn(
        "signup_date", F.lit(TS(2020, 1, 1))).withColumn("last_active_date", F.lit(D(2020, 2, 1)))
    spec = co.CohortSpec(plans=("Enterprise",))
    lim = co.target_limits(co.cohort_filter(s, spec), spec).first()
    assert lim.customers == 0 and lim.max_target_count == 0
    cohort = co.target_cohort(s, spec)
    assert cohort.count() == 0
    summ = scenario.business_summary(cohort, scenario.Levers(15, True, True)).first()
    assert summ.customers == 0 and summ.churn_rate_before == 0.0 and summ.retained_revenue == 0.0


def test_t23_split_is_partition_invariant(spark):
    rows = [(i, i % 3 == 0 and 1 or 0) for i in range(1, 401)]
    base = spark.createDataFrame(rows, "customer_id long, churn_label int")
    a = {r.customer_id: r.split for r in prep.stratified_split(base.repartition(1)).collect()}
    b = {r.customer_id: r.split for r in prep.stratified_split(base.repartition(7)).collect()}
    assert a == b
    test = [c for c, s in a.items() if s == "test"]
    assert len(test) == 100  # ceil(0.25 * 400)
    assert sum(1 for c in test if c % 3 == 0) in (33, 34)
