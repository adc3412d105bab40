"""Cohort filtering, risk targeting and the cohort deep-dive aggregates.

Input is the scored frame (labelled, flagged, winsorised, ``churn_risk_score``).
Filters are plain predicates (pushed down where the frame is a scan); the
data-dependent pieces -- default threshold, target cap, N -- are one-row
aggregates; the top-N selection is the exact distributed cutoff, never a
large ``limit``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.functions.columns import half_even, pct, plan_revenue, ratio, round6
from churnscope.functions.quantiles import rank_cutoff


@dataclass(frozen=True)
class CohortSpec:
    """Filters (all ANDed; an empty plan/region list means no filter) and targeting.

    ``threshold=None`` uses the default rule min(0.6, max score of the
    filtered rows), or their score if all have the same; ``target_pct=None``
    means 10.  The percentage is held to the cap.
    """
    signup_range: tuple[dt.date, dt.date] | None = None
    active_range: tuple[dt.date, dt.date] | None = None
    plans: Sequence[str] = field(default_factory=tuple)
    regions: Sequence[str] = field(default_factory=tuple)
    threshold: float | None = None
    target_pct: int | None = None


def cohort_filter(scored: DataFrame, spec: CohortSpec) -> DataFrame:
    out = scored
    if spec.signup_range is not None:
        a, b = spec.signup_range
        out = out.where(F.to_date("signup_date").between(F.lit(a), F.lit(b)))
    if spec.active_range is not None:
        a, b = spec.active_range
        out = out.where(F.col("last_active_date").isNotNull()
                        & F.to_date("last_active_date").between(F.lit(a), F.lit(b)))
    if spec.plans:
        out = out.where(F.col("plan").isin(*spec.plans))
    if spec.regions:
        out = out.where(F.col("region").isin(*spec.regions))
    return out


def risk_domain(filtered: DataFrame) -> DataFrame:
    """Score range of the filtered rows, slider step and default threshold."""
    agg = filtered.agg(F.count(F.lit(1)).alias("customers"),
                       F.min("churn_risk_score").alias("risk_min"),
                       F.max("churn_risk_score").alias("risk_max"),
                       F.min(F.to_date("signup_date")).alias("signup_min"),
                       F.max(F.to_date("signup_date")).alias("signup_max"),
                       F.min("last_active_date").alias("last_active_min"),
                       F.max("last_active_date").alias("last_active_max"))
    span = F.col("risk_max") - F.col("risk_min")
    step = (F.when(span < 0.01, 0.001).when(span < 0.05, 0.01).when(span < 0.2, 0.02)
            .otherwise(0.05))
    default = (F.when(F.col("customers") == 0, F.lit(C.DEFAULT_RISK_THRESHOLD))
               .when(span == 0, F.col("risk_max"))  # one score for all: that score
               .otherwise(F.least(F.lit(C.DEFAULT_RISK_THRESHOLD), F.col("risk_max"))))
    return agg.select("*", F.when(span > 0, step).alias("step"),
                      default.alias("default_threshold"))


def target_limits(filtered: DataFrame, spec: CohortSpec) -> DataFrame:
    """One row: threshold, eligible count, cap %, chosen %, and N to select."""
    dom = risk_domain(filtered)
    thr = F.lit(spec.threshold) if spec.threshold is not None else F.col("default_threshold")
    dom = dom.select("customers", thr.cast("double").alias("threshold"))
    elig = (filtered.select("churn_risk_score").crossJoin(F.broadcast(dom))
            .agg(F.count_if(F.col("churn_risk_score") >= F.col("threshold")).alias("eligible")))
    one = dom.crossJoin(elig)
    n = F.col("customers")
    cap = F.when(n > 0, F.least(F.lit(C.MAX_TARGET_PCT),
                                F.floor(F.col("eligible") / n * 100).cast("int"))).otherwise(0)
    one = one.withColumn("max_target_pct_limit", cap.cast("int"))
    wanted = F.lit(C.DEFAULT_TARGET_PCT if spec.target_pct is None else spec.target_pct)
    chosen = (F.when(n == 0, F.lit(C.DEFAULT_TARGET_PCT))  # an empty filter keeps the default
              .when(F.col("max_target_pct_limit") > 0, F.least(wanted, F.col("max_target_pct_limit")))
              .otherwise(F.lit(0)))
    one = one.withColumn("max_target_pct", chosen.cast("int"))
    take = F.floor(n * F.col("max_target_pct") / 100.0).cast("long")
    return one.withColumn("max_target_count", take)


def target_cohort(scored: DataFrame, spec: CohortSpec) -> DataFrame:
    """Score >= threshold, then the top N by score (ties: lower customer_id)."""
    filtered = cohort_filter(scored, spec)
    lim = target_limits(filtered, spec)
    # The one-row limits enter as a scalar subquery (computed once), so the
    # filter stays a plain predicate and size estimates stay those of the input.
    above = filtered.where(F.col("churn_risk_score") >= lim.select("threshold").scalar())
    quota = lim.select(F.col("max_target_count").alias("_take"))
    return rank_cutoff(above, "churn_risk_score", "customer_id", quota).where(
        F.col("_selected")).drop("_selected")


def targeting_summary(scored: DataFrame, spec: CohortSpec) -> DataFrame:
    filtered = cohort_filter(scored, spec)
    lim = target_limits(filtered, spec)
    selected = target_cohort(scored, spec).agg(F.count(F.lit(1)).alias("selected"))
    total = scored.agg(F.count(F.lit(1)).alias("total_customers"))
    return (lim.crossJoin(selected).crossJoin(total)
            .select("total_customers", F.col("customers").alias("filtered_customers"),
                    round6("threshold").alias("threshold"), "eligible",
                    "max_target_pct_limit", "max_target_pct", "max_target_count", "selected"))


# -------------------------------------------------------- deep-dive --------

def overview_metrics(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("total_customers"),
                      round6(F.avg("churn_risk_score")).alias("avg_churn_risk"),
                      round6(F.avg("churn_label")).alias("actual_churn_rate"))


def risk_tier_share(scored: DataFrame) -> DataFrame:
    s = F.col("churn_risk_score")
    return scored.agg(
        round6(F.avg(F.when(s > C.MEDIUM_RISK_ABOVE, 1).otherwise(0)) * 100).alias("medium_risk_pct"),
        round6(F.avg(F.when(s > C.HIGH_RISK_ABOVE, 1).otherwise(0)) * 100).alias("high_risk_pct"))


def top_risk(scored: DataFrame, k: int = 10) -> DataFrame:
    """Top-k by score (a small k: a bounded TakeOrderedAndProject)."""
    return (scored.orderBy(F.desc("churn_risk_score"), F.asc("customer_id")).limit(k)
            .select("customer_id", "plan", "region", "churn_risk_score", "total_tickets",
                    "total_payment_issues"))


def domain(scored: DataFrame, column: str) -> DataFrame:
    return scored.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def cohort_drivers(cohort: DataFrame) -> DataFrame:
    """Share and count of each risk flag; dominant = max share, list order on ties."""
    flags = [("Usage Decline", "usage_decline_flag"), ("Payment Issues", "payment_issue_flag"),
             ("Support Load", "high_support_flag")]
    one = cohort.agg(F.count(F.lit(1)).alias("n"),
                     *[F.count_if(F.col(f) == 1).alias(f) for _, f in flags])
    rows = F.array(*[F.struct(F.lit(i).alias("driver_order"), F.lit(name).alias("driver"),
                              F.col(f).alias("customers_affected"),
                              pct(F.col(f), F.col("n")).alias("pct_affected"))
                     for i, (name, f) in enumerate(flags)])
    long = one.select(F.inline(rows))
    best = long.agg(F.min_by("driver_order", F.struct(-F.col("pct_affected"),
                                                       F.col("driver_order"))).alias("_best"))
    return (long.crossJoin(best)
            .select("driver_order", "driver", "customers_affected",
                    round6("pct_affected").alias("pct_affected"),
                    (F.col("driver_order") == F.col("_best")).alias("is_dominant"))
            .orderBy("driver_order"))


def cohort_trend_split(cohort: DataFrame) -> DataFrame:
    t = F.col("usage_trend_30d")
    return cohort.agg(F.count(F.lit(1)).alias("customers"),
                      F.count_if(t < 0).alias("negative_trend"),
                      F.count_if(t.isNull()).alias("no_trend"),
                      F.count_if(t >= 0).alias("non_negative_trend"))


def plan_contribution(cohort: DataFrame) -> DataFrame:
    per = cohort.groupBy("plan").agg(F.sum("churn_risk_score").alias("expected_churn"))
    tot = cohort.agg(F.sum("churn_risk_score").alias("_tot"))
    return (per.crossJoin(F.broadcast(tot))
            .select("plan", round6("expected_churn").alias("expected_churn"),
                    round6(ratio(F.col("expected_churn") * 100, F.col("_tot"))).alias("contribution_pct"),
                    half_even(ratio(F.col("expected_churn") * 100, F.col("_tot")), 1).alias("contribution_pct_1"))
            .orderBy(F.desc("expected_churn"), "plan"))


def risk_by(cohort: DataFrame, key: str) -> DataFrame:
    return (cohort.groupBy(key).agg(round6(F.avg("churn_risk_score")).alias("avg_churn_risk"),
                                    F.count(F.lit(1)).alias("customers"))
            .orderBy(F.desc("avg_churn_risk"), key))


def cohort_feature_delta(cohort: DataFrame, scored: DataFrame,
                         columns: Sequence[str] = C.COHORT_DELTA_COLUMNS) -> DataFrame:
    a = cohort.agg(*[F.avg(c).alias(c) for c in columns])
    b = scored.agg(*[F.avg(c).alias(f"o_{c}") for c in columns])
    rows = F.array(*[F.struct(F.lit(i).alias("feature_order"), F.lit(c).alias("feature"),
                              F.col(c).alias("cohort_mean"), F.col(f"o_{c}").alias("overall_mean"))
                     for i, c in enumerate(columns)])
    long = a.crossJoin(b).select(F.inline(rows))
    return long.select("feature_order", "feature", round6("cohort_mean").alias("cohort_mean"),
                       round6("overall_mean").alias("overall_mean"),
                       round6(F.col("cohort_mean") - F.col("overall_mean")).alias("delta"))


def cohort_risk_lift(cohort: DataFrame, scored: DataFrame) -> DataFrame:
    a = cohort.agg(F.avg("churn_risk_score").alias("cohort_risk"))
    b = scored.agg(F.avg("churn_risk_score").alias("overall_risk"))
    lift = ratio(F.col("cohort_risk"), F.col("overall_risk"))
    return a.crossJoin(b).select(
        round6("cohort_risk").alias("cohort_risk"), round6("overall_risk").alias("overall_risk"),
        round6(lift).alias("risk_ratio"),
        (F.col("cohort_risk") > F.col("overall_risk") * 1.5).alias("high_priority"),
        round6((lift - 1) * 100).alias("pct_higher"))


def risk_value_points(cohort: DataFrame) -> DataFrame:
    return cohort.select("customer_id", "plan", round6("churn_risk_score").alias("churn_risk_score"),
                         plan_revenue("plan").alias("monthly_revenue"), "total_tickets",
                         "total_payment_issues")



def cohort_insights(cohort: DataFrame, scored: DataFrame) -> DataFrame:
    """The cohort findings as (insight_id, value, text) rows; empty cohort -> no rows."""
    from churnscope.functions.columns import fixed

    drivers = cohort_drivers(cohort)
    dom = drivers.where("is_dominant").select(F.col("driver").alias("dd"),
                                              F.col("pct_affected").alias("dp"))
    pct_of = lambda name: F.first(F.when(F.col("driver") == name, F.col("pct_affected")),
                                  ignorenulls=True)
    shares = drivers.agg(pct_of("Usage Decline").alias("ud"), pct_of("Payment Issues").alias("pi"),
                         pct_of("Support Load").alias("sl"))
    top = plan_contribution(cohort).limit(1).select(F.col("plan").alias("tp"),
                                                    F.col("contribution_pct").alias("tpp"))
    split = cohort_trend_split(cohort)
    lift = cohort_risk_lift(cohort, scored)
    one = (dom.crossJoin(shares).crossJoin(top).crossJoin(split).crossJoin(lift)
           .where(F.col("customers") > 0))
    neg_pct = F.col("negative_trend") * 100.0 / F.col("customers")
    null_pct = F.col("no_trend") * 100.0 / F.col("customers")
    rows = [
        (1, F.col("dp"), F.concat(F.col("dd"), F.lit(" is the dominant churn signal: "),
                                  fixed("dp", 1), F.lit("% of selected customers are affected"))),
        (2, F.col("tpp"), F.concat(F.lit("Plan '"), F.col("tp"), F.lit("' contributes "),
                                   fixed("tpp", 1), F.lit("% of expected churn in this cohort"))),
        (3, F.col("cohort_risk"), F.concat(F.lit("Average churn risk in cohort: "),
                                           fixed(F.col("cohort_risk") * 100, 1), F.lit("% (vs "),
                                           fixed(F.col("overall_risk") * 100, 1),
                                           F.lit("% overall)"))),
        (4, F.when(F.col("negative_trend") > 0, round6(neg_pct)),
         F.when(F.col("negative_trend") > 0, F.concat(
             F.col("negative_trend").cast("string"), F.lit(" customers ("), fixed(neg_pct, 1),
             F.lit("%) show negative usage trends")))),
        (5, F.when(F.col("no_trend") > 0, round6(null_pct)),
         F.when(F.col("no_trend") > 0, F.concat(
             F.col("no_trend").cast("string"), F.lit(" customers ("), fixed(null_pct, 1),
             F.lit("%) have insufficient usage history for a trend")))),
        (6, F.when(F.col("ud") < 10, F.col("ud")),
         F.when(F.col("ud") < 10, F.concat(
             F.lit("Usage decline affects only "), fixed("ud", 1),
             F.when(F.col("negative_trend") > 0, F.lit("%: plan, payments or support may weigh more"))
             .otherwise(F.lit("%: it does not drive the risk of this cohort"))))),
        (7, F.col("pi"), F.concat(fixed("pi", 1), F.lit("% have payment issues, "),
                                  fixed("sl", 1), F.lit("% have high support load (3+ tickets)"))),
        (8, F.when(F.col("high_priority"), F.col("pct_higher")),
         F.when(F.col("high_priority"), F.concat(
             F.lit("Cohort risk is "), fixed("pct_higher", 0),
             F.lit("% higher than overall average")))),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("insight_id"), round6(v).alias("value"),
                             t.alias("text")) for i, v, t in rows])
    return one.select(F.inline(arr)).where(F.col("text").isNotNull())
