"""Retention what-if: lever uplift, costs, revenue, ROI; scenario grids.

Levers are subtractive with a floor applied after each applied lever
(a customer already below the floor is raised to it once any lever is on).
The whole targeted cohort pays the lever cost, not just the saved share.
A scenario grid is the cohort crossed with a broadcast lever table (28
rows, a fixed bound) and aggregated map-side in one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.functions.columns import plan_revenue, round6


@dataclass(frozen=True)
class Levers:
    discount_pct: int = 0
    priority_support: bool = False
    feature_unlock: bool = False


def after_levers(p: Column, discount: Column, support: Column, feature: Column) -> Column:
    """Churn probability after the levers (lever columns may vary per row)."""
    floor = F.lit(C.CHURN_PROB_FLOOR)
    p = F.when(discount > 0, F.greatest(p - discount * C.DISCOUNT_UPLIFT_PER_PCT, floor)).otherwise(p)
    p = F.when(support, F.greatest(p - C.PRIORITY_SUPPORT_UPLIFT, floor)).otherwise(p)
    p = F.when(feature, F.greatest(p - C.FEATURE_UNLOCK_UPLIFT, floor)).otherwise(p)
    return p


def _lever_cols(levers: Levers) -> tuple[Column, Column, Column]:
    return (F.lit(levers.discount_pct), F.lit(bool(levers.priority_support)),
            F.lit(bool(levers.feature_unlock)))


def plan_revenue_frame(scored: DataFrame) -> DataFrame:
    return scored.select("customer_id", "plan", plan_revenue("plan").alias("monthly_revenue"))


def lever_uplift(cohort: DataFrame, levers: Levers) -> DataFrame:
    d, s, f = _lever_cols(levers)
    before = F.col("churn_risk_score")
    after = after_levers(before, d, s, f)
    return cohort.select("customer_id", "plan", round6(before).alias("churn_prob_before"),
                         round6(after).alias("churn_prob_after"),
                         round6(before - after).alias("prob_saved"))


def _summary_aggs(before: Column, after: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("customers"),
            F.sum(before).alias("expected_churn_before"),
            F.sum(after).alias("expected_churn_after"),
            F.sum(plan_revenue("plan")).alias("total_revenue"),
            F.avg(plan_revenue("plan")).alias("avg_revenue")]


def _finish(agg: DataFrame, d: Column, s: Column, f: Column, keep: list[str]) -> DataFrame:
    n = F.col("customers")
    saved = F.coalesce(F.col("expected_churn_before"), F.lit(0.0)) - \
        F.coalesce(F.col("expected_churn_after"), F.lit(0.0))
    discount_cost = F.when(d > 0, F.coalesce(F.col("total_revenue"), F.lit(0)) * d / 100.0).otherwise(0.0)
    priority_cost = F.when(s, n * C.PRIORITY_SUPPORT_COST).otherwise(0)
    feature_cost = F.when(f, n * C.FEATURE_UNLOCK_COST).otherwise(0)
    out = agg.select(
        *keep, "customers",
        F.coalesce(F.col("expected_churn_before"), F.lit(0.0)).alias("expected_churn_before"),
        F.coalesce(F.col("expected_churn_after"), F.lit(0.0)).alias("expected_churn_after"),
        saved.alias("customers_saved"),
        discount_cost.cast("double").alias("discount_cost"),
        priority_cost.cast("double").alias("priority_cost"),
        feature_cost.cast("double").alias("feature_cost"),
        "avg_revenue")
    out = out.withColumn("total_cost", F.col("discount_cost") + F.col("priority_cost")
                         + F.col("feature_cost"))
    retained = F.when((n > 0) & (F.col("customers_saved") > 0),
                      F.col("customers_saved") * F.col("avg_revenue")).otherwise(F.lit(0.0))
    out = out.withColumn("retained_revenue", retained)
    out = out.withColumn("net_roi", F.col("retained_revenue") - F.col("total_cost"))
    out = out.withColumn("roi_pct", F.when(F.col("total_cost") > 0,
                                           F.col("net_roi") / F.col("total_cost") * 100))
    rate = lambda c: F.when(n > 0, F.col(c) / n).otherwise(F.lit(0.0))
    out = out.withColumn("churn_rate_before", rate("expected_churn_before"))
    out = out.withColumn("churn_rate_after", rate("expected_churn_after"))
    doubles = ["expected_churn_before", "expected_churn_after", "customers_saved",
               "discount_cost", "priority_cost", "feature_cost", "total_cost",
               "retained_revenue", "net_roi", "roi_pct", "churn_rate_before", "churn_rate_after"]
    return out.select(*keep, "customers", *[round6(c).alias(c) for c in doubles])


def business_summary(cohort: DataFrame, levers: Levers) -> DataFrame:
    d, s, f = _lever_cols(levers)
    before = F.col("churn_risk_score")
    agg = cohort.agg(*_summary_aggs(before, after_levers(before, d, s, f)))
    return _finish(agg, d, s, f, [])


def cost_breakdown(cohort: DataFrame, levers: Levers) -> DataFrame:
    """Cost and revenue bars; only amounts above zero are kept."""
    summary = business_summary(cohort, levers)
    rows = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(cat).alias("category"),
                              F.col(c).alias("amount"))
                     for kind, cat, c in [("cost", "Discount", "discount_cost"),
                                          ("cost", "Priority Support", "priority_cost"),
                                          ("cost", "Feature Unlock", "feature_cost"),
                                          ("revenue", "Retained Revenue", "retained_revenue")]])
    return summary.select(F.inline(rows)).where(F.col("amount") > 0)


def lever_grid(spark) -> DataFrame:
    """Every lever combination the simulator offers (7 x 2 x 2 = 28 rows)."""
    rows = [(i, d, s, f) for i, (d, s, f) in enumerate(
        (d, s, f) for d in [0, *C.DISCOUNT_CHOICES] for s in (False, True) for f in (False, True))]
    return spark.createDataFrame(
        rows, "scenario_id int, discount_pct int, priority_support boolean, feature_unlock boolean")


def scenario_grid(cohort: DataFrame) -> DataFrame:
    grid = lever_grid(cohort.sparkSession)
    d, s, f = F.col("discount_pct"), F.col("priority_support"), F.col("feature_unlock")
    crossed = cohort.select("plan", "churn_risk_score").crossJoin(F.broadcast(grid))
    before = F.col("churn_risk_score")
    keys = ["scenario_id", "discount_pct", "priority_support", "feature_unlock"]
    agg = crossed.groupBy(*keys).agg(*_summary_aggs(before, after_levers(before, d, s, f)))
    # A scenario must exist even for an empty cohort.
    agg = grid.join(agg, keys, "left").fillna(0, subset=["customers"])
    return _finish(agg, d, s, f, keys).orderBy("scenario_id")


def best_scenario(cohort: DataFrame) -> DataFrame:
    """Highest net ROI; ties: lower total cost, then lower scenario id."""
    return (scenario_grid(cohort)
            .orderBy(F.desc("net_roi"), F.asc("total_cost"), F.asc("scenario_id")).limit(1))
