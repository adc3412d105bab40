"""Exploration: lifecycle mix, churn rates, robust summaries, distributions.

Which frame a metric uses matters: lifecycle metrics use every customer,
churn rates and medians use labelled customers only (unless soft churn is
included).  Every result is a small aggregate; grouping keys are
low-cardinality (plan, region, stage, status) so map-side partial
aggregation makes any skew in them harmless.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.functions.columns import churn_status, fixed, half_even, lifecycle_stage, pct, round6
from churnscope.functions.quantiles import Wanted, percentiles_of, wide_percentiles
from churnscope.session import materialize

DESCRIBE_COLUMNS = [
    "active_days", "avg_sessions", "avg_usage_minutes", "avg_usage_last_30d",
    "avg_usage_prev_30d", "usage_trend_30d", "total_payment_issues", "failed_payments_30d",
    "zero_paid_anomalies", "total_tickets", "high_priority_tickets", "recency_days",
]


def with_stage(features: DataFrame) -> DataFrame:
    return features.withColumn("lifecycle_stage", lifecycle_stage("recency_days"))


def labelled(features: DataFrame, include_soft_churn: bool = False) -> DataFrame:
    out = features if include_soft_churn else features.where(F.col("churn_label").isin(0, 1))
    return out.withColumn("churn_status", churn_status("churn_label"))


def stage_index(stage: Column) -> Column:
    expr = None
    for i, s in enumerate(C.LIFECYCLE_ORDER):
        expr = F.when(stage == s, F.lit(i)) if expr is None else expr.when(stage == s, F.lit(i))
    return expr


def _long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (keep..., feature, value double)."""
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                     for c in columns])
    return df.select(*keep, F.inline(rows))


# ------------------------------------------------------------ lifecycle ----

def lifecycle_distribution(features: DataFrame) -> DataFrame:
    staged = with_stage(features)
    counts = staged.groupBy("lifecycle_stage").agg(F.count(F.lit(1)).alias("customers"))
    total = staged.agg(F.count(F.lit(1)).alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select("lifecycle_stage", stage_index(F.col("lifecycle_stage")).alias("stage_order"),
                    "customers", round6(pct(F.col("customers"), F.col("_total"))).alias("pct"))
            .orderBy("stage_order"))


def lifecycle_by_plan(features: DataFrame) -> DataFrame:
    return (with_stage(features).groupBy("plan", "lifecycle_stage")
            .agg(F.count(F.lit(1)).alias("customers")))


def lifecycle_by_plan_pivot(features: DataFrame) -> DataFrame:
    pivoted = (with_stage(features).groupBy("plan")
               .pivot("lifecycle_stage", C.LIFECYCLE_ORDER).agg(F.count(F.lit(1))))
    return pivoted.fillna(0, subset=C.LIFECYCLE_ORDER).orderBy("plan")


def retention_funnel(features: DataFrame) -> DataFrame:
    st = F.col("lifecycle_stage")
    one = with_stage(features).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(st == C.STAGE_ACTIVE).alias("active"),
        F.count_if(st == C.STAGE_AT_RISK).alias("at_risk"),
        F.count_if(st == C.STAGE_CHURNED).alias("churned"),
    )
    rows = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(c).alias("customers"))
        for i, (name, c) in enumerate(zip(C.FUNNEL_STAGES, ["total", "active", "at_risk", "churned"]))
    ])
    return (one.select("total", F.inline(rows))
            .select("step", "stage", "customers",
                    round6(pct(F.col("customers"), F.col("total"))).alias("pct_of_initial"))
            .orderBy("step"))


# ----------------------------------------------------------- churn rates ---

def _rate_aggs() -> list[Column]:
    lab = F.col("churn_label")
    churned, active = F.count_if(lab == 1), F.count_if(lab == 0)
    return [churned.alias("churned"), active.alias("active"),
            pct(churned, churned + active).alias("churn_rate"),
            F.count("customer_id").alias("total_customers")]


def churn_rate_overall(features: DataFrame, include_soft_churn: bool = False) -> DataFrame:
    out = labelled(features, include_soft_churn).agg(*_rate_aggs())
    return out.select("churned", "active", round6("churn_rate").alias("churn_rate_pct"))


def churn_by(features: DataFrame, key: str, include_soft_churn: bool = False) -> DataFrame:
    out = labelled(features, include_soft_churn).groupBy(key).agg(*_rate_aggs())
    return (out.select(key, round6("churn_rate").alias("churn_rate"), "total_customers")
            .orderBy(F.desc("churn_rate"), key))


def churn_extremes(features: DataFrame) -> DataFrame:
    """Highest / lowest churn plan and highest churn region (ties by name)."""
    plan = labelled(features).groupBy("plan").agg(*_rate_aggs())
    region = labelled(features).groupBy("region").agg(*_rate_aggs())
    def pick(df: DataFrame, key: str, dim: str, which: str, highest: bool) -> DataFrame:
        # highest: rate desc then name asc; lowest is the last row of that order.
        keyed = df.select(F.col(key).alias("name"), "churn_rate")
        order = [F.desc("churn_rate"), F.asc("name")] if highest else \
            [F.asc("churn_rate"), F.desc("name")]
        return (keyed.orderBy(*order).limit(1)
                .select(F.lit(dim).alias("dimension"), F.lit(which).alias("extreme"),
                        "name", round6("churn_rate").alias("churn_rate")))

    return (pick(plan, "plan", "plan", "highest", True)
            .unionByName(pick(plan, "plan", "plan", "lowest", False))
            .unionByName(pick(region, "region", "region", "highest", True)))


def at_risk_by_plan(features: DataFrame) -> DataFrame:
    """Plan with the most At Risk customers and their share of that plan."""
    staged = with_stage(features)
    per_plan = staged.groupBy("plan").agg(
        F.count_if(F.col("lifecycle_stage") == C.STAGE_AT_RISK).alias("at_risk_customers"),
        F.count(F.lit(1)).alias("plan_customers"))
    present = per_plan.where(F.col("at_risk_customers") > 0)
    return (present.orderBy(F.desc("at_risk_customers"), F.asc("plan")).limit(1)
            .select("plan", "at_risk_customers", "plan_customers",
                    round6(pct(F.col("at_risk_customers"), F.col("plan_customers")))
                    .alias("at_risk_pct")))


# ----------------------------------------------------- robust summaries ----

QUARTILES = (0.25, 0.5, 0.75)
STATUS_COLUMNS = ("usage_trend_30d", "recency_days", "total_tickets")


def quartiles(features: DataFrame, columns: Sequence[str] = DESCRIBE_COLUMNS, status_columns: Sequence[str] = STATUS_COLUMNS,
              include_soft_churn: bool = False) -> DataFrame:
    """(column, grouping, of, p, value): the quartiles of the columns, over all rows and by churn status, in one selection.

    The summaries below take this frame as ``selected``, so that a report selects once.
    """
    wanted = [Wanted(c, QUARTILES) for c in columns] + [Wanted(c, QUARTILES, "churn_status") for c in status_columns]
    return materialize(percentiles_of(labelled(features, include_soft_churn), wanted))  # a row for each percentile


def _by_status(selected: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = selected.where((F.col("grouping") == "churn_status") & F.col("column").isin(*columns))
    return rows.select(F.col("of").alias("churn_status"), F.col("column").alias("feature"), "p", "value")


def _overall(selected: DataFrame, columns: Sequence[str]) -> DataFrame:
    return selected.where((F.col("grouping") == "") & F.col("column").isin(*columns)).select(F.col("column").alias("feature"), "p", "value")


def key_medians(features: DataFrame, include_soft_churn: bool = False, selected: DataFrame | None = None) -> DataFrame:
    """Exact medians of the reported columns."""
    if selected is None:
        selected = quartiles(features, C.KEY_MEDIAN_COLUMNS, (), include_soft_churn)
    med = _overall(selected, C.KEY_MEDIAN_COLUMNS).where(F.col("p") == 0.5)
    return med.select("feature", round6("value").alias("median"))


def medians_by_status(features: DataFrame, columns: Sequence[str] = STATUS_COLUMNS, include_soft_churn: bool = False,
                      selected: DataFrame | None = None) -> DataFrame:
    if selected is None:
        selected = quartiles(features, (), columns, include_soft_churn)
    med = _by_status(selected, columns).where(F.col("p") == 0.5)
    return med.select("churn_status", "feature", round6("value").alias("median"))


def numeric_describe(features: DataFrame, columns: Sequence[str] = DESCRIBE_COLUMNS,
                     include_soft_churn: bool = False, selected: DataFrame | None = None) -> DataFrame:
    """count, mean, std (n-1), min, quartiles, max per column, one long pass.

    The ``_2`` columns are the values as displayed, rounded half to even to 2 decimals.
    """
    if selected is None:
        selected = quartiles(features, columns, (), include_soft_churn)
    long = _long(labelled(features, include_soft_churn), columns).where(F.col("value").isNotNull())
    moments = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    qw = wide_percentiles(_overall(selected, columns), ["feature"], {0.25: "p25", 0.5: "p50", 0.75: "p75"})
    out = moments.join(qw, "feature", "left")
    shown = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return out.select("feature", "count", *[round6(c).alias(c) for c in shown],
                      *[half_even(c, 2).alias(f"{c}_2") for c in shown])


def box_summary(features: DataFrame, column: str, include_soft_churn: bool = False, selected: DataFrame | None = None) -> DataFrame:
    """Box-plot numbers by churn status: quartiles, 1.5 IQR whiskers, outliers."""
    if selected is None:
        selected = quartiles(features, (), (column,), include_soft_churn)
    lab = labelled(features, include_soft_churn).where(F.col(column).isNotNull())
    qw = wide_percentiles(_by_status(selected, [column]), ["churn_status"], {0.25: "q1", 0.5: "median", 0.75: "q3"})
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    x = F.col(column).cast("double")
    joined = lab.select("churn_status", column).join(F.broadcast(qw), "churn_status")
    agg = joined.groupBy("churn_status", "q1", "median", "q3", "iqr").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(x >= lo, x)).alias("whisker_low"),
        F.max(F.when(x <= hi, x)).alias("whisker_high"),
        F.count_if((x < lo) | (x > hi)).alias("outliers"))
    return agg.select("churn_status", "n", *[round6(c).alias(c) for c in
                                             ["q1", "median", "q3", "iqr", "whisker_low",
                                              "whisker_high"]], "outliers")


# -------------------------------------------------------- distributions ----

def kde_by_group(df: DataFrame, column: str, group: str, gridsize: int = 200,
                 cut: float = 3.0) -> DataFrame:
    """Gaussian KDE per group (Scott bandwidth, each group normalised to 1).

    The kernel sum runs over (distinct value, count) pairs x grid points,
    so the column must be discrete (e.g. whole days): the work is bounded
    by distinct values, not rows.  Groups with < 2 rows or zero spread are
    skipped, as a plotting KDE would.
    """
    base = df.where(F.col(column).isNotNull()).select(group, F.col(column).cast("double").alias("x"))
    stats = base.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
        F.min("x").alias("lo"), F.max("x").alias("hi"))
    stats = stats.where((F.col("n") >= 2) & (F.col("sd") > 0)).withColumn(
        "bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    grid = stats.select(
        group, "n", "bw",
        (F.col("lo") - F.col("bw") * cut).alias("g0"),
        ((F.col("hi") - F.col("lo") + 2 * F.col("bw") * cut) / (gridsize - 1)).alias("step"),
        F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid_idx"))
    grid = grid.withColumn("grid_x", F.col("g0") + F.col("grid_idx") * F.col("step"))
    values = base.groupBy(group, "x").agg(F.count(F.lit(1)).alias("c"))
    z = (F.col("grid_x") - F.col("x")) / F.col("bw")
    # the grid has gridsize rows for each group; the values stay where they are
    dens = (values.join(F.broadcast(grid), group)
            .groupBy(group, "grid_idx", "grid_x", "n", "bw")
            .agg(F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("s")))
    return dens.select(group, "grid_idx", round6("grid_x").alias("grid_x"),
                       round6(F.col("s") / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi)))
                       .alias("density"))


def recency_kde(features: DataFrame) -> DataFrame:
    return kde_by_group(with_stage(features), "recency_days", "lifecycle_stage")


def density_by_group(df: DataFrame, column: str, group: str, gridsize: int = 200, cut: float = 0.0,
                     per_bandwidth: int = 16, reach: float = 5.0) -> DataFrame:
    """Gaussian KDE of a continuous column per group (Scott bandwidth, each group normalised to 1).

    Linear binning: each row is shared between the two nearest points of a fine grid, a
    ``per_bandwidth``-th of the bandwidth apart, in proportion to its nearness.  So the kernel
    sum runs over fine grid points, at most per_bandwidth * range / bandwidth of them, however
    many rows there are, and each meets the output grid only within ``reach`` bandwidths.
    Groups with < 2 rows or zero spread are skipped.
    """
    base = df.where(F.col(column).isNotNull()).select(group, F.col(column).cast("double").alias("x"))
    stats = base.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
        F.min("x").alias("lo"), F.max("x").alias("hi"))
    stats = stats.where((F.col("n") >= 2) & (F.col("sd") > 0)).withColumn(
        "bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    stats = stats.select(group, "n", "bw", "lo", (F.col("bw") / per_bandwidth).alias("delta"),
                         (F.col("lo") - F.col("bw") * cut).alias("g0"),
                         ((F.col("hi") - F.col("lo") + 2 * F.col("bw") * cut) / (gridsize - 1)).alias("step"))
    place = (F.col("x") - F.col("lo")) / F.col("delta")
    placed = base.join(F.broadcast(stats.select(group, "lo", "delta")), group).select(group, F.floor(place).alias("j"), (place - F.floor(place)).alias("f"))
    sides = placed.groupBy(group, "j").agg(F.sum(1 - F.col("f")).alias("near"), F.sum("f").alias("far"))
    points = sides.select(group, F.inline(F.array(F.struct(F.col("j"), F.col("near").alias("w")), F.struct((F.col("j") + 1).alias("j"), F.col("far").alias("w")))))
    points = points.groupBy(group, "j").agg(F.sum("w").alias("w")).join(F.broadcast(stats), group)
    points = points.withColumn("centre", F.col("lo") + F.col("j") * F.col("delta"))
    first = F.greatest(F.ceil((F.col("centre") - F.col("bw") * reach - F.col("g0")) / F.col("step")), F.lit(0))
    last = F.least(F.floor((F.col("centre") + F.col("bw") * reach - F.col("g0")) / F.col("step")), F.lit(gridsize - 1))
    near = points.withColumn("first", first).withColumn("last", last).where("first <= last").withColumn("grid_idx", F.explode(F.sequence("first", "last")))
    z = (F.col("g0") + F.col("grid_idx") * F.col("step") - F.col("centre")) / F.col("bw")
    sums = near.groupBy(group, "grid_idx").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("s"))
    grid = stats.withColumn("grid_idx", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(gridsize - 1).cast("bigint"))))
    out = grid.join(sums, [group, "grid_idx"], "left")
    return out.select(group, F.col("grid_idx").cast("int").alias("grid_idx"), round6(F.col("g0") + F.col("grid_idx") * F.col("step")).alias("grid_x"),
                      round6(F.coalesce("s", F.lit(0.0)) / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))).alias("density"))


def usage_minutes_density(features: DataFrame, include_soft_churn: bool = False) -> DataFrame:
    """The density curve over the mean daily minutes, by status."""
    return density_by_group(labelled(features, include_soft_churn), "avg_usage_minutes", "churn_status")


def usage_trend_density(features: DataFrame, least: int = 100, include_soft_churn: bool = False) -> DataFrame:
    """The density curve over the usage-trend histogram, by status.

    Drawn only for at least ``least`` customers with a trend, and if both statuses occur;
    otherwise there are no rows.
    """
    lab = labelled(features, include_soft_churn)
    known = lab.where(F.col("usage_trend_30d").isNotNull())
    drawn = known.agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("churn_status").alias("_statuses"))
    drawn = drawn.where((F.col("_n") >= least) & (F.col("_statuses") > 1)).select(F.lit(True).alias("_drawn"))
    return density_by_group(known, "usage_trend_30d", "churn_status").crossJoin(F.broadcast(drawn)).drop("_drawn")


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = (),
              value_range: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width bins shared by all groups; last bin closed on the right.

    Bin assignment follows the usual edge-corrected rule: scaled floor,
    then nudged against the exact edges lo + j * (hi - lo) / bins.
    """
    by = list(by)
    base = df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("x"))
    if value_range is None:
        rng = base.agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"))
    else:
        rng = df.sparkSession.range(1).select(F.lit(float(value_range[0])).alias("lo0"),
                                              F.lit(float(value_range[1])).alias("hi0"))
    same = F.col("lo0") == F.col("hi0")
    rng = rng.select(F.when(same, F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(same, F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    x, lo, hi = F.col("x"), F.col("lo"), F.col("hi")
    edge = lambda j: lo + j * ((hi - lo) / bins)
    i0 = F.floor((x - lo) * (F.lit(float(bins)) / (hi - lo)))
    i1 = F.least(F.greatest(i0, F.lit(0)), F.lit(bins - 1))
    i2 = F.when(x < edge(i1), i1 - 1).otherwise(i1)
    i3 = F.when((x >= edge(i2 + 1)) & (i2 != bins - 1), i2 + 1).otherwise(i2)
    binned = (base.crossJoin(F.broadcast(rng))
              .where((x >= lo) & (x <= hi))
              .withColumn("bin", i3.cast("int")))
    # every bin of every group has a row, empty ones too: one row per group and bin
    counts = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    rng = rng.where(lo.isNotNull()).select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    grid = base.select(*by).distinct().crossJoin(F.broadcast(rng)) if by else rng
    out = grid.join(counts, [*by, "bin"], "left")
    return out.select(*by, "bin", round6(edge(F.col("bin"))).alias("bin_start"),
                      round6(edge(F.col("bin") + 1)).alias("bin_end"),
                      F.coalesce("n", F.lit(0)).cast("bigint").alias("count"))


def usage_trend_histogram(features: DataFrame, bins: int = 50, include_soft_churn: bool = False) -> DataFrame:
    return histogram(labelled(features, include_soft_churn), "usage_trend_30d", bins, by=["churn_status"])


# ------------------------------------------------------------- insights ----

def key_insights(features: DataFrame, selected: DataFrame | None = None) -> DataFrame:
    """The eight findings as (insight_id, value, text) rows."""
    lab = labelled(features)
    rate = lambda key: lab.groupBy(key).agg(*_rate_aggs())
    plan, region = rate("plan"), rate("region")

    def first(df: DataFrame, key: str, asc_rate: bool, name_desc: bool) -> DataFrame:
        o1 = F.asc("churn_rate") if asc_rate else F.desc("churn_rate")
        o2 = F.desc(key) if name_desc else F.asc(key)
        return df.orderBy(o1, o2).limit(1)

    hi_plan = first(plan, "plan", False, False).select(
        F.col("plan").alias("hp"), F.col("churn_rate").alias("hr"))
    lo_plan = first(plan, "plan", True, True).select(
        F.col("plan").alias("lp"), F.col("churn_rate").alias("lr"))
    hi_region = first(region, "region", False, False).select(
        F.col("region").alias("rg"), F.col("churn_rate").alias("rr"))
    funnel = with_stage(features).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("lifecycle_stage") == C.STAGE_AT_RISK).alias("at_risk"))
    top_risk_plan = at_risk_by_plan(features).select(
        F.col("plan").alias("ap"), F.col("at_risk_pct").alias("apct"))
    overall = lab.agg(*_rate_aggs()).select(
        F.col("churned").alias("oc"), F.col("active").alias("oa"), F.col("churn_rate").alias("orate"))
    med = medians_by_status(features, selected=selected).groupBy().pivot("feature").agg(
        *[F.first(F.when(F.col("churn_status") == s, F.col("median")), ignorenulls=True)
          .alias(s) for s in (C.STATUS_CHURNED, C.STATUS_ACTIVE)])
    one = (hi_plan.crossJoin(lo_plan).crossJoin(hi_region).crossJoin(funnel)
           .crossJoin(overall).crossJoin(med).join(top_risk_plan, F.lit(True), "left"))
    shown = lambda c, d: F.coalesce(fixed(F.col(c), d), F.lit("n/a"))  # noqa: E731  a finding stays without its value
    f1 = lambda c: shown(c, 1)
    f2 = lambda c: shown(c, 2)
    f0 = lambda c: shown(c, 0)
    at_risk_pct = pct(F.col("at_risk"), F.col("total"))
    one = one.withColumn("_arp", at_risk_pct)
    rows = [
        (1, "hr", F.concat(F.lit("Plan '"), F.col("hp"), F.lit("' has the highest churn rate ("),
                           f1("hr"), F.lit("%), while '"), F.col("lp"), F.lit("' has the lowest ("),
                           f1("lr"), F.lit("%)"))),
        (2, "rr", F.concat(F.lit("Region '"), F.col("rg"), F.lit("' shows the highest churn rate ("),
                           f1("rr"), F.lit("%)"))),
        (3, "_arp", F.concat(f1("_arp"), F.lit("% of customers are in "),
                             F.lit(C.STAGE_AT_RISK), F.lit(" stage"))),
        (4, "apct", F.concat(F.lit("Plan '"), F.col("ap"),
                             F.lit("' has the highest concentration of At Risk customers ("),
                             f1("apct"), F.lit("% of plan customers)"))),
        (5, "`usage_trend_30d_Churned`",
         F.concat(F.lit("Churned customers show "), f2("`usage_trend_30d_Churned`"),
                  F.lit(" min/day usage trend vs "), f2("`usage_trend_30d_Active`"),
                  F.lit(" for active customers (median)"))),
        (6, "`total_tickets_Churned`",
         F.concat(F.lit("Churned customers have median "), f0("`total_tickets_Churned`"),
                  F.lit(" support tickets vs "), f0("`total_tickets_Active`"),
                  F.lit(" for active customers"))),
        (7, "orate", F.concat(F.lit("Overall churn rate: "), f2("orate"), F.lit("% ("),
                              F.col("oc").cast("string"), F.lit(" churned / "),
                              F.col("oa").cast("string"), F.lit(" active)"))),
        (8, "`recency_days_Churned`",
         F.concat(F.lit("Churned customers have median recency of "),
                  f0("`recency_days_Churned`"), F.lit(" days vs "),
                  f0("`recency_days_Active`"), F.lit(" days for active customers"))),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("insight_id"),
                             round6(F.col(v)).alias("value"), t.alias("text"))
                    for i, v, t in rows])
    return one.select(F.inline(arr)).where(F.col("text").isNotNull())


def report(features: DataFrame) -> dict[str, DataFrame]:
    """Every exploration table, keyed by name (compute them together); all quartiles come from one selection."""
    selected = quartiles(features)
    return {
        "lifecycle_distribution": lifecycle_distribution(features),
        "lifecycle_by_plan": lifecycle_by_plan(features),
        "lifecycle_by_plan_pivot": lifecycle_by_plan_pivot(features),
        "retention_funnel": retention_funnel(features),
        "churn_rate_overall": churn_rate_overall(features),
        "churn_by_plan": churn_by(features, "plan"),
        "churn_by_region": churn_by(features, "region"),
        "key_medians": key_medians(features, selected=selected),
        "medians_by_status": medians_by_status(features, selected=selected),
        "numeric_describe": numeric_describe(features, selected=selected),
        "recency_box": box_summary(features, "recency_days", selected=selected),
        "tickets_box": box_summary(features, "total_tickets", selected=selected),
        "recency_kde": recency_kde(features),
        "usage_trend_histogram": usage_trend_histogram(features),
        "usage_trend_density": usage_trend_density(features),
        "key_insights": key_insights(features, selected),
    }


LIFT_SIGNALS = [
    ("usage_decline", ["usage_decline_flag"]),
    ("high_support", ["high_support_flag"]),
    ("payment_issue", ["payment_issue_flag"]),
    ("usage_decline+high_support", ["usage_decline_flag", "high_support_flag"]),
    ("usage_decline+payment_issue", ["usage_decline_flag", "payment_issue_flag"]),
    ("high_support+payment_issue", ["high_support_flag", "payment_issue_flag"]),
]


def churn_lift_by_flag(base: DataFrame) -> DataFrame:
    """Churn rate with vs without each signal (and each pair), and their ratio.

    ``base`` is the labelled frame with the three 0/1 flags.  One pass: all
    signals are conditional counts of the same aggregation.
    """
    lab = F.col("churn_label")
    aggs = []
    for name, flags in LIFT_SIGNALS:
        on = None
        for f in flags:
            on = (F.col(f) == 1) if on is None else (on & (F.col(f) == 1))
        aggs += [F.count_if(on).alias(f"{name}|wn"), F.count_if(on & (lab == 1)).alias(f"{name}|wc"),
                 F.count_if(~on).alias(f"{name}|on"), F.count_if(~on & (lab == 1)).alias(f"{name}|oc")]
    one = base.agg(*aggs)
    rows = F.array(*[F.struct(
        F.lit(i).alias("signal_order"), F.lit(name).alias("signal"),
        F.col(f"`{name}|wn`").alias("customers_with"),
        pct(F.col(f"`{name}|wc`"), F.col(f"`{name}|wn`")).alias("churn_rate_with"),
        F.col(f"`{name}|on`").alias("customers_without"),
        pct(F.col(f"`{name}|oc`"), F.col(f"`{name}|on`")).alias("churn_rate_without"))
        for i, (name, _) in enumerate(LIFT_SIGNALS)])
    long = one.select(F.inline(rows))
    lift = F.when(F.col("churn_rate_without") > 0,
                  F.col("churn_rate_with") / F.col("churn_rate_without"))
    return long.select("signal_order", "signal", "customers_with",
                       round6("churn_rate_with").alias("churn_rate_with"), "customers_without",
                       round6("churn_rate_without").alias("churn_rate_without"),
                       round6(lift).alias("lift"))
