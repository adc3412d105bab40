"""Calendar spines, schedules and hash-based sampling as Spark operators.

These re-express the data-building steps of the source system (customer x
day grids, bill schedules, repeatable thinning, bucketed draws) as
deterministic DataFrame operators over the conformed tables.

Scale notes
* A spine is never shuffled or cached: its days are made and aggregated in
  the stage of the rows they come from (after the join with the active days,
  if it needs them), so no day row leaves the task.
* Per-day joins use the (customer, day)-deduplicated usage, which bounds
  any customer to one row per calendar day (a hot customer cannot blow up
  a task beyond its number of days).
* Sampling and bucketing use a key hash, so the result is the same for
  any partitioning, retry or executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.functions.columns import bucket_by_cumulative, key_hash, key_uniform, round6
from churnscope.operators.features import UsageStats


def _plan_map(mapping: dict[str, float]) -> Column:
    expr = None
    for name, value in mapping.items():
        expr = (F.when(F.col("plan") == name, F.lit(value)) if expr is None
                else expr.when(F.col("plan") == name, F.lit(value)))
    return expr


def _with_spine_bounds(customers: DataFrame, stats: UsageStats) -> DataFrame:
    start = F.to_date("signup_date")
    return customers.select(
        "customer_id", "plan", start.alias("spine_start"), stats.max_date.alias("spine_end"),
        (F.datediff(stats.max_date, start) + 1).alias("spine_days"))


def usage_days(usage: DataFrame) -> DataFrame:
    """Distinct active (customer, day) pairs."""
    return usage.select("customer_id", "date").distinct()


def daily_spine(customers: DataFrame, usage: DataFrame, stats: UsageStats) -> DataFrame:
    """Dense customer x day series from signup to the observation date.

    ``active`` marks days with usage.  Rows = sum of spine lengths; use it
    where per-day rows are needed, aggregate in the same plan otherwise.
    A customer meets its active days as one array (an entry per calendar day
    at most) before its days are made, so no day row is shuffled or sorted
    and the rows stay partitioned by customer.
    """
    b = _with_spine_bounds(customers, stats).where(F.col("spine_days") > 0)
    used = usage_days(usage).groupBy("customer_id").agg(F.collect_list("date").alias("_used"))
    dates = F.sequence("spine_start", "spine_end")
    seen = F.coalesce("_used", F.array().cast("array<date>"))
    by_activity = F.array(F.struct(F.array_except(dates, seen).alias("dates"), F.lit(0).alias("active")),
                          F.struct(F.array_intersect(dates, seen).alias("dates"), F.lit(1).alias("active")))
    return (b.join(used, "customer_id", "left").select("customer_id", F.inline(by_activity))
            .select("customer_id", F.explode("dates").alias("date"), "active"))


def monthly_activity(spine: DataFrame) -> DataFrame:
    """Per customer and calendar month of a dense daily series: its days and the active ones; months without usage stay."""
    return (spine.groupBy("customer_id", F.trunc("date", "month").alias("month"))
            .agg(F.count(F.lit(1)).alias("spine_days"), F.sum("active").cast("long").alias("active_days")))


def calendar_spine(customers: DataFrame, usage: DataFrame, stats: UsageStats) -> DataFrame:
    """Per customer: spine length, active and inactive days inside it."""
    b = _with_spine_bounds(customers, stats)
    inside = (usage_days(usage)
              .join(b.select("customer_id", "spine_start", "spine_end"), "customer_id")
              .where(F.col("date").between(F.col("spine_start"), F.col("spine_end")))
              .groupBy("customer_id").agg(F.count(F.lit(1)).alias("active_days")))
    spine_days = F.greatest(F.col("spine_days"), F.lit(0))
    return (b.join(inside, "customer_id", "left")
            .select("customer_id", "spine_start", "spine_end", spine_days.alias("spine_days"),
                    F.coalesce("active_days", F.lit(0)).alias("active_days"),
                    (spine_days - F.coalesce("active_days", F.lit(0))).alias("inactive_days")))


def expected_activity(customers: DataFrame, usage: DataFrame, stats: UsageStats) -> DataFrame:
    """Expected active days = sum over spine days of plan base * exp(-day / 220).

    The sum depends only on the base and the length of the spine, so the days are made once for
    each of these pairs (a few bases x calendar days) and the sums are broadcast.
    """
    b = _with_spine_bounds(customers, stats).where(F.col("spine_days") > 0)
    spans = b.select("customer_id", _plan_map(C.PLAN_ACTIVITY_BASE).alias("base"), "spine_days")
    days = spans.select("base", "spine_days").distinct().select(
        "base", "spine_days", F.explode(F.sequence(F.lit(0), F.col("spine_days") - 1)).alias("d"))
    sums = days.groupBy("base", "spine_days").agg(
        F.sum(F.col("base") * F.exp(-F.col("d") / C.ACTIVITY_DECAY_DAYS)).alias("expected"))
    expected = (spans.join(F.broadcast(sums), ["base", "spine_days"])
                .groupBy("customer_id").agg(F.sum("expected").alias("expected")))
    observed = calendar_spine(customers, usage, stats)
    out = observed.join(expected, "customer_id", "left")
    return out.select(
        "customer_id", "spine_days", round6("expected").alias("expected_active_days"),
        F.col("active_days").alias("observed_active_days"),
        round6(F.when(F.col("expected") > 0, F.col("active_days") / F.col("expected")))
        .alias("activity_ratio"))


def tenure(customers: DataFrame, stats: UsageStats) -> DataFrame:
    """Tenure in days and months (capped at 18) and the bill count rule."""
    days = F.datediff(stats.max_date, F.to_date("signup_date"))
    months = F.least(days / 30.0, F.lit(float(C.MAX_TENURE_MONTHS))).cast("int")
    bills = F.greatest((months + 15).cast("double"), F.least(months * 4.0, F.lit(42.0))).cast("int")
    return customers.select(
        "customer_id", "plan", days.alias("tenure_days"), months.alias("months_active"),
        F.when(F.col("plan") != "Free", bills).alias("bill_count"))


def expected_tickets(customers: DataFrame, stats: UsageStats) -> DataFrame:
    days = F.datediff(stats.max_date, F.to_date("signup_date"))
    months = F.least(F.greatest(days / 30.0, F.lit(1.0)), F.lit(float(C.MAX_TENURE_MONTHS)))
    return customers.select("customer_id", round6(months).alias("ticket_tenure_months"),
                            round6(months * C.TICKETS_PER_MONTH).alias("expected_tickets"))


def schedule_expand(customers: DataFrame, stats: UsageStats) -> DataFrame:
    """One row per scheduled bill: signup + 13 + 13 * seq, up to the observation date."""
    t = tenure(customers, stats).where(F.col("bill_count").isNotNull())
    n = F.col("bill_count")
    # sequence(0, -1) would yield two elements; a zero count must give no rows.
    seq = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    joined = t.join(customers.select("customer_id", "signup_date"), "customer_id")
    rows = joined.select("customer_id", "plan", F.to_date("signup_date").alias("start"),
                         F.posexplode(seq).alias("bill_sequence", "_v"))
    price = _plan_map(C.PLAN_PRICE).cast("int")
    bill_date = F.date_add(F.col("start"),
                           F.lit(C.BILL_FIRST_OFFSET_DAYS) + F.col("bill_sequence") * C.BILL_EVERY_DAYS)
    return (rows.select("customer_id", "bill_sequence", bill_date.alias("bill_date"),
                        price.alias("amount"))
            .where(F.col("bill_date") <= stats.max_date))


def weighted_bucket(schedule: DataFrame, seed: int = 7) -> DataFrame:
    """Assign paid / late / failed by cumulative probability of a keyed uniform."""
    key = F.col("customer_id") * 4096 + F.col("bill_sequence")
    u = key_uniform(key, seed)
    return schedule.select("customer_id", "bill_sequence", round6(u).alias("u"),
                           bucket_by_cumulative(u, C.PAYMENT_STATUS_BUCKETS).alias("payment_status"))


def hash_sample(usage: DataFrame, seed: int = 11) -> DataFrame:
    """Repeatable thinning: drop 12-18 % of rows, decided by a hash of (customer, day)."""
    key = key_hash("customer_id", 3) * 65536 + F.datediff(F.col("date"), F.lit("1970-01-01").cast("date"))
    drawn = usage.withColumn("_key", key).withColumns({"_u": key_uniform("_key", seed), "_v": key_uniform("_key", seed + 1)})
    # A filter on the draws themselves is pushed below the columns it reads, with the whole hash
    # copied into each use (hundreds of times, more than Java compiles); it stays above an explode.
    keep = F.explode(F.array(F.col("_u") > (F.lit(0.12) + F.lit(0.06) * F.col("_v"))))
    return drawn.select(*usage.columns, keep.alias("_keep")).where("_keep").drop("_keep")


def bill_sequence(billing: DataFrame) -> DataFrame:
    """0-based position of each bill in its customer's history.

    Order: bill_date, amount, payment_status.  Equal bills collapse to one
    row with a count.  The offset of each day is a running sum over the
    customer's distinct bill dates (bounded by the calendar), the offset
    inside a day one over the day's distinct bills; the counts are then
    spread out again, so no window holds a hot customer-day's rows.
    """
    bills = billing.groupBy("customer_id", "bill_date", "amount", "payment_status").agg(F.count(F.lit(1)).alias("_c"))
    per_day = bills.groupBy("customer_id", "bill_date").agg(F.sum("_c").alias("_n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    w = before(Window.partitionBy("customer_id").orderBy("bill_date"))
    offsets = per_day.select("customer_id", "bill_date",
                             F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    wd = before(Window.partitionBy("customer_id", "bill_date").orderBy("amount", "payment_status"))
    within = bills.withColumn("_i", F.coalesce(F.sum("_c").over(wd), F.lit(0)))
    first = F.col("_off") + F.col("_i")
    return (within.join(offsets, ["customer_id", "bill_date"])
            .select("customer_id", "bill_date", "amount", "payment_status",
                    F.explode(F.sequence(first, first + F.col("_c") - 1)).alias("_at"))
            .select("customer_id", "bill_date", "amount", "payment_status",
                    F.col("_at").cast("int").alias("bill_sequence")))
