"""The one-row-per-customer feature table and its building blocks.

Plan shape (see ``churn_features``):

* One stats pass over usage computes the exact p99.9 of minutes and the
  global max usage date (= observation date).  It is a one-row scalar
  subquery; Spark runs it once and inlines the values as literals.
* usage_agg and usage_trends share the same key, so they are one
  two-level aggregation: (customer, day) then customer.  The first level
  makes ``COUNT(DISTINCT date)`` a plain count and splits a hot customer
  across its days; both levels combine map-side before shuffling.
* Facts are reduced to customer grain before any join (billing, support),
  and support is pre-aggregated to (customer, day) before the join that
  needs the signup date, so a hot customer joins at most one row per day.
* The final 4-way left join is on the key every aggregate is already
  hash-partitioned by; only ``customers`` is shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.session import materialize
from churnscope.functions.columns import churn_label, days_between, flag, ratio, round_to_int

FEATURE_COLUMNS = [
    "customer_id", "signup_date", "plan", "region", "last_active_date", "active_days",
    "avg_sessions", "avg_usage_minutes", "avg_usage_last_30d", "avg_usage_prev_30d",
    "usage_trend_30d", "total_payment_issues", "failed_payments_30d", "zero_paid_anomalies",
    "total_tickets", "high_priority_tickets", "recency_days", "churn_label",
]


# ---------------------------------------------------------------- stats ----

def usage_stats_frame(usage: DataFrame) -> DataFrame:
    """One row: exact p99.9 of usage_minutes and the max usage date.

    Usage is read once, into a histogram of its minute values (a day has few).
    The percentile is exact, with linear interpolation; its one task merges
    the distinct minutes of the histogram, not the maps of all scan tasks.
    """
    hist = usage.groupBy("usage_minutes").agg(F.count(F.lit(1)).alias("c"), F.max("date").alias("d"))
    return hist.agg(
        F.percentile("usage_minutes", C.USAGE_CAP_PERCENTILE, F.col("c")).alias("p999_minutes"),
        F.max("d").alias("max_usage_date"),
    )


class UsageStats:
    """Scalar view of ``usage_stats_frame`` usable inside other plans.

    By default the row is a scalar subquery (planned once per query, lazy).
    ``UsageStats.resolved`` runs the one-row aggregation once and hands the
    two values to several jobs as literals (shared by the quality and
    feature layers; literal date bounds also fold into pushed filters).
    """

    def __init__(self, usage: DataFrame | None = None, values: tuple | None = None):
        if values is not None:
            p999, max_date = values
            self._p999 = F.lit(p999).cast("double")
            self._max = F.lit(max_date).cast("date")
            self.frame = None
            return
        self.frame = usage_stats_frame(usage)
        packed = self.frame.select(F.struct("p999_minutes", "max_usage_date").alias("s")).scalar()
        self._p999 = packed.getField("p999_minutes")
        self._max = packed.getField("max_usage_date")

    @classmethod
    def resolved(cls, usage: DataFrame) -> UsageStats:
        row = usage_stats_frame(usage).first()
        return cls(values=(row.p999_minutes, row.max_usage_date))

    @property
    def p999(self) -> Column:
        return self._p999

    @property
    def max_date(self) -> Column:
        return self._max


# ---------------------------------------------------------------- usage ----

def usage_clean(usage: DataFrame, stats: UsageStats) -> DataFrame:
    m, s = F.col("usage_minutes"), F.col("sessions")
    minutes_clean = (F.when(m < 0, F.lit(None).cast("int"))
                     .when(m > stats.p999, round_to_int(stats.p999))
                     .otherwise(m))
    # The repair looks at the raw minutes, not the cleaned ones.
    sessions_clean = F.when((s == 0) & (m > 0), F.lit(1)).otherwise(s)
    return usage.select(
        "customer_id", "date",
        minutes_clean.alias("usage_minutes_clean"),
        sessions_clean.alias("sessions_clean"),
        "feature_events",
    )


def usage_customer_day(clean: DataFrame) -> DataFrame:
    """Level 1: (customer, day) partial sums; one row per active day."""
    return clean.groupBy("customer_id", "date").agg(
        F.sum("sessions_clean").alias("sum_sessions"),
        F.count("sessions_clean").alias("n_sessions"),
        F.sum("usage_minutes_clean").alias("sum_minutes"),
        F.count("usage_minutes_clean").alias("n_minutes"),
    )


def usage_features(usage: DataFrame, stats: UsageStats) -> DataFrame:
    """usage_agg + usage_trends in one grouped pass (same key)."""
    return usage_from_days(usage_customer_day(usage_clean(usage, stats)), stats)


def usage_from_days(daily: DataFrame, stats: UsageStats) -> DataFrame:
    """Level 2: the usage features of each customer, from its days."""
    d = F.col("date")
    recent = d >= F.date_sub(stats.max_date, C.TREND_RECENT_DAYS)
    prior = (d >= F.date_sub(stats.max_date, C.TREND_PRIOR_DAYS)) & \
            (d < F.date_sub(stats.max_date, C.TREND_RECENT_DAYS))

    def window_avg(cond: Column) -> Column:
        return ratio(F.sum(F.when(cond, F.col("sum_minutes"))),
                     F.sum(F.when(cond, F.col("n_minutes"))))

    return daily.groupBy("customer_id").agg(
        F.max("date").alias("last_active_date"),
        F.count("date").alias("active_days"),
        ratio(F.sum("sum_sessions"), F.sum("n_sessions")).alias("avg_sessions"),
        ratio(F.sum("sum_minutes"), F.sum("n_minutes")).alias("avg_usage_minutes"),
        window_avg(recent).alias("avg_usage_last_30d"),
        window_avg(prior).alias("avg_usage_prev_30d"),
    )


def usage_agg(usage: DataFrame, stats: UsageStats) -> DataFrame:
    return usage_features(usage, stats).select(
        "customer_id", "last_active_date", "active_days", "avg_sessions", "avg_usage_minutes")


def usage_trends(usage: DataFrame, stats: UsageStats) -> DataFrame:
    return usage_features(usage, stats).select(
        "customer_id", "avg_usage_last_30d", "avg_usage_prev_30d",
        (F.col("avg_usage_last_30d") - F.col("avg_usage_prev_30d")).alias("usage_trend_30d"))


def usage_trend_relative(usage: DataFrame, stats: UsageStats) -> DataFrame:
    """Documented variant: (recent - prior) / prior, NULL when prior is 0 or NULL."""
    return usage_features(usage, stats).select(
        "customer_id", "avg_usage_last_30d", "avg_usage_prev_30d",
        ratio(F.col("avg_usage_last_30d") - F.col("avg_usage_prev_30d"),
              F.col("avg_usage_prev_30d")).alias("usage_trend_relative"))


# -------------------------------------------------------------- billing ----

def billing_clean(billing: DataFrame) -> DataFrame:
    """Exact-row de-duplication plus the zero-amount-paid flag."""
    zero_paid = (F.col("amount") == 0) & (F.col("payment_status") == "paid")
    return (billing.select("customer_id", "bill_date", "amount", "payment_status").distinct()
            .withColumn("is_zero_paid_flag", F.when(zero_paid, F.lit(1)).otherwise(F.lit(0))))


def billing_agg(billing: DataFrame, stats: UsageStats) -> DataFrame:
    st = F.col("payment_status")
    failed_recent = (st == "failed") & \
        (F.col("bill_date") >= F.date_sub(stats.max_date, C.TREND_RECENT_DAYS))
    return billing_clean(billing).groupBy("customer_id").agg(
        F.sum(F.when(st.isin("late", "failed"), 1).otherwise(0)).alias("total_payment_issues"),
        F.sum(F.when(failed_recent, 1).otherwise(0)).alias("failed_payments_30d"),
        F.sum("is_zero_paid_flag").alias("zero_paid_anomalies"),
    )


def billing_customer_day(billing: DataFrame) -> DataFrame:
    """(customer, day) counts of distinct bills with an issue, failed ones and zero-paid ones."""
    st = F.col("payment_status")
    return billing_clean(billing).groupBy("customer_id", "bill_date").agg(
        F.sum(F.when(st.isin("late", "failed"), 1).otherwise(0)).alias("n_issues"),
        F.sum(F.when(st == "failed", 1).otherwise(0)).alias("n_failed"),
        F.sum("is_zero_paid_flag").alias("n_zero_paid"),
    )


def billing_from_days(daily: DataFrame, stats: UsageStats) -> DataFrame:
    """billing_agg from the days of each customer."""
    recent = F.col("bill_date") >= F.date_sub(stats.max_date, C.TREND_RECENT_DAYS)
    return daily.groupBy("customer_id").agg(
        F.sum("n_issues").alias("total_payment_issues"),
        F.sum(F.when(recent, F.col("n_failed")).otherwise(0)).alias("failed_payments_30d"),
        F.sum("n_zero_paid").alias("zero_paid_anomalies"),
    )


# -------------------------------------------------------------- support ----

def support_customer_day(support: DataFrame) -> DataFrame:
    """(customer, day) ticket counts: bounds any customer to one row per day."""
    return support.groupBy("customer_id", "ticket_date").agg(
        F.count(F.lit(1)).alias("n_tickets"),
        F.sum(F.when(F.col("priority") == "high", 1).otherwise(0)).alias("n_high"),
    )


def _with_signup(daily: DataFrame, customers: DataFrame) -> DataFrame:
    # Inner join: tickets of unknown customers are dropped.  DATE vs
    # TIMESTAMP is compared as timestamps (midnight of the ticket day).
    signup = customers.select("customer_id", "signup_date")
    return (daily.join(signup, "customer_id", "inner")
            .withColumn("_pre_signup",
                        F.col("ticket_date").cast("timestamp_ntz") < F.col("signup_date")))


#: Copies of a heavy hitter's customer row, and so the parts its tickets are dealt into.
TICKET_SALTS = 64


def heavy_hitters(tickets: DataFrame, parts: int) -> DataFrame:
    """(customer_id, _heavy) of customers with more than a quarter of a task's even share of the rows.

    Counted exactly, with map-side sums.  Of n rows over ``parts`` tasks these are fewer than
    4 * parts customers, so the result may be broadcast.
    """
    counts = tickets.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_c"))
    total = counts.agg(F.sum("_c").alias("_n"))
    heavy = counts.crossJoin(F.broadcast(total)).where(F.col("_c") * (4 * parts) > F.col("_n"))
    return heavy.where(F.col("customer_id").isNotNull()).select("customer_id", F.lit(True).alias("_heavy"))


def salted_tickets(tickets: DataFrame, heavy: DataFrame, salts: int = TICKET_SALTS) -> DataFrame:
    """``tickets`` with ``_salt``: 0, or for heavy hitters a number below ``salts`` by the row's place."""
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    marked = tickets.join(F.broadcast(heavy), "customer_id", "left")
    return marked.withColumn("_salt", F.when(F.col("_heavy"), place).otherwise(F.lit(0))).drop("_heavy")


def join_customers_salted(tickets: DataFrame, customers: DataFrame, salts: int = TICKET_SALTS) -> DataFrame:
    """Inner join of tickets with their customer's row; a heavy hitter's row is copied once for each salt.

    The other customers' tickets join as they are, so no task gets more than a
    ``salts``-th of one customer's tickets, whatever its share of all rows.
    """
    parts = int(tickets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = materialize(heavy_hitters(tickets, parts))
    copies = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = customers.join(F.broadcast(heavy), "customer_id", "left").withColumn("_salt", F.explode(copies)).drop("_heavy")
    return salted_tickets(tickets, heavy, salts).join(right, ["customer_id", "_salt"]).drop("_salt")


def support_clean(support: DataFrame, customers: DataFrame) -> DataFrame:
    signup = customers.select("customer_id", "signup_date")
    return (join_customers_salted(support, signup)
            .where(F.col("ticket_date").cast("timestamp_ntz") >= F.col("signup_date"))
            .select("customer_id", "ticket_date", "category", "priority"))


def support_agg(support: DataFrame, customers: DataFrame) -> DataFrame:
    return support_from_days(support_customer_day(support), customers)


def support_from_days(daily: DataFrame, customers: DataFrame) -> DataFrame:
    """support_agg from the days of each customer."""
    kept = _with_signup(daily, customers).where(~F.col("_pre_signup"))
    return kept.groupBy("customer_id").agg(
        F.sum("n_tickets").alias("total_tickets"),
        F.sum("n_high").alias("high_priority_tickets"),
    )


def pre_signup_ticket_count(support: DataFrame, customers: DataFrame) -> DataFrame:
    flagged = _with_signup(support_customer_day(support), customers)
    return flagged.agg(
        F.coalesce(F.sum(F.when(F.col("_pre_signup"), F.col("n_tickets"))), F.lit(0))
        .cast("bigint").alias("issue_count"))


# ------------------------------------------------------------- flagship ----

def recency(customers: DataFrame, usage: DataFrame, stats: UsageStats) -> DataFrame:
    last = usage_features(usage, stats).select("customer_id", "last_active_date")
    rec = days_between(F.col("last_active_date"), stats.max_date)
    return (customers.select("customer_id").join(last, "customer_id", "left")
            .select("customer_id", "last_active_date", rec.alias("recency_days"),
                    churn_label(rec).alias("churn_label")))


def churn_features(tables: dict[str, DataFrame], stats: UsageStats | None = None) -> DataFrame:
    """analytics.churn_features: every customer kept, missing facts stay NULL."""
    customers, usage = tables["customers"], tables["usage_daily"]
    stats = stats or UsageStats(usage)
    uf = usage_features(usage, stats)
    ba = billing_agg(tables["billing"], stats)
    sa = support_agg(tables["support"], customers)
    return _assembled(customers, uf, ba, sa, stats)


def churn_features_from_days(days: dict[str, DataFrame], stats: UsageStats) -> DataFrame:
    """The same table from the (customer, day) roll-ups ``usage``, ``billing`` and ``support`` and ``customers``.

    Over layers that are bucketed by customer_id no aggregate and no join needs a shuffle.
    """
    customers = days["customers"]
    return _assembled(customers, usage_from_days(days["usage"], stats), billing_from_days(days["billing"], stats),
                      support_from_days(days["support"], customers), stats)


def recent_trends(customers: DataFrame, months: DataFrame, stats: UsageStats) -> DataFrame:
    """usage_trends of every customer, from the roll-up by month: only the months of the last 60 days are read.

    ``stats`` should be resolved, so that the bounds are literals and prune partitions.
    """
    first = F.date_sub(stats.max_date, C.TREND_PRIOR_DAYS)
    recent = months.where((F.col("month") >= F.date_format(first, "yyyyMM").cast("int")) & (F.col("date") >= first))
    trends = usage_from_days(recent, stats).select("customer_id", "avg_usage_last_30d", "avg_usage_prev_30d")
    return customers.select("customer_id").join(trends, "customer_id", "left").withColumn(
        "usage_trend_30d", F.col("avg_usage_last_30d") - F.col("avg_usage_prev_30d"))


def _assembled(customers: DataFrame, uf: DataFrame, ba: DataFrame, sa: DataFrame, stats: UsageStats) -> DataFrame:
    rec = days_between(F.col("last_active_date"), stats.max_date)
    joined = (customers
              .join(uf, "customer_id", "left")
              .join(ba, "customer_id", "left")
              .join(sa, "customer_id", "left"))
    return joined.select(
        "customer_id", "signup_date", "plan", "region", "last_active_date", "active_days",
        "avg_sessions", "avg_usage_minutes", "avg_usage_last_30d", "avg_usage_prev_30d",
        (F.col("avg_usage_last_30d") - F.col("avg_usage_prev_30d")).alias("usage_trend_30d"),
        "total_payment_issues", "failed_payments_30d", "zero_paid_anomalies",
        "total_tickets", "high_priority_tickets",
        rec.alias("recency_days"),
        churn_label(rec).alias("churn_label"),
    )


def observation_date(usage: DataFrame) -> DataFrame:
    return usage.agg(F.max("date").alias("obs_date"))


def risk_flags(features: DataFrame) -> DataFrame:
    """The three 0/1 flags; NULL inputs give 0."""
    return features.select(
        "*",
        flag(F.col("usage_trend_30d") < 0).alias("usage_decline_flag"),
        flag(F.col("total_tickets") >= C.HIGH_SUPPORT_MIN_TICKETS).alias("high_support_flag"),
        flag(F.col("total_payment_issues") >= C.PAYMENT_ISSUE_MIN).alias("payment_issue_flag"),
    )
