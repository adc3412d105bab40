"""Data-quality checks: one row per check (issue_count, check_name, table_name).

The three usage checks share one scan (conditional counts in a single
aggregation); the two billing checks share one (customer, bill_date)
grouping.  The p99.9 threshold is the same scalar the feature table uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.operators.features import UsageStats, pre_signup_ticket_count

CHECK_ORDER = [
    C.DQ_NEGATIVE_MINUTES, C.DQ_EXTREME_MINUTES, C.DQ_SESSION_MISMATCH,
    C.DQ_ZERO_PAID, C.DQ_BILLING_DUPLICATES, C.DQ_PRE_SIGNUP_TICKETS,
]


def _labelled(counts: DataFrame, column: str, check: tuple[str, str]) -> DataFrame:
    name, table = check
    return counts.select(F.col(column).cast("bigint").alias("issue_count"),
                         F.lit(name).alias("check_name"), F.lit(table).alias("table_name"))


def usage_check_counts(usage: DataFrame, stats: UsageStats) -> DataFrame:
    m, s = F.col("usage_minutes"), F.col("sessions")
    return usage.agg(
        F.count_if(m < 0).alias("negative"),
        F.count_if(m > stats.p999).alias("extreme"),
        F.count_if((s == 0) & (m > 0)).alias("mismatch"),
    )


def billing_check_counts(billing: DataFrame) -> DataFrame:
    zero_paid = (F.col("amount") == 0) & (F.col("payment_status") == "paid")
    per_key = billing.groupBy("customer_id", "bill_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(zero_paid).alias("zp"))
    return per_key.agg(
        F.coalesce(F.sum("zp"), F.lit(0)).alias("zero_paid"),
        # NULL (not 0) when no key is duplicated.
        F.sum(F.when(F.col("n") > 1, F.col("n") - 1)).alias("duplicates"),
    )


def dq_negative_minutes(tables: dict[str, DataFrame]) -> DataFrame:
    usage = tables["usage_daily"]
    counts = usage.agg(F.count_if(F.col("usage_minutes") < 0).alias("c"))
    return _labelled(counts, "c", C.DQ_NEGATIVE_MINUTES)


def dq_extreme_minutes(tables: dict[str, DataFrame]) -> DataFrame:
    usage = tables["usage_daily"]
    stats = UsageStats(usage)
    counts = usage.agg(F.count_if(F.col("usage_minutes") > stats.p999).alias("c"))
    return _labelled(counts, "c", C.DQ_EXTREME_MINUTES)


def dq_session_mismatch(tables: dict[str, DataFrame]) -> DataFrame:
    usage = tables["usage_daily"]
    counts = usage.agg(
        F.count_if((F.col("sessions") == 0) & (F.col("usage_minutes") > 0)).alias("c"))
    return _labelled(counts, "c", C.DQ_SESSION_MISMATCH)


def dq_zero_paid(tables: dict[str, DataFrame]) -> DataFrame:
    billing = tables["billing"]
    counts = billing.agg(F.count_if(
        (F.col("amount") == 0) & (F.col("payment_status") == "paid")).alias("c"))
    return _labelled(counts, "c", C.DQ_ZERO_PAID)


def dq_billing_duplicates(tables: dict[str, DataFrame]) -> DataFrame:
    return _labelled(billing_check_counts(tables["billing"]), "duplicates",
                     C.DQ_BILLING_DUPLICATES)


def dq_pre_signup_tickets(tables: dict[str, DataFrame]) -> DataFrame:
    counts = pre_signup_ticket_count(tables["support"], tables["customers"])
    return _labelled(counts, "issue_count", C.DQ_PRE_SIGNUP_TICKETS)


def dq_summary(tables: dict[str, DataFrame], stats: UsageStats | None = None) -> DataFrame:
    """All six checks with three scans in total, ordered by table then check."""
    usage = tables["usage_daily"]
    stats = stats or UsageStats(usage)
    u = usage_check_counts(usage, stats)
    b = billing_check_counts(tables["billing"])
    s = pre_signup_ticket_count(tables["support"], tables["customers"])
    # Three one-row aggregates side by side (bounded 1 x 1 x 1 product),
    # then unpivoted into six rows: every source is scanned once.
    one_row = u.crossJoin(b).crossJoin(s)
    sources = ["negative", "extreme", "mismatch", "zero_paid", "duplicates", "issue_count"]
    rows = F.array(*[
        F.struct(F.col(src).cast("bigint").alias("issue_count"),
                 F.lit(check[0]).alias("check_name"), F.lit(check[1]).alias("table_name"))
        for src, check in zip(sources, CHECK_ORDER)
    ])
    return one_row.select(F.inline(rows)).orderBy("table_name", "check_name")
