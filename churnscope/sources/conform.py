"""Derive the four subscription input tables from the star-schema test tables.

The source system reads four raw tables (customers, usage_daily, billing,
support).  The test data has none of them, so each is a deterministic view
over the order/lineitem star schema that deliberately carries every defect
the quality checks look for (negative and extreme minutes, session/minute
mismatches, zero-amount paid bills, duplicated bills, tickets before
signup, customers without usage or bills).

Scale notes
* ``nation`` (25 rows) and ``region`` (5 rows) have a fixed size at every
  scale factor, so broadcasting them is bounded.
* lineitem x orders is a key/foreign-key equi-join on the order key (at most
  seven lines per order: no skew); it stays a shuffle join chosen by the
  planner.  Filters on either side are applied before the join.
* The 2 % duplicated bill slice is produced with ``explode`` of a repeat
  count, not a second scan + union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.sources.tables import read_table

# FIXED VALUES of the conforming rules.
SIGNUP_EPOCH = "1995-01-01"
SIGNUP_SPREAD_DAYS = 720
FREE_SEGMENTS = ("HOUSEHOLD", "FURNITURE")
SEGMENT_PLAN = [("HOUSEHOLD", "Free"), ("FURNITURE", "Free"), ("MACHINERY", "Basic"),
                ("BUILDING", "Pro")]
OTHER_SEGMENT_PLAN = "Enterprise"
DUPLICATE_BILL_MODULUS = 50
BILL_DELAY_DAYS = 90
STATUS_BY_ORDER_STATUS = [("F", "paid"), ("O", "late")]
OTHER_ORDER_STATUS = "failed"
HIGH_PRIORITIES = ("1-URGENT", "2-HIGH")
MEDIUM_PRIORITY = "3-MEDIUM"


def _plan_from_segment(segment: Column) -> Column:
    expr = None
    for seg, plan in SEGMENT_PLAN:
        expr = (F.when(segment == seg, F.lit(plan)) if expr is None
                else expr.when(segment == seg, F.lit(plan)))
    return expr.otherwise(F.lit(OTHER_SEGMENT_PLAN))


def _round_to_int(c: Column) -> Column:
    # Round half-to-even before the cast, as an ANSI SQL engine's
    # double -> integer cast does (Spark's plain cast truncates).
    return F.bround(c).cast("int")


def conform_customers(spark: SparkSession, root: str) -> DataFrame:
    customer = read_table(spark, root, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, root, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, root, "region").select("r_regionkey", "r_name")
    signup = F.date_add(F.lit(SIGNUP_EPOCH).cast("date"),
                        F.pmod(F.col("c_custkey"), F.lit(SIGNUP_SPREAD_DAYS)).cast("int"))
    return (
        customer
        .join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey, "left")
        .join(F.broadcast(region), F.col("n_regionkey") == region.r_regionkey, "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            signup.cast("timestamp_ntz").alias("signup_date"),
            _plan_from_segment(F.col("c_mktsegment")).alias("plan"),
            F.col("r_name").alias("region"),
        )
    )


_LINE_COLUMNS = ["l_shipdate", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus"]


def customer_lines(spark: SparkSession, root: str) -> DataFrame:
    """The order lines with their customer and priority: what usage and support have in common.

    Each query reads the columns that it needs of it.  A rebuild of both tables writes it out
    once, so that the join runs once.
    """
    lines = read_table(spark, root, "lineitem").select("l_orderkey", *_LINE_COLUMNS)
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner").drop("l_orderkey", "o_orderkey")


def conform_usage(spark: SparkSession, root: str, lines: DataFrame | None = None) -> DataFrame:
    """usage_daily; several rows per customer-day are possible by design."""
    joined = customer_lines(spark, root) if lines is None else lines
    return joined.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_linenumber") - 1).cast("int").alias("sessions"),
        (F.floor(F.col("l_extendedprice") / 100).cast("int") - 20).alias("usage_minutes"),
        _round_to_int(F.col("l_quantity")).alias("feature_events"),
    )


def conform_billing(spark: SparkSession, root: str) -> DataFrame:
    """billing for paid plans; every 50th order key is billed twice."""
    orders = read_table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    paid_customers = (read_table(spark, root, "customer")
                      .where(~F.col("c_mktsegment").isin(*FREE_SEGMENTS))
                      .select("c_custkey"))
    status = None
    for code, name in STATUS_BY_ORDER_STATUS:
        status = (F.when(F.col("o_orderstatus") == code, F.lit(name)) if status is None
                  else status.when(F.col("o_orderstatus") == code, F.lit(name)))
    status = status.otherwise(F.lit(OTHER_ORDER_STATUS))
    copies = F.when(F.col("o_orderkey") % DUPLICATE_BILL_MODULUS == 0, 2).otherwise(1)
    return (
        orders.join(paid_customers, orders.o_custkey == paid_customers.c_custkey, "left_semi")
        .select(
            F.col("o_custkey").alias("customer_id"),
            F.date_add(F.col("o_orderdate").cast("date"), BILL_DELAY_DAYS).alias("bill_date"),
            F.floor(F.col("o_totalprice") / 10000).cast("int").alias("amount"),
            status.alias("payment_status"),
            F.explode(F.array_repeat(F.lit(1), copies)).alias("_copy"),
        )
        .drop("_copy")
    )


def conform_support(spark: SparkSession, root: str, lines: DataFrame | None = None) -> DataFrame:
    joined = customer_lines(spark, root) if lines is None else lines
    joined = joined.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    category = (F.when(F.col("l_linenumber") == 1, F.lit("billing"))
                .when(F.col("l_linenumber") <= 3, F.lit("technical"))
                .otherwise(F.lit("onboarding")))
    priority = (F.when(F.col("o_orderpriority").isin(*HIGH_PRIORITIES), F.lit("high"))
                .when(F.col("o_orderpriority") == MEDIUM_PRIORITY, F.lit("medium"))
                .otherwise(F.lit("low")))
    return joined.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_shipdate").cast("date").alias("ticket_date"),
        category.alias("category"),
        priority.alias("priority"),
    )


def conformed_tables(spark: SparkSession, root: str, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four raw input tables as lazy DataFrames; ``lines``: customer_lines, if they are written out."""
    return {
        "customers": conform_customers(spark, root),
        "usage_daily": conform_usage(spark, root, lines),
        "billing": conform_billing(spark, root),
        "support": conform_support(spark, root, lines),
    }
