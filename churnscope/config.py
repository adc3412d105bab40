"""Fixed values and declared schemas.

Everything here is a constant that results depend on.  Values marked
"FIXED VALUES" must equal the source system's literals for outputs to
match; the rest are this package's own parameters.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# FIXED VALUES (must match the source system's outputs exactly)
# --------------------------------------------------------------------------

# Data-quality check labels: (check_name, table_name), in definition order.
DQ_NEGATIVE_MINUTES = ("usage_minutes < 0", "usage_daily")
DQ_EXTREME_MINUTES = ("usage_minutes > P99.9", "usage_daily")
DQ_SESSION_MISMATCH = ("sessions = 0 AND usage_minutes > 0", "usage_daily")
DQ_ZERO_PAID = ("amount = 0 AND payment_status = paid", "billing")
DQ_BILLING_DUPLICATES = ("duplicate (customer_id, bill_date)", "billing")
DQ_PRE_SIGNUP_TICKETS = ("ticket_date < signup_date", "support")

# Lifecycle stages in display order (note the en dash in the middle one).
STAGE_ACTIVE = "Active"
STAGE_AT_RISK = "At Risk (31–45d)"
STAGE_CHURNED = "Churned"
LIFECYCLE_ORDER = [STAGE_ACTIVE, STAGE_AT_RISK, STAGE_CHURNED]

# Churn status names for label 1 / 0.
STATUS_CHURNED = "Churned"
STATUS_ACTIVE = "Active"

# Retention funnel stage names, in order.
FUNNEL_STAGES = [
    "Total Customers",
    "Active (<=30 days)",
    "At Risk (31-45 days)",
    "Churned (>45 days)",
]


# Label / stage day thresholds.
LABEL_CHURN_AFTER_DAYS = 45  # recency > 45 -> label 1
LABEL_ACTIVE_BELOW_DAYS = 30  # recency < 30 -> label 0
STAGE_ACTIVE_MAX_DAYS = 30  # recency <= 30 -> Active
STAGE_AT_RISK_MAX_DAYS = 45  # recency <= 45 -> At Risk

# Usage trend windows (days back from the global max usage date).
TREND_RECENT_DAYS = 30
TREND_PRIOR_DAYS = 60
USAGE_CAP_PERCENTILE = 0.999

# Flag thresholds.
HIGH_SUPPORT_MIN_TICKETS = 3
PAYMENT_ISSUE_MIN = 1

# Monthly revenue per plan used by the what-if (not the billed price).
PLAN_REVENUE = {"Free": 0, "Basic": 20, "Pro": 50, "Enterprise": 200}
# Billed price per plan (used by the bill-schedule spine).
PLAN_PRICE = {"Free": 0, "Basic": 29, "Pro": 99, "Enterprise": 299}
# Lever costs (per targeted customer per month) and uplift heuristics.
PRIORITY_SUPPORT_COST = 5
FEATURE_UNLOCK_COST = 3
DISCOUNT_UPLIFT_PER_PCT = 0.005
PRIORITY_SUPPORT_UPLIFT = 0.10
FEATURE_UNLOCK_UPLIFT = 0.07
CHURN_PROB_FLOOR = 0.05
DISCOUNT_CHOICES = [5, 10, 15, 20, 25, 30]

# Risk tier cut points.
MEDIUM_RISK_ABOVE = 0.3
HIGH_RISK_ABOVE = 0.6

# Targeting defaults.
DEFAULT_RISK_THRESHOLD = 0.6
DEFAULT_TARGET_PCT = 10
MAX_TARGET_PCT = 50

# Modelling: feature sets, winsorised columns, split.
NUMERIC_FEATURES = [
    "active_days",
    "avg_sessions",
    "avg_usage_minutes",
    "usage_trend_30d",
    "total_payment_issues",
    "failed_payments_30d",
    "total_tickets",
    "high_priority_tickets",
]
FLAG_FEATURES = ["usage_decline_flag", "high_support_flag", "payment_issue_flag"]
CATEGORICAL_FEATURES = ["plan", "region"]
WINSORIZE_FEATURES = ["total_payment_issues", "total_tickets"]
WINSOR_LOWER = 0.01
WINSOR_UPPER = 0.99
TEST_FRACTION = 0.25
SPLIT_SEED = 42
TOP_FRACTION = 0.10

# Medians reported by the exploration, in report order.
KEY_MEDIAN_COLUMNS = [
    "recency_days",
    "usage_trend_30d",
    "total_payment_issues",
    "failed_payments_30d",
    "total_tickets",
    "active_days",
    "avg_sessions",
    "avg_usage_minutes",
]

# Cohort vs overall mean comparisons, in display order.
COHORT_DELTA_COLUMNS = [
    "active_days",
    "avg_sessions",
    "avg_usage_minutes",
    "total_payment_issues",
    "total_tickets",
    "high_priority_tickets",
]

# Generator-derived rules re-aimed as Spark operators.
PLAN_ACTIVITY_BASE = {"Free": 0.22, "Basic": 0.35, "Pro": 0.50, "Enterprise": 0.70}
ACTIVITY_DECAY_DAYS = 220.0
BILL_FIRST_OFFSET_DAYS = 13
BILL_EVERY_DAYS = 13
TICKETS_PER_MONTH = 0.42
MAX_TENURE_MONTHS = 18
PAYMENT_STATUS_BUCKETS = [("paid", 0.75), ("late", 0.90), ("failed", 1.0)]

# --------------------------------------------------------------------------
# This package's own parameters
# --------------------------------------------------------------------------

# Fixed-coefficient scorecard: score = 1 / (1 + exp(-z)), rounded to 6
# decimals so every engine agrees on ties and threshold edges.
# z = intercept + plan offset + sum(coef * coalesce(feature, 0))
SCORECARD_INTERCEPT = 1.0
SCORECARD_PLAN_OFFSET = {"Free": 0.6, "Basic": 0.2, "Pro": -0.2, "Enterprise": -0.6}
SCORECARD_COEFFICIENTS = [
    ("usage_decline_flag", 0.8),
    ("high_support_flag", 0.6),
    ("payment_issue_flag", 0.5),
    ("failed_payments_30d", 0.3),
    ("active_days", -0.04),
]
SCORE_DECIMALS = 6

# Hash used for reproducible, partition-independent row assignment.  The
# id is reduced first so the multiply cannot overflow a signed 64-bit int.
HASH_MULTIPLIER = 73244475  # below 2^31, so that products with 32-bit numbers stay below 2^63
HASH_RANGE = 4294967296

# Cohort scenario defaults for the registered queries.
DEFAULT_DISCOUNT_PCT = 15

# --------------------------------------------------------------------------
# Declared staging schemas (column -> Spark type)
# --------------------------------------------------------------------------

CUSTOMERS_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("signup_date", T.TimestampNTZType()),
        T.StructField("plan", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)
USAGE_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("sessions", T.IntegerType()),
        T.StructField("usage_minutes", T.IntegerType()),
        T.StructField("feature_events", T.IntegerType()),
    ]
)
BILLING_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("bill_date", T.DateType()),
        T.StructField("amount", T.IntegerType()),
        T.StructField("payment_status", T.StringType()),
    ]
)
SUPPORT_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("ticket_date", T.DateType()),
        T.StructField("category", T.StringType()),
        T.StructField("priority", T.StringType()),
    ]
)
STAGING_SCHEMAS = {
    "customers": CUSTOMERS_SCHEMA,
    "usage_daily": USAGE_SCHEMA,
    "billing": BILLING_SCHEMA,
    "support": SUPPORT_SCHEMA,
}
