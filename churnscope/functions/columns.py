"""Reusable column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnscope import config as C


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to_int(c: str | Column) -> Column:
    """double -> int rounding half to even (an ANSI SQL cast); Spark's cast truncates."""
    return F.bround(col(c)).cast("int")


def days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` as BIGINT (end - start)."""
    return F.datediff(col(end), col(start)).cast("bigint")


def flag(cond: Column) -> Column:
    """0/1 int flag; an unknown (NULL) condition counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def clip(c: str | Column, lower: Column, upper: Column) -> Column:
    """Clip keeping NULL as NULL (least/greatest would skip the NULL)."""
    c = col(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, lower), upper))


def ratio(num: Column, den: Column, default: Column | None = None) -> Column:
    """num / den as double; ``default`` (NULL if not given) when den is 0 or NULL."""
    out = F.when(den != 0, num.cast("double") / den)
    return out if default is None else out.otherwise(default)


def pct(num: Column, den: Column) -> Column:
    return ratio(num * F.lit(100.0), den, F.lit(0.0))


def churn_label(recency: str | Column) -> Column:
    r = col(recency)
    return (F.when(r > C.LABEL_CHURN_AFTER_DAYS, F.lit(1))
            .when(r < C.LABEL_ACTIVE_BELOW_DAYS, F.lit(0)))


def lifecycle_stage(recency: str | Column) -> Column:
    """Active <= 30 < At Risk <= 45 < Churned; unknown recency is Churned."""
    r = col(recency)
    return (F.when(r <= C.STAGE_ACTIVE_MAX_DAYS, F.lit(C.STAGE_ACTIVE))
            .when(r <= C.STAGE_AT_RISK_MAX_DAYS, F.lit(C.STAGE_AT_RISK))
            .otherwise(F.lit(C.STAGE_CHURNED)))


def churn_status(label: str | Column) -> Column:
    lab = col(label)
    return (F.when(lab == 1, F.lit(C.STATUS_CHURNED))
            .when(lab == 0, F.lit(C.STATUS_ACTIVE)))


def plan_revenue(plan: str | Column) -> Column:
    """Monthly revenue per plan; an unknown plan maps to NULL."""
    p = col(plan)
    expr = None
    for name, value in C.PLAN_REVENUE.items():
        expr = (F.when(p == name, F.lit(value)) if expr is None
                else expr.when(p == name, F.lit(value)))
    return expr


def bucket_by_cumulative(u: Column, buckets: list[tuple[str, float]]) -> Column:
    """Map a uniform in [0, 1) to the first bucket whose cumulative bound exceeds it."""
    expr = None
    for name, bound in buckets[:-1]:
        expr = (F.when(u < bound, F.lit(name)) if expr is None
                else expr.when(u < bound, F.lit(name)))
    last = F.lit(buckets[-1][0])
    return last if expr is None else expr.otherwise(last)


def key_hash(key: str | Column, seed: int = 0) -> Column:
    """Deterministic 32-bit hash of an integer key, identical in any SQL engine.

    Both halves of the id are mixed with the seed by multiply and xor-shift rounds; every
    product of two 32-bit numbers below 2^63 stays inside a signed 64-bit integer.
    """
    k = col(key).cast("bigint")
    m, size = F.lit(C.HASH_MULTIPLIER).cast("bigint"), F.lit(C.HASH_RANGE).cast("bigint")
    low = F.lit(C.HASH_RANGE - 1).cast("bigint")
    out = F.lit(seed * C.HASH_MULTIPLIER % C.HASH_RANGE).cast("bigint")
    for part in (k.bitwiseAND(low), F.shiftright(k, 32).bitwiseAND(low), F.lit(0).cast("bigint")):
        out = F.pmod(out.bitwiseXOR(part) * m, size)
        out = out.bitwiseXOR(F.shiftright(out, 15))
    return out


def key_uniform(key: str | Column, seed: int = 0) -> Column:
    """A uniform in [0, 1) derived from ``key_hash``."""
    return key_hash(key, seed).cast("double") / F.lit(float(C.HASH_RANGE))


def round6(c: str | Column) -> Column:
    return F.round(col(c), C.SCORE_DECIMALS)


def half_even(c: str | Column, decimals: int) -> Column:
    """The value for display: scaled, rounded half to even, scaled back."""
    scale = float(10**decimals)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def fixed(c: str | Column, decimals: int) -> Column:
    """Fixed-point text like printf("%.<d>f"): half-even on the exact binary value."""
    return F.regexp_replace(F.format_number(col(c), decimals), ",", "")
