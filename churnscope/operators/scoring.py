"""Fixed-coefficient scorecard and ranking metrics (exact, distributed).

The scorecard gives every downstream operator (targeting, what-if,
evaluation) a churn risk any SQL engine can reproduce exactly:
score = round(1 / (1 + exp(-z)), 6), z a fixed linear function of the
feature table.  Trained models (``models.py``) produce the same column
name and can be swapped in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.functions.columns import round6
from churnscope.functions.quantiles import order_key, rank_cutoff
from churnscope.operators.prep import model_base, winsorized


def scorecard_z():
    z = F.lit(C.SCORECARD_INTERCEPT)
    plan = None
    for name, off in C.SCORECARD_PLAN_OFFSET.items():
        plan = (F.when(F.col("plan") == name, F.lit(off)) if plan is None
                else plan.when(F.col("plan") == name, F.lit(off)))
    z = z + plan.otherwise(F.lit(0.0))
    for feature, coef in C.SCORECARD_COEFFICIENTS:
        z = z + F.lit(coef) * F.coalesce(F.col(feature).cast("double"), F.lit(0.0))
    return z


def score(df: DataFrame) -> DataFrame:
    """Add churn_risk_score (expects the three flags on ``df``)."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-scorecard_z()))
    return df.withColumn("churn_risk_score", F.round(p, C.SCORE_DECIMALS))


def scored_customers(features: DataFrame) -> DataFrame:
    """The app's frame: labelled, flagged, winsorised, scored."""
    return score(winsorized(model_base(features)))


# ------------------------------------------------------------- metrics -----

def roc_auc(df: DataFrame, score_col: str = "churn_risk_score",
            label_col: str = "churn_label", by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC with half credit for ties: (by..., auc, positives, negatives).

    Rows collapse to distinct scores first (a hot score is one row).  The
    running count of negatives below each score is a prefix sum in three
    levels, over the digits of the score's order-preserving bits: no window
    holds more than 2^22 rows, however the scores crowd together.
    """
    counted = (df.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
               .groupBy(*by, F.col(score_col).cast("double").alias("s"))
               .agg(F.sum(F.col(label_col).cast("long")).alias("pos"),
                    F.sum((1 - F.col(label_col)).cast("long")).alias("neg")))
    per = counted.select(*by, "pos", "neg", order_key(counted, "s").alias("k")).select(
        "*", F.shiftright("k", 42).alias("d1"), F.shiftright("k", 21).alias("d2"))

    def below(rows: DataFrame, digit: str, above: list[str], name: str) -> DataFrame:
        w = Window.partitionBy(*by, *above).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(name, F.coalesce(F.sum("neg").over(w), F.lit(0)))

    by_d2 = per.groupBy(*by, "d1", "d2").agg(F.sum("neg").alias("neg"))
    by_d1 = by_d2.groupBy(*by, "d1").agg(F.sum("neg").alias("neg"))
    joined = (below(per, "k", ["d1", "d2"], "n3")
              .join(below(by_d2, "d2", ["d1"], "n2").select(*by, "d1", "d2", "n2"), [*by, "d1", "d2"])
              .join(below(by_d1, "d1", [], "n1").select(*by, "d1", "n1"), [*by, "d1"]))
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")  # products of counts may pass 2^63
    credit = pos * (F.col("n1") + F.col("n2") + F.col("n3")) + 0.5 * pos * neg
    tot = joined.groupBy(*by).agg(F.sum(credit).alias("credit"), F.sum("pos").alias("positives"),
                     F.sum("neg").alias("negatives"))
    auc = F.when((F.col("positives") > 0) & (F.col("negatives") > 0),
                 F.col("credit") / F.col("positives").cast("double") / F.col("negatives"))
    return tot.select(*by, round6(auc).alias("roc_auc"), "positives", "negatives")


def precision_at_top(df: DataFrame, fraction: float = C.TOP_FRACTION,
                     score_col: str = "churn_risk_score", label_col: str = "churn_label",
                     id_col: str = "customer_id", threshold: float = 0.5) -> DataFrame:
    """Top int(n * fraction) rows by score (ties: lower id first).

    ``precision_at_k`` divides true positives by the *predicted positives*
    (score > threshold) inside the top slice -- the classifier-precision
    reading; ``hit_rate_at_k`` divides the positives by k.
    """
    n = df.agg(F.count(F.lit(1)).alias("n"))
    quota = n.select(F.floor(F.col("n") * F.lit(fraction)).cast("long").alias("_take"))
    marked = rank_cutoff(df, score_col, id_col, quota).where(F.col("_selected"))
    pred = F.col(score_col) > threshold
    pos = F.col(label_col) == 1
    agg = marked.agg(F.count(F.lit(1)).alias("k"),
                     F.count_if(pred).alias("predicted_positives"),
                     F.count_if(pred & pos).alias("true_positives"),
                     F.count_if(pos).alias("positives_in_top"))
    return agg.select(
        "k", "predicted_positives", "true_positives",
        round6(F.when(F.col("predicted_positives") > 0,
                      F.col("true_positives") / F.col("predicted_positives"))
               .otherwise(F.lit(0.0))).alias("precision_at_k"),
        round6(F.when(F.col("k") > 0, F.col("positives_in_top") / F.col("k"))
               .otherwise(F.lit(0.0))).alias("hit_rate_at_k"))


def scorecard_attribution(df: DataFrame) -> DataFrame:
    """(feature, mean_abs_attribution): mean |coefficient * (x - mean x)| of each scorecard column, largest first."""
    names = [c for c, _ in C.SCORECARD_COEFFICIENTS]
    x = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])
    means = x.agg(*[F.avg(c).alias(f"_mu_{c}") for c in names])
    agg = x.crossJoin(F.broadcast(means)).agg(*[F.avg(F.abs(F.lit(w) * (F.col(c) - F.col(f"_mu_{c}")))).alias(c) for c, w in C.SCORECARD_COEFFICIENTS])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), round6(c).alias("mean_abs_attribution")) for c in names])
    return agg.select(F.inline(rows)).orderBy(F.desc("mean_abs_attribution"), "feature")


def comparison(parts: dict[str, DataFrame]) -> DataFrame:
    """(model, roc_auc, precision_at_k, hit_rate_at_k) of each named set of scored rows."""
    out = None
    for name, rows in parts.items():
        one = roc_auc(rows).select("roc_auc").crossJoin(precision_at_top(rows).select("precision_at_k", "hit_rate_at_k")).select(F.lit(name).alias("model"), "*")
        out = one if out is None else out.unionByName(one)
    return out
