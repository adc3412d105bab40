"""One random permutation of all rows, and the AUC that each feature loses by it.

Rows are put in a total order by (key hash, key) and numbered in two levels: the upper 16
bits of the hash deal them into 65,536 buckets, a bucket's first number is the sum of the
smaller buckets' counts, and a row's own number counts on inside its bucket.  So no window
holds all rows, and the numbers don't depend on the partitioning.  Each row then gets the
values of the row numbered one higher (the last of the first), by a join on the number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.functions.columns import key_hash, round6
from churnscope.operators.scoring import roc_auc
from churnscope.session import materialize

_BUCKET_BITS = 16


def numbered(df: DataFrame, key: str, seed: int) -> DataFrame:
    """``df`` with ``_number``: 0, 1, ... in the order of (key hash, key), and ``_rows``, their count; ``key`` is unique."""
    hashed = df.withColumn("_h", key_hash(key, seed)).withColumn("_bucket", F.shiftright("_h", 32 - _BUCKET_BITS))
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_c"))  # 65,536 rows at most
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_bucket", before.alias("_before"), F.sum("_c").over(Window.partitionBy()).alias("_rows"))
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy("_h", key)) - 1
    return hashed.withColumn("_own", own).join(F.broadcast(starts), "_bucket").withColumn("_number", F.col("_before") + F.col("_own")) \
        .drop("_h", "_bucket", "_own", "_before")


def with_donor(df: DataFrame, key: str, columns: Sequence[str], seed: int) -> DataFrame:
    """``df`` with ``_donor``: a struct of another row's ``columns``, each row being donor once."""
    ranked = materialize(numbered(df, key, seed))
    donor = ranked.select(F.pmod(F.col("_number") - 1, F.col("_rows")).alias("_number"), F.struct(*columns).alias("_donor"))
    return ranked.join(donor, "_number").drop("_number", "_rows")


def importance(df: DataFrame, key: str, features: Sequence[str], score: Callable[[DataFrame], DataFrame],
               seed: int = C.SPLIT_SEED, prefix: str = "") -> DataFrame:
    """(feature, base_auc, permuted_auc, auc_drop): the AUC that is lost when one feature comes from the donor.

    ``score`` adds churn_risk_score to rows with ``prefix`` + feature columns and churn_label.
    All features are scored and ranked in one job.
    """
    columns = [f"{prefix}{c}" for c in features]
    long = with_donor(df, key, columns, seed).withColumn("feature", F.explode(F.array(F.lit(""), *map(F.lit, features))))
    for feature, c in zip(features, columns):
        long = long.withColumn(c, F.when(F.col("feature") == feature, F.col(f"_donor.{c}")).otherwise(F.col(c)))
    scored = score(long).select("feature", "churn_label", "churn_risk_score")
    aucs = materialize(roc_auc(scored, by=["feature"]).select("feature", "roc_auc"))  # a row for each feature
    base = aucs.where("feature = ''").select(F.col("roc_auc").alias("base_auc"))
    return (aucs.where("feature <> ''").withColumnRenamed("roc_auc", "permuted_auc").crossJoin(F.broadcast(base))
            .select("feature", "base_auc", "permuted_auc", round6(F.col("base_auc") - F.col("permuted_auc")).alias("auc_drop"))
            .orderBy(F.desc("auc_drop"), "feature"))
