"""Model preparation: labelled base, flags, winsorising, split, impute, scale, encode.

Fitted quantities (percentiles, medians, means, deviations, category lists,
class counts) are small aggregates; they are applied back with a broadcast
one-row (or one-row-per-class) join or, for the short category lists, as
literal columns.  Nothing customer-grained goes through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.functions.columns import clip, key_hash
from churnscope.functions.quantiles import Wanted, percentiles_of, rank_cutoff, wide_percentiles
from churnscope.operators.features import risk_flags
from churnscope.session import materialize


MAX_LEVELS = 256


def model_base(features: DataFrame) -> DataFrame:
    """Labelled customers with the three flags (flags use raw, unclipped values)."""
    return risk_flags(features.where(F.col("churn_label").isin(0, 1)))


def winsor_bounds(base: DataFrame, columns: Sequence[str] = C.WINSORIZE_FEATURES) -> DataFrame:
    """Exact p1/p99 per column over all labelled rows: (feature, p1, p99), in one selection."""
    q = percentiles_of(base, [Wanted(c, (C.WINSOR_LOWER, C.WINSOR_UPPER)) for c in columns])
    q = q.select(F.col("column").alias("feature"), "p", "value")
    return wide_percentiles(q, ["feature"], {C.WINSOR_LOWER: "p1", C.WINSOR_UPPER: "p99"}).select(
        "feature", "p1", "p99")


def winsorized(base: DataFrame, columns: Sequence[str] = C.WINSORIZE_FEATURES) -> DataFrame:
    """Clip each column to its [p1, p99]; NULL stays NULL; result is double."""
    bounds = winsor_bounds(base, columns)
    one = bounds.agg(*[F.first(F.when(F.col("feature") == c, F.struct("p1", "p99")),
                               ignorenulls=True).alias(f"_b_{c}") for c in columns])
    out = base.crossJoin(F.broadcast(one))
    for c in columns:
        b = F.col(f"_b_{c}")
        out = out.withColumn(c, clip(F.col(c).cast("double"), b["p1"], b["p99"]))
    return out.drop(*[f"_b_{c}" for c in columns])


def split_quota(base: DataFrame, test_fraction: float = C.TEST_FRACTION) -> DataFrame:
    """Train rows per class: proportional allocation, largest remainder.

    n_test = ceil(test_fraction * n); train quota per class is
    floor(n_c * n_train / n), and the leftover rows go to the classes with
    the largest remainders (ties: lower label first).
    """
    counts = base.groupBy("churn_label").agg(F.count(F.lit(1)).alias("n_c"))
    total = counts.agg(F.sum("n_c").alias("n"))
    t = counts.crossJoin(F.broadcast(total)).withColumn(
        "n_train", F.col("n") - F.ceil(F.col("n") * F.lit(test_fraction)).cast("long"))
    product = F.col("n_c").cast("decimal(19,0)") * F.col("n_train").cast("decimal(19,0)")  # may pass 2^63
    t = t.withColumn("rem", F.pmod(product, F.col("n").cast("decimal(38,0)")).cast("long"))
    t = t.withColumn("base_q", ((product - F.col("rem")) / F.col("n")).cast("long"))
    # The class table has one row per label: a global window over it is tiny.
    w = Window.orderBy(F.desc("rem"), F.asc("churn_label"))
    t = t.withColumn("_r", F.row_number().over(w))
    left = F.col("n_train") - F.sum("base_q").over(Window.partitionBy())
    return t.select("churn_label", "n_c",
                    (F.col("base_q") + F.when(F.col("_r") <= left, 1).otherwise(0))
                    .alias("_take"))


def stratified_split(base: DataFrame, seed: int = C.SPLIT_SEED,
                     test_fraction: float = C.TEST_FRACTION) -> DataFrame:
    """Add ``split`` (train/test): per class, the rows with the smallest key hash train.

    The hash depends only on (customer_id, seed), so the split is the same
    for any partitioning or row order.
    """
    hashed = base.withColumn("_h", key_hash("customer_id", seed))
    quota = split_quota(base, test_fraction).select("churn_label", "_take")
    marked = rank_cutoff(hashed, "_h", "customer_id", quota, by=["churn_label"], descending=False)
    return marked.withColumn("split", F.when(F.col("_selected"), "train").otherwise("test")).drop(
        "_h", "_selected")


# ---------------------------------------------------------- transformers ---

def fit_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: exact median per column (computed on the training rows)."""
    med = percentiles_of(train, [Wanted(c, (0.5,)) for c in columns])
    return med.agg(*[F.first(F.when(F.col("column") == c, F.col("value")), ignorenulls=True)
                     .alias(c) for c in columns])


def impute(df: DataFrame, medians: DataFrame, columns: Sequence[str]) -> DataFrame:
    m = medians.select(*[F.col(c).alias(f"_m_{c}") for c in columns])
    out = df.crossJoin(F.broadcast(m))
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")))
    return out.drop(*[f"_m_{c}" for c in columns])


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population deviation per column (0 deviation -> 1)."""
    aggs = []
    for c in columns:
        sd = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"_mu_{c}"),
                 F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd).alias(f"_sd_{c}")]
    return train.agg(*aggs)


def scale(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    out = df.crossJoin(F.broadcast(scaler))
    for c in columns:
        out = out.withColumn(c, (F.col(c) - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}"))
    return out.drop(*[x for c in columns for x in (f"_mu_{c}", f"_sd_{c}")])


def category_levels(train: DataFrame, column: str) -> list[str]:
    """Sorted distinct levels of a column, MAX_LEVELS at most: each becomes a feature column."""
    rows = train.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
    levels = [r[0] for r in rows.limit(MAX_LEVELS + 1).collect()]
    if len(levels) > MAX_LEVELS:
        raise ValueError(f"{column} has more than {MAX_LEVELS} levels; it isn't categorical")
    return levels


def onehot(df: DataFrame, levels: dict[str, list[str]]) -> tuple[DataFrame, list[str]]:
    """Indicator columns for every level but the alphabetically first; unknown -> all 0."""
    names = []
    out = df
    for column, cats in levels.items():
        for cat in cats[1:]:
            name = f"{column}_{cat}"
            out = out.withColumn(name, F.coalesce((F.col(column) == cat).cast("double"),
                                                  F.lit(0.0)))
            names.append(name)
    return out, names


def class_weights(train: DataFrame) -> DataFrame:
    """Balanced weights n / (classes * n_c) per label."""
    counts = train.groupBy("churn_label").agg(F.count(F.lit(1)).alias("n_c"))
    tot = counts.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    return (counts.crossJoin(F.broadcast(tot))
            .select("churn_label", "n_c",
                    (F.col("n") / (F.col("k") * F.col("n_c"))).alias("class_weight")))


@dataclass
class FittedPrep:
    """What preparation learned: small values that travel with a saved model.

    bounds: column -> (p1, p99) for clipping; medians and moments: column ->
    median, (mean, deviation) of the training rows; levels: category -> its
    sorted training levels.  Prepared columns are named ``x_`` + feature.
    """

    bounds: dict[str, list[float]]
    medians: dict[str, float | None]
    moments: dict[str, list[float]]
    levels: dict[str, list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.moments, *(f"{c}_{v}" for c, values in self.levels.items() for v in values[1:])]

    def clipped(self, column: str) -> Column:
        x = F.col(column).cast("double")
        return clip(x, *map(F.lit, self.bounds[column])) if column in self.bounds else x

    def apply(self, base: DataFrame) -> DataFrame:
        """``base`` (with flags, unclipped) plus the prepared columns, in one projection."""
        out = []
        for c, (mean, deviation) in self.moments.items():
            filled = F.coalesce(self.clipped(c), F.lit(self.medians[c]).cast("double"))
            out.append(((filled - F.lit(mean)) / F.lit(deviation)).alias(f"x_{c}"))
        for c, values in self.levels.items():
            out += [F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)).alias(f"x_{c}_{v}") for v in values[1:]]
        return base.select("*", *out)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> FittedPrep:
        return cls(**json.loads(text))


def prepared(features: DataFrame, numeric: Sequence[str] = C.NUMERIC_FEATURES) -> tuple[DataFrame, FittedPrep]:
    """The labelled customers with split and prepared columns, and the fitted preparation.

    Bounds come from all labelled rows, the rest from the training rows.  Each
    fit is one small aggregate; the split frame is the only one written.
    """
    split = materialize(stratified_split(model_base(features)))
    fitted = FittedPrep({r.feature: [r.p1, r.p99] for r in winsor_bounds(split).collect()}, {}, {}, {})
    columns = [*numeric, *C.FLAG_FEATURES]
    train = split.where(F.col("split") == "train")
    clipped = train.select(*[fitted.clipped(c).alias(c) for c in columns])
    fitted.medians = fit_medians(clipped, columns).first().asDict()
    moments = fit_scaler(clipped.select(*[F.coalesce(F.col(c), F.lit(fitted.medians[c]).cast("double")).alias(c) for c in columns]), columns).first()
    fitted.moments = {c: [moments[f"_mu_{c}"], moments[f"_sd_{c}"]] for c in columns if moments[f"_mu_{c}"] is not None}
    fitted.levels = {c: category_levels(train, c) for c in C.CATEGORICAL_FEATURES}
    return fitted.apply(split), fitted
