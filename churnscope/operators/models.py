"""Trained churn models, their evaluation and attribution.

Preparation (winsorise, stratified split, median impute, population
scaling, one-hot dropping the first level) comes from ``prep`` and is fitted
on the training rows only; the fitted model and the prepared columns are
re-used for scoring, so train and serve see the same transformation.

* Logistic regression: L2 with C = 1, the intercept penalised like a weight, balanced
  class weights; damped Newton steps (``logistic.py``), scored as one expression.
* Random forest: 200 trees, depth 8, min 100 rows per leaf, sqrt feature
  subsets, balanced class weights, seed 42 (all parameters).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.functions.columns import round6
from churnscope.operators import logistic, permute, prep
from churnscope.operators.scoring import precision_at_top, roc_auc
from churnscope.session import materialize


Model = PipelineModel | logistic.LinearModel

#: Training rows that a task of the forest reads, about: each is kept with a count and a node for
#: every tree, 2.7 KB for 200 trees.  A task also sends statistics of all nodes of a level, so far
#: smaller tasks would shuffle more.
TASK_ROWS = 100_000


def with_score(model: Model, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with prepared columns plus the model's probability of churn."""
    if isinstance(model, logistic.LinearModel):
        return rows.withColumn(name, model.probability())
    return model.transform(rows).withColumn(name, vector_to_array("probability")[1]).drop("x", "rawPrediction", "probability", "prediction")


@dataclass
class Trained:
    model: Model
    features: list[str]
    frame: DataFrame  # labelled rows with split, class_weight and prepared columns
    score_col: str
    prep: prep.FittedPrep


@dataclass
class Scorer:
    """A model with its fitted preparation: scores feature tables as they are."""

    model: Model
    prep: prep.FittedPrep

    def score(self, features: DataFrame) -> DataFrame:
        """The labelled customers of a feature table with flags and churn_risk_score, ready for targeting."""
        base = prep.model_base(features)
        return with_score(self.model, self.prep.apply(base), "churn_risk_score").select(*base.columns, "churn_risk_score")


def prepare_for_models(features: DataFrame) -> tuple[DataFrame, prep.FittedPrep]:
    """One preparation shared by both models (numeric + flags + one-hot, weights)."""
    frame, fitted = prep.prepared(features)
    weights = prep.class_weights(frame.where(F.col("split") == "train"))
    frame = frame.join(F.broadcast(weights.select("churn_label", "class_weight")), "churn_label")
    return materialize(frame), fitted


def _assembler(cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"x_{c}" for c in cols], outputCol="x")


def train_logistic(features: DataFrame, prepared=None) -> Trained:
    frame, fitted = prepared or prepare_for_models(features)
    cols = [c for c in fitted.features if c not in C.FLAG_FEATURES]
    train = frame.where(F.col("split") == "train")
    model = logistic.fit(train, [f"x_{c}" for c in cols], "churn_label", "class_weight")
    return Trained(model, cols, frame, "lr_score", fitted)


def dealt_rows(train: DataFrame, order: list[str], most: int | None = None) -> DataFrame:
    """``train`` in partitions of about ``most`` rows, sorted by ``order``; as it is if none has more.

    The files of a scan are grouped by their compressed bytes, so one partition may hold all rows.
    """
    most = most or TASK_ROWS
    found = train.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    if (found[1] or 0) <= most:
        return train
    return train.repartition(-(-found[0] // most)).sortWithinPartitions(*order)


def train_forest(features: DataFrame, num_trees: int = 200, max_depth: int = 8,
                 min_leaf: int = 100, seed: int = C.SPLIT_SEED, prepared=None) -> Trained:
    frame, fitted = prepared or prepare_for_models(features)
    cols = fitted.features
    train = dealt_rows(frame.where(F.col("split") == "train"), ["customer_id", "churn_label", *(f"x_{c}" for c in cols)])
    rf = RandomForestClassifier(featuresCol="x", labelCol="churn_label", weightCol="class_weight",
                                numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt",
                                seed=seed, maxMemoryInMB=1024, cacheNodeIds=True)
    model = Pipeline(stages=[_assembler(cols), rf]).fit(
        train.withColumn("churn_label", F.col("churn_label").cast("double")))
    return Trained(model, cols, frame, "rf_score", fitted)


def scores(t: Trained, split: str | None = "test") -> DataFrame:
    rows = t.frame if split is None else t.frame.where(F.col("split") == split)
    return with_score(t.model, rows, t.score_col).select("customer_id", "churn_label", "split", t.score_col)


def evaluation(t: Trained, name: str) -> DataFrame:
    test = scores(t).withColumnRenamed(t.score_col, "churn_risk_score")
    auc = roc_auc(test).select("roc_auc")
    prec = precision_at_top(test).select("precision_at_k", "hit_rate_at_k")
    return auc.crossJoin(prec).select(F.lit(name).alias("model"), "*")


def lr_drivers(t: Trained, top: int = 10) -> DataFrame:
    """Top positive and negative coefficients by magnitude."""
    spark = t.frame.sparkSession
    df = spark.createDataFrame(list(zip(t.features, t.model.coefficients)), "feature string, coefficient double")
    pos = (df.where("coefficient > 0").orderBy(F.desc(F.abs("coefficient")), "feature").limit(top)
           .select(F.lit("positive").alias("direction"), "feature", round6("coefficient").alias("coefficient")))
    neg = (df.where("coefficient < 0").orderBy(F.desc(F.abs("coefficient")), "feature").limit(top)
           .select(F.lit("negative").alias("direction"), "feature", round6("coefficient").alias("coefficient")))
    return pos.unionByName(neg)


def forest_importance(t: Trained) -> DataFrame:
    imp = t.model.stages[-1].featureImportances.toArray().tolist()
    spark = t.frame.sparkSession
    return (spark.createDataFrame(list(zip(t.features, [float(v) for v in imp])),
                                  "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))


def linear_attribution(t: Trained) -> DataFrame:
    """Exact linear attribution mean |w_j * (x_j - mean_j)| over the test rows, one pass."""
    coefs = t.model.coefficients
    test = t.frame.where(F.col("split") == "test")
    means = t.frame.where(F.col("split") == "train").agg(
        *[F.avg(f"x_{c}").alias(f"_mu_{c}") for c in t.features])
    x = test.crossJoin(F.broadcast(means))
    agg = x.agg(*[F.avg(F.abs(F.lit(w) * (F.col(f"x_{c}") - F.col(f"_mu_{c}")))).alias(c)
                  for c, w in zip(t.features, coefs)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs_attribution"))
                     for c in t.features])
    return (agg.select(F.inline(rows))
            .select("feature", round6("mean_abs_attribution").alias("mean_abs_attribution"))
            .orderBy(F.desc("mean_abs_attribution"), "feature"))


def permutation_importance(t: Trained, seed: int = C.SPLIT_SEED) -> DataFrame:
    """AUC drop when one feature's values are permuted over all test rows (``permute.importance``)."""
    test = t.frame.where(F.col("split") == "test")
    return permute.importance(test, "customer_id", t.features, lambda rows: with_score(t.model, rows, "churn_risk_score"), seed, prefix="x_")


class MissingModelError(FileNotFoundError):
    pass


def _write_text(spark, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def save_model(t: Trained, path: str) -> None:
    """The model and its fitted preparation, under one folder (``model`` or, of a linear one, ``linear``)."""
    spark = t.frame.sparkSession
    if isinstance(t.model, logistic.LinearModel):
        _write_text(spark, t.model.to_json(), f"{path}/linear")
    else:
        t.model.write().overwrite().save(f"{path}/model")
    _write_text(spark, t.prep.to_json(), f"{path}/prep")


def load_model(spark, path: str) -> Scorer:
    """Load a saved model with its preparation; a named error (before any job) when it is absent."""
    jvm = spark.sparkContext._jvm

    def exists(name: str) -> bool:
        hpath = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)

    linear = exists("linear")
    if not linear and not exists("model"):
        raise MissingModelError(f"no model at {path}; train and save it first")
    fitted = prep.FittedPrep.from_json(spark.read.text(f"{path}/prep").first().value)
    if linear:
        return Scorer(logistic.LinearModel.from_json(spark.read.text(f"{path}/linear").first().value), fitted)
    return Scorer(PipelineModel.load(f"{path}/model"), fitted)
