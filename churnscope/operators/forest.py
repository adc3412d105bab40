"""Exact Shapley values of a tree ensemble, from its root-to-leaf paths.

The value of a set of known features is the tree's mean over the training rows in each
leaf, where unknown features go both ways in proportion to the training weight (path
dependence).  For one leaf of value v whose path tests the features 1..d, with o_i = 1
where the row passes all tests of feature i (else 0) and z_i the product of their shares,
the Shapley value of feature j is

    v * (o_j - z_j) * integral over t in [0, 1] of prod_{i != j} (z_i * (1 - t) + o_i * t),

because the integral gives each subset of the other features its Shapley weight.  The
integrand is a polynomial of degree d - 1 at most, so Gauss-Legendre nodes integrate it
without an error.  Values add over leaves and trees.

Paths are built from the saved model's node table by joins that climb from the leaves, one
level at a time.  Rows meet them inside Arrow batches; the paths of a block of trees are
broadcast, PATHS at most, and the blocks' values are summed by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.functions.columns import key_hash, round6
from churnscope.session import materialize, shared_path

#: Paths that a task holds at once; rows and paths of one step of the arithmetic.
PATHS, ROW_STEP, PATH_STEP = 1 << 16, 128, 256


def node_table(model, spark) -> DataFrame:
    """(tree, node, feature, threshold, left, right, weight, value) of a fitted forest's nodes.

    ``weight`` is the weighted number of training rows, ``value`` the share of class 1.
    """
    path = shared_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    stats = node["impurityStats"]
    weight = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), weight.alias("weight"), F.try_divide(stats[1], weight).alias("value"))


def leaf_paths(nodes: DataFrame, depth: int) -> DataFrame:
    """(tree, leaf, value, share, tests) of each leaf.

    ``tests`` has an entry for each feature of the path: the row passes it if
    lower < x <= upper (NULL: no bound), as ``share`` of the training weight does.
    ``depth`` bounds the length of a path.  ``share`` of the leaf is that of all its tests.
    """
    inner = nodes.where("left >= 0")
    goes = F.inline(F.array(F.struct(F.col("left").alias("at"), F.lit(None).cast("double").alias("lower"), F.col("threshold").alias("upper")),
                            F.struct(F.col("right").alias("at"), F.col("threshold").alias("lower"), F.lit(None).cast("double").alias("upper"))))
    edges = inner.select("tree", F.col("node").alias("parent"), "feature", F.col("weight").alias("whole"), goes)
    edges = edges.join(nodes.select("tree", F.col("node").alias("at"), "weight"), ["tree", "at"])
    edges = materialize(edges.select("tree", "at", "parent", F.struct("feature", "lower", "upper", (F.col("weight") / F.col("whole")).alias("share")).alias("test")))
    climbed = nodes.where("left < 0").select("tree", F.col("node").alias("leaf"), "value", F.col("node").alias("at"),
                                             F.array().cast(f"array<{edges.schema['test'].dataType.simpleString()}>").alias("path"))
    for _ in range(depth):
        climbed = climbed.join(edges, ["tree", "at"], "left").select(
            "tree", "leaf", "value", F.col("parent").alias("at"),
            F.when(F.col("test").isNotNull(), F.concat("path", F.array("test"))).otherwise(F.col("path")).alias("path"))
    climbed = materialize(climbed.select("tree", "leaf", "value", "path"))
    tests = climbed.select("tree", "leaf", F.inline("path")).groupBy("tree", "leaf", "feature").agg(
        F.max("lower").alias("lower"), F.min("upper").alias("upper"), F.product("share").alias("share"))
    tests = tests.groupBy("tree", "leaf").agg(F.collect_list(F.struct("feature", "lower", "upper", "share")).alias("tests"))  # depth entries at most
    share = F.aggregate("path", F.lit(1.0), lambda a, b: a * b["share"])
    return climbed.select("tree", "leaf", "value", share.alias("share")).join(tests, ["tree", "leaf"], "left")


def expected_value(paths: DataFrame) -> DataFrame:
    """One row, ``expected``: the mean score that the Shapley values start from."""
    trees = paths.groupBy("tree").agg(F.sum(F.col("value") * F.col("share")).alias("v"))
    return trees.agg(F.avg("v").alias("expected"))


def packed_paths(rows: list) -> tuple[np.ndarray, ...]:
    """feature, lower, upper, share (paths x tests; missing tests always pass) and value of collected paths."""
    width = max([1, *(len(r.tests or ()) for r in rows)])
    feature, share = np.zeros((len(rows), width), np.int64), np.ones((len(rows), width))
    lower, upper = np.full((len(rows), width), np.nan), np.full((len(rows), width), np.nan)
    for k, r in enumerate(rows):
        for j, test in enumerate(r.tests or ()):
            feature[k, j], share[k, j] = test.feature, test.share
            lower[k, j] = np.nan if test.lower is None else test.lower
            upper[k, j] = np.nan if test.upper is None else test.upper
    return feature, lower, upper, share, np.array([r.value or 0.0 for r in rows])


def shapley(x: np.ndarray, paths: tuple[np.ndarray, ...]) -> np.ndarray:
    """Rows x features: the Shapley values of the paths' leaves, summed."""
    feature, lower, upper, share, value = paths
    width = feature.shape[1]
    nodes, weights = np.polynomial.legendre.leggauss((width + 1) // 2)
    out = np.zeros(x.shape)
    for a in range(0, len(feature), PATH_STEP):
        f, lo, hi, z, v = (p[a : a + PATH_STEP] for p in paths)
        to_feature = np.zeros((f.size, x.shape[1]))
        to_feature[np.arange(f.size), f.ravel()] = 1.0
        for b in range(0, len(x), ROW_STEP):
            own = x[b : b + ROW_STEP][:, f]  # a missing value fails "x <= upper" only
            passes = (~(own <= lo) & ((own <= hi) | np.isnan(hi))).astype(float)
            integral = np.zeros(passes.shape)
            for t, w in zip((nodes + 1) / 2, weights / 2):
                term = z * (1 - t) + passes * t
                integral += w * term.prod(axis=2, keepdims=True) / term
            values = v[:, None] * (passes - z) * integral
            out[b : b + ROW_STEP] += values.reshape(len(values), -1) @ to_feature
    return out


def contributions(rows: DataFrame, key: str, features: list[str], paths: DataFrame, trees: int, depth: int) -> DataFrame:
    """(key, contribution: array by feature) of each row; ``features`` are the columns in the model's order.

    A row's values add up to its score minus the expected one.  Rows with one key are summed.
    """
    spark = rows.sparkSession
    block = max(1, PATHS >> depth)
    kind = rows.schema[key].dataType.simpleString()
    x = rows.select(key, F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    out = None
    for first in range(0, trees, block):
        some = paths.where((F.col("tree") >= first) & (F.col("tree") < first + block)).select("tests", "value").collect()
        sent = spark.sparkContext.broadcast(packed_paths(some))  # block << depth <= PATHS paths of depth tests

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    values = shapley(flat, sent.value) / trees
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(values), pa.list_(pa.float64()))], [key, "contribution"])

        part = x.mapInArrow(run, f"{key} {kind}, contribution array<double>")
        out = part if out is None else out.unionByName(part)
    sums = [F.sum(F.col("contribution")[k]).alias(f"c{k}") for k in range(len(features))]
    return out.groupBy(key).agg(*sums).select(key, F.array(*[f"c{k}" for k in range(len(features))]).alias("contribution"))


def forest_contributions(t, rows: int | None = 1000) -> tuple[DataFrame, DataFrame]:
    """(customer_id, contribution) of test rows of a trained forest, and its expected score.

    ``rows``: so many test rows, the first by key hash, as the source system explains only the
    first thousand; None takes all.
    """
    forest = t.model.stages[-1]
    spark = t.frame.sparkSession
    trees, depth = forest.getNumTrees, forest.getOrDefault("maxDepth")
    paths = materialize(leaf_paths(node_table(forest, spark), depth))
    test = t.frame.where(F.col("split") == "test")
    if rows is not None:
        test = materialize(test.orderBy(key_hash("customer_id", C.SPLIT_SEED), "customer_id").limit(rows)).repartition(8)
    return contributions(test, "customer_id", [f"x_{c}" for c in t.features], paths, trees, depth), expected_value(paths)


def forest_attribution(t, rows: int | None = 1000) -> DataFrame:
    """(rank, feature, mean_abs_attribution): the mean absolute Shapley value of each feature, largest first."""
    found, _ = forest_contributions(t, rows)
    names = F.array(*map(F.lit, t.features))
    long = found.select(F.inline(F.arrays_zip(names.alias("feature"), F.col("contribution"))))
    means = materialize(long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_attribution")))  # a row for each feature
    order = F.array_sort(F.collect_list(F.struct((-F.col("mean_abs_attribution")).alias("m"), "feature")))
    ranked = means.agg(order.alias("all")).select(F.posexplode("all").alias("place", "one"))
    return ranked.select((F.col("place") + 1).alias("rank"), F.col("one.feature").alias("feature"), round6(-F.col("one.m")).alias("mean_abs_attribution"))
