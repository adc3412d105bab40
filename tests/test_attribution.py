"""Shapley values of the forest, the whole-set permutation, the penalised Newton fit, the density curve."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnscope.operators import explore, forest, logistic, permute


# -- Shapley values ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def small_forest(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(400, 4)), 2)
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    rows = [(k, *map(float, r), float(a), float(1 + a)) for k, (r, a) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, c double, d double, y double, w double")
    df = VectorAssembler(inputCols=list("abcd"), outputCol="x").transform(df)
    model = RandomForestClassifier(featuresCol="x", labelCol="y", weightCol="w", numTrees=7, maxDepth=3, seed=5).fit(df)
    return model, df


def tree_value(nodes, x, known):
    """The tree's mean where only the ``known`` features are known, from its root down."""

    def at(k):
        n = nodes[k]
        if n.left < 0:
            return n.value
        if n.feature in known:
            return at(n.left if x[n.feature] <= n.threshold else n.right)
        l, r = nodes[n.left], nodes[n.right]
        return (l.weight * at(n.left) + r.weight * at(n.right)) / n.weight

    return at(0)


def plain_shapley(trees, x, features):
    out = np.zeros(features)
    for nodes in trees:
        for j in range(features):
            others = [i for i in range(features) if i != j]
            for size in range(features):
                weight = math.factorial(size) * math.factorial(features - size - 1) / math.factorial(features)
                for known in itertools.combinations(others, size):
                    out[j] += weight * (tree_value(nodes, x, {*known, j}) - tree_value(nodes, x, set(known)))
    return out / len(trees)


@pytest.mark.parametrize("paths", [1 << 16, 16])
def test_shapley_equals_all_subsets(spark, small_forest, monkeypatch, paths):
    from pyspark.ml.functions import vector_to_array

    monkeypatch.setattr(forest, "PATHS", paths)  # 16: blocks of two trees
    model, df = small_forest
    nodes = forest.node_table(model, spark)
    by_tree = {}
    for n in nodes.collect():
        by_tree.setdefault(n.tree, {})[n.node] = n
    table = forest.leaf_paths(nodes, 3)
    rows = df.where("customer_id % 16 = 3")
    got = {r.customer_id: r.contribution for r in forest.contributions(rows, "customer_id", list("abcd"), table, 7, 3).collect()}
    scores = {r.customer_id: r.p for r in model.transform(rows).select("customer_id", vector_to_array("probability")[1].alias("p")).collect()}
    expected = forest.expected_value(table).first().expected
    assert expected == pytest.approx(np.mean([tree_value(t, None, set()) for t in by_tree.values()]))
    for r in rows.collect():
        x = [r.a, r.b, r.c, r.d]
        assert got[r.customer_id] == pytest.approx(list(plain_shapley(list(by_tree.values()), x, 4)), abs=1e-9)
        assert sum(got[r.customer_id]) == pytest.approx(scores[r.customer_id] - expected, abs=1e-9)


def test_shares_of_leaves(spark, small_forest):
    model, _ = small_forest
    paths = forest.leaf_paths(forest.node_table(model, spark), 3)
    assert [r.s for r in paths.groupBy("tree").agg(F.sum("share").alias("s")).collect()] == pytest.approx([1.0] * 7)


def test_deep_paths_and_missing_values():
    """Eight features on a path and a missing value: the nodes still integrate without an error."""
    rng = np.random.default_rng(1)
    share, value = rng.uniform(0.1, 0.9, size=(1, 8)), np.array([2.0])
    feature, upper = np.arange(8)[None], np.zeros((1, 8))
    x = rng.normal(size=(3, 8))
    x[0, 2] = np.nan
    got = forest.shapley(x, (feature, np.full((1, 8), np.nan), upper, share, value))
    for row, phi in zip(x, got):
        passes = (row <= 0).astype(float)
        assert phi.sum() == pytest.approx(2.0 * (passes.prod() - share.prod()))
        j = 3
        want = 0.0
        others = [i for i in range(8) if i != j]
        for size in range(8):
            weight = math.factorial(size) * math.factorial(7 - size) / math.factorial(8)
            for known in itertools.combinations(others, size):
                rest = np.prod([passes[i] if i in known else share[0, i] for i in others])
                want += weight * 2.0 * rest * (passes[j] - share[0, j])
        assert phi[j] == pytest.approx(want)


def test_attribution_of_a_tree_without_a_split(spark):
    nodes = spark.createDataFrame([(0, 0, -1, None, -1, -1, 5.0, 0.4)], "tree int, node int, feature int, threshold double, left int, right int, weight double, value double")
    paths = forest.leaf_paths(nodes, 3)
    rows = spark.createDataFrame([(1, 0.5)], "customer_id long, a double")
    assert forest.contributions(rows, "customer_id", ["a"], paths, 1, 3).first().contribution == [0.0]
    assert forest.expected_value(paths).first().expected == pytest.approx(0.4)


# -- permutation ---------------------------------------------------------------------------


@pytest.mark.parametrize("ids", [range(1000), [7 * k - 2**40 for k in range(333)], [5]])
def test_each_row_is_donor_once(spark, ids):
    df = spark.createDataFrame([(k, float(k)) for k in ids], "customer_id long, v double")
    rows = permute.with_donor(df, "customer_id", ["customer_id", "v"], 42).collect()
    assert sorted(r.customer_id for r in rows) == sorted(ids) == sorted(r._donor.customer_id for r in rows)
    if len(ids) > 1:  # one cycle through all rows
        to, at, seen = {r.customer_id: r._donor.customer_id for r in rows}, ids[0], set()
        while at not in seen:
            seen.add(at)
            at = to[at]
        assert len(seen) == len(ids)


def test_numbers_are_the_order(spark):
    from churnscope.functions.columns import key_hash

    df = spark.range(5000).withColumnRenamed("id", "customer_id").repartition(7)
    rows = permute.numbered(df, "customer_id", 1).withColumn("h", key_hash("customer_id", 1)).orderBy("_number").collect()
    assert [r._number for r in rows] == list(range(5000)) and {r._rows for r in rows} == {5000}
    assert [(r.h, r.customer_id) for r in rows] == sorted((r.h, r.customer_id) for r in rows)


# -- Newton --------------------------------------------------------------------------------


def plain_newton(x, y, s, c=1.0):
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        gradient = w + c * x.T @ (s * (p - y))
        w = w - np.linalg.solve(np.eye(len(w)) + c * (x * (s * p * (1 - p))[:, None]).T @ x, gradient)
    return w, gradient


@pytest.mark.parametrize("scale", [1.0, 30.0])
def test_newton(spark, scale):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 3)) * scale
    y = (rng.random(600) < 1 / (1 + np.exp(-(x @ [0.8, -0.4, 0.0] / scale + 1.5)))).astype(int)
    s = np.where(y == 1, 0.7, 1.9)
    df = spark.createDataFrame([(*map(float, r), int(a), float(b)) for r, a, b in zip(x, y, s)], "a double, b double, c double, y int, s double").cache()
    model = logistic.fit(df, ["a", "b", "c"], "y", "s")
    want, _ = plain_newton(x, y, s)
    assert [*model.coefficients, model.intercept] == pytest.approx(list(want), abs=1e-6)
    assert np.abs(logistic._sums(df.withColumnsRenamed({"y": "_y", "s": "_s"}), ["a", "b", "c"], np.array([*model.coefficients, model.intercept]), 1.0)[1]).max() < 1e-6
    df.unpersist()


def test_newton_separable_and_empty(spark):
    rows = [(float(k), int(k > 0), 1.0) for k in range(-5, 6) if k]
    df = spark.createDataFrame(rows, "a double, y int, s double")
    model = logistic.fit(df, ["a"], "y", "s")
    assert model.coefficients[0] == pytest.approx(plain_newton(np.array([[r[0]] for r in rows]), np.array([r[1] for r in rows]), np.ones(10))[0][0], abs=1e-6)
    assert logistic.fit(df.limit(0), ["a"], "y", "s") == logistic.LinearModel(["a"], [0.0], 0.0)


# -- density -------------------------------------------------------------------------------


def test_density_against_the_exact_sum(spark):
    rng = np.random.default_rng(2)
    groups = {"Active": rng.normal(size=3000) * 4, "Churned": np.concatenate([rng.normal(size=500), rng.normal(size=200) + 9])}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [("Active", None), ("one", 1.0), ("flat", 2.0), ("flat", 2.0)], "g string, v double")
    rows = explore.density_by_group(df, "v", "g").collect()
    assert {r.g for r in rows} == set(groups) and len(rows) == 400
    for g, x in groups.items():
        bw = x.std(ddof=1) * len(x) ** -0.2
        grid = np.linspace(x.min(), x.max(), 200)
        exact = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(axis=1) / (len(x) * bw * math.sqrt(2 * math.pi))
        own = {r.grid_idx: r for r in rows if r.g == g}
        assert [own[k].grid_x for k in range(200)] == pytest.approx(list(grid), abs=1e-6)
        assert np.abs(np.array([own[k].density for k in range(200)]) - exact).max() < 1e-3 * exact.max()


def test_density_needs_rows_and_both_statuses(spark):
    def drawn(rows):
        return explore.usage_trend_density(spark.createDataFrame(rows, "churn_label int, usage_trend_30d double")).count()

    both = [(k % 2, float(k % 17)) for k in range(100)]
    assert drawn(both) == 400 and drawn(both[:99]) == 0 and drawn([(0, v) for _, v in both]) == 0
    assert drawn([*both[:99], (1, None), (None, 3.0)]) == 0


def test_display_rounding(spark):
    from churnscope.functions.columns import half_even

    values = [0.125, 2.675, -0.125, 1.005, 12.345678, 0.375, None]
    got = [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").orderBy("k").select(half_even("v", 2)).collect()]
    assert got == [*np.round(values[:-1], 2), None]
