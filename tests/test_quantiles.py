"""Exact order statistics / percentiles / cutoffs against numpy brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnscope.functions.quantiles import exact_percentiles, order_statistics, rank_cutoff


def _frame(spark, n=20000, seed=7, nulls=True):
    rng = np.random.default_rng(seed)
    g = rng.choice(["a", "b", "c"], size=n, p=[0.6, 0.3, 0.1])
    # Heavy ties: a third of the rows share one value.
    v = np.where(rng.random(n) < 0.33, 5.0, np.round(rng.normal(0, 10, n), 3))
    vals = [None if (nulls and i % 97 == 0) else float(x) for i, x in enumerate(v)]
    rows = [(i, str(gg), x) for i, (gg, x) in enumerate(zip(g, vals))]
    return spark.createDataFrame(rows, "id long, g string, v double").repartition(5)


def test_exact_percentiles_grouped(spark):
    df = _frame(spark)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_percentiles(df, "v", probs, by=["g"])
    got = {(r.g, r.p): r.value for r in got.collect()}
    pdf = df.toPandas().dropna()
    for gname, part in pdf.groupby("g"):
        want = np.percentile(part.v.to_numpy(), [p * 100 for p in probs])
        for p, w in zip(probs, want):
            assert got[(gname, p)] == pytest.approx(w, abs=1e-9), (gname, p)


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "float", "date"])
def test_every_type_keeps_its_order(spark, kind):
    numbers = [-2**31, 2**31 - 1, -1, 0, 1, 7, 70_000, -70_000] if kind in ("int", "bigint") else [-40_000, 3, 0, 19_000]
    rows = [(i, n) for i, n in enumerate(numbers * 3)]
    df = spark.createDataFrame(rows, "id long, n long")
    value = F.date_add(F.lit("2000-01-01").cast("date"), F.col("n").cast("int")) if kind == "date" else F.col("n").cast(kind)
    df = df.withColumn("v", value)
    targets = spark.createDataFrame([(k, k) for k in range(len(rows))], "tid int, k long")
    got = [r.value for r in order_statistics(df, "v", targets).orderBy("tid").collect()]
    assert got == [r.v for r in df.orderBy("v").collect()]


def test_extreme_doubles(spark):
    values = [float("-inf"), -1e308, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in reversed(values)], "v double")
    targets = spark.createDataFrame([(k, k) for k in range(len(values))], "tid int, k long")
    assert [r.value for r in order_statistics(df, "v", targets).orderBy("tid").collect()] == values


def test_weights_count_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, 1), (9, 4), (None, 100)], "v int, c long")
    got = {r.p: r.value for r in exact_percentiles(df, "v", [0.0, 0.5, 1.0], weight="c").collect()}
    assert got == {0.0: 1.0, 0.5: 1.5, 1.0: 9.0}
    assert [r.value for r in exact_percentiles(df.where("false"), "v", [0.5], weight="c").collect()] == [None]


def test_ties_of_wide_ids(spark):
    rows = [(2**60 + k, 1.0) for k in range(1000)]
    quota = spark.createDataFrame([(100,)], "_take long")
    got = rank_cutoff(spark.createDataFrame(rows, "id long, v double"), "v", "id", quota).where("_selected")
    assert {r.id for r in got.collect()} == {2**60 + k for k in range(100)}


def test_order_statistics_out_of_range(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "v double")
    t = spark.createDataFrame([(0, 0), (1, 1), (2, 2), (3, -1)], "tid int, k long")
    got = {r.tid: r.value for r in order_statistics(df, "v", t).collect()}
    assert got == {0: 1.0, 1: 2.0, 2: None, 3: None}


@pytest.mark.parametrize("take", [0, 1, 7, 6000, 6600, 7000, 100000])
def test_rank_cutoff_matches_sort(spark, take):
    df = _frame(spark, nulls=True)
    quota = spark.createDataFrame([(take,)], "_take long")
    got = rank_cutoff(df, "v", "id", quota)
    sel = {r.id for r in got.where("_selected").select("id").collect()}
    pdf = df.toPandas().dropna().sort_values(["v", "id"], ascending=[False, True])
    want = set(pdf.id.head(take))
    assert sel == want


def test_rank_cutoff_grouped_ascending(spark):
    df = _frame(spark, n=5000, nulls=False)
    quota = spark.createDataFrame([("a", 100), ("b", 2000), ("c", 0)], "g string, _take long")
    got = rank_cutoff(df, "v", "id", quota, by=["g"], descending=False)
    assert got.count() == 5000
    sel = {r.id for r in got.where("_selected").collect()}
    pdf = df.toPandas().sort_values(["v", "id"])
    want = set()
    for gname, take in [("a", 100), ("b", 2000), ("c", 0)]:
        want |= set(pdf[pdf.g == gname].id.head(take))
    assert sel == want


def test_all_null_group_keeps_a_null_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "g string, v double")
    got = {(r.g, r.p): r.value
           for r in exact_percentiles(df, "v", [0.5], by=["g"]).collect()}
    assert got == {("a", 0.5): 2.0, ("b", 0.5): None}
