"""Scale guard: a single-partition exchange only ever moves aggregated rows.

Walks the executed (final adaptive) plan tree: below every SinglePartition
shuffle, the first operator that is not a projection/filter/codegen wrapper
must be an aggregate.  Checked on the scalable paths (forced), AUC and the
flagship.
"""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

PASS_THROUGH = ("ProjectExec", "FilterExec", "WholeStageCodegenExec", "InputAdapter",
                "ColumnarToRowExec", "AQEShuffleReadExec", "ShuffleQueryStageExec",
                "ReusedExchangeExec")


def _children(node):
    return [node.children().apply(i) for i in range(node.children().size())]


def _name(node):
    return node.getClass().getSimpleName()


def _stage_plan(node):
    # Query stages (shuffle, broadcast, result, ...) wrap their plan; step into it.
    while _name(node).endswith("QueryStageExec"):
        node = node.plan()
    return node


def _violations(root):
    bad = []

    def first_real(node):
        node = _stage_plan(node)
        while _name(node) in PASS_THROUGH and _children(node):
            node = _stage_plan(_children(node)[0])
        return node

    def walk(node):
        node = _stage_plan(node)
        name = _name(node)
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
            return
        if name == "ShuffleExchangeExec" and \
                "SinglePartition" in node.outputPartitioning().toString():
            child = first_real(_children(node)[0])
            if "Aggregate" not in _name(child):
                bad.append(_name(child))
        for c in _children(node):
            walk(c)
        for sub in [node.subqueries().apply(i) for i in range(node.subqueries().size())]:
            walk(sub)

    walk(root)
    return bad


def _check(df):
    df.collect()
    assert _violations(df._jdf.queryExecution().executedPlan()) == []


def test_bracket_percentiles(spark):
    from churnscope.functions.quantiles import exact_percentiles
    df = spark.range(20000).select((F.col("id") % 977).cast("double").alias("v"),
                                   (F.col("id") % 3).alias("g"))
    _check(exact_percentiles(df, "v", [0.1, 0.5], by=["g"]))
    _check(exact_percentiles(df, "v", [0.5]))


def test_bracket_cutoff(spark):
    from churnscope.functions.quantiles import rank_cutoff
    df = spark.range(20000).select("id", ((F.col("id") * 7919) % 1000).cast("double").alias("v"))
    quota = spark.createDataFrame([(1234,)], "_take long")
    _check(rank_cutoff(df, "v", "id", quota).where("_selected"))


def test_auc(spark):
    from churnscope.operators.scoring import roc_auc
    df = spark.range(20000).select(
        ((F.col("id") * 7919) % 1000 / 1000.0).alias("churn_risk_score"),
        (F.col("id") % 2).cast("int").alias("churn_label"))
    _check(roc_auc(df))


@pytest.mark.parametrize("key", ["churn_features", "dq_summary", "calendar_spine"])
def test_registered(spark, key):
    import __spark_entry__ as entry
    _check(entry.queries()[key](spark, SF_SMALL))


def test_guard_flags_a_global_window(spark):
    from pyspark.sql import Window
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"))
    bad = df.withColumn("r", F.row_number().over(Window.orderBy("v")))
    bad.collect()
    assert _violations(bad._jdf.queryExecution().executedPlan()) != []
