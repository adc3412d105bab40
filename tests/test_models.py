"""Model training, scoring, attribution and save/load on the smallest fixture."""

import pytest

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def trained(spark):
    from churnscope.operators import models as ml
    from churnscope.operators.features import churn_features
    from churnscope.session import materialize
    from churnscope.sources.staging import staged_from_root
    f = materialize(churn_features(staged_from_root(spark, SF_SMALL)))
    shared = ml.prepare_for_models(f)
    return (ml.train_logistic(f, shared),
            ml.train_forest(f, num_trees=20, min_leaf=5, prepared=shared))


def test_scores_are_probabilities(trained):
    from churnscope.operators import models as ml
    for t in trained:
        rows = ml.scores(t).collect()
        assert rows and all(0.0 <= r[t.score_col] <= 1.0 for r in rows)
        assert {r.split for r in rows} == {"test"}


def test_attribution_and_importance(trained):
    from churnscope.operators import models as ml
    lr, rf = trained
    att = ml.linear_attribution(lr).collect()
    assert len(att) == len(lr.features) and all(r.mean_abs_attribution >= 0 for r in att)
    imp = ml.forest_importance(rf).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0, abs=1e-6)
    perm = ml.permutation_importance(lr).collect()
    assert {r.feature for r in perm} == set(lr.features)


def test_save_load_roundtrip_and_missing(spark, trained, tmp_path):
    from churnscope.operators import cohort as co
    from churnscope.operators import models as ml
    from churnscope.operators import scenario
    from churnscope.operators.features import churn_features
    from churnscope.session import materialize
    from churnscope.sources.staging import staged_from_root
    lr, _ = trained
    path = str(tmp_path / "lr")
    ml.save_model(lr, path)
    loaded = ml.load_model(spark, path)
    # the loaded model scores an unprepared feature table, and cohorts can be targeted on it
    raw = churn_features(staged_from_root(spark, SF_SMALL))
    scored = materialize(loaded.score(raw))
    a = {r.customer_id: r.lr_score for r in ml.scores(lr, None).collect()}
    b = {r.customer_id: r.churn_risk_score for r in scored.collect()}
    assert a == pytest.approx(b)
    cohort = co.target_cohort(scored, co.CohortSpec(threshold=0.3))
    assert 0 < cohort.count() <= len(b)
    assert scenario.business_summary(cohort, scenario.Levers(15, True, True)).first().customers > 0
    with pytest.raises(ml.MissingModelError):
        ml.load_model(spark, str(tmp_path / "absent"))


def test_logistic_optimum_and_scores(trained):
    """The gradient vanishes at the trained weights, and scores are their sigmoid."""
    import numpy as np

    from churnscope.operators import models as ml
    lr, _ = trained
    w, b = np.array(lr.model.coefficients), lr.model.intercept
    pdf = lr.frame.toPandas()
    x = pdf[[f"x_{c}" for c in lr.features]].to_numpy()
    p = 1 / (1 + np.exp(-(x @ w + b)))
    got = {r.customer_id: r.lr_score for r in ml.scores(lr, None).collect()}
    assert [got[i] for i in pdf.customer_id] == pytest.approx(list(p))
    train = (pdf.split == "train").to_numpy()
    weight, y = pdf.class_weight.to_numpy()[train], pdf.churn_label.to_numpy()[train]
    residual = weight * (p[train] - y)
    gradient = np.append(w + x[train].T @ residual, b + residual.sum())  # the intercept is penalised too
    assert np.abs(gradient).max() < 1e-8 * max(1.0, weight.sum())


def test_forest_rows_are_dealt_into_bounded_tasks(spark, trained, monkeypatch):
    from pyspark.sql import functions as F

    from churnscope.operators import models as ml
    lr, rf = trained
    sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    one = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(None).cast("long").alias("v")).coalesce(1)
    assert sizes(ml.dealt_rows(one, ["k"], 1000)) == [1000]  # small enough: as it is
    dealt = ml.dealt_rows(one, ["k"], 100)
    assert len(sizes(dealt)) == 10 and max(sizes(dealt)) <= 110
    assert sorted(r.k for r in dealt.collect()) == list(range(1000))
    assert all(p == sorted(p) for p in dealt.rdd.map(lambda r: r.k).glom().collect())
    # the forest is trained on partitions of that size
    fitted_on = []
    fit = ml.Pipeline.fit
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, df: fitted_on.append(sizes(df)) or fit(self, df))
    monkeypatch.setattr(ml, "TASK_ROWS", 20)
    again = ml.train_forest(None, num_trees=3, min_leaf=5, prepared=(rf.frame.coalesce(1), rf.prep))
    rows = rf.frame.where("split = 'train'").count()
    assert rows > 40 and sum(fitted_on[0]) == rows and max(fitted_on[0]) <= 24
    assert ml.scores(again).count() == ml.scores(rf).count()
