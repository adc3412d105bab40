"""The registered queries, grouped as in the operator inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.operators import features as feat
from churnscope.operators import quality as dq
from churnscope.plans.registry import query
from churnscope.session import materialize

Tables = dict[str, DataFrame]

# ------------------------------------------------------------ staging ------


@query("stage_customers")
def _stage_customers(t: Tables) -> DataFrame:
    return t["customers"]


@query("stage_usage_daily")
def _stage_usage(t: Tables) -> DataFrame:
    return t["usage_daily"]


@query("stage_billing")
def _stage_billing(t: Tables) -> DataFrame:
    return t["billing"]


@query("stage_support")
def _stage_support(t: Tables) -> DataFrame:
    return t["support"]


# ------------------------------------------------------------ quality ------

for _name in ["dq_negative_minutes", "dq_extreme_minutes", "dq_session_mismatch",
              "dq_zero_paid", "dq_billing_duplicates", "dq_pre_signup_tickets", "dq_summary"]:
    query(_name)(getattr(dq, _name))


# ----------------------------------------------------------- features ------


@query("usage_p999")
def _usage_p999(t: Tables) -> DataFrame:
    return feat.usage_stats_frame(t["usage_daily"]).select("p999_minutes")


@query("observation_date")
def _observation_date(t: Tables) -> DataFrame:
    return feat.observation_date(t["usage_daily"])


@query("usage_clean")
def _usage_clean(t: Tables) -> DataFrame:
    u = t["usage_daily"]
    return feat.usage_clean(u, feat.UsageStats(u))


@query("usage_agg")
def _usage_agg(t: Tables) -> DataFrame:
    u = t["usage_daily"]
    return feat.usage_agg(u, feat.UsageStats(u))


@query("usage_trends")
def _usage_trends(t: Tables) -> DataFrame:
    u = t["usage_daily"]
    return feat.usage_trends(u, feat.UsageStats(u))


@query("usage_trend_relative")
def _usage_trend_relative(t: Tables) -> DataFrame:
    u = t["usage_daily"]
    return feat.usage_trend_relative(u, feat.UsageStats(u))


@query("billing_clean")
def _billing_clean(t: Tables) -> DataFrame:
    return feat.billing_clean(t["billing"])


@query("billing_agg")
def _billing_agg(t: Tables) -> DataFrame:
    return feat.billing_agg(t["billing"], feat.UsageStats(t["usage_daily"]))


@query("support_clean")
def _support_clean(t: Tables) -> DataFrame:
    return feat.support_clean(t["support"], t["customers"])


@query("support_agg")
def _support_agg(t: Tables) -> DataFrame:
    return feat.support_agg(t["support"], t["customers"])


@query("recency")
def _recency(t: Tables) -> DataFrame:
    u = t["usage_daily"]
    return feat.recency(t["customers"], u, feat.UsageStats(u))


@query("churn_label")
def _churn_label(t: Tables) -> DataFrame:
    u = t["usage_daily"]
    return feat.recency(t["customers"], u, feat.UsageStats(u)).select("customer_id", "recency_days", "churn_label")


@query("churn_features")
def _churn_features(t: Tables) -> DataFrame:
    return feat.churn_features(t)


# ------------------------------------------------------------ explore ------

from churnscope.operators import explore as ex  # noqa: E402


def _features(t: Tables) -> DataFrame:
    """The feature table, materialised once for operators that read it repeatedly."""
    return materialize(feat.churn_features(t))


@query("labelled_customers")
def _labelled_customers(t: Tables) -> DataFrame:
    return feat.churn_features(t).where(F.col("churn_label").isin(0, 1))


@query("lifecycle_stage")
def _lifecycle_stage(t: Tables) -> DataFrame:
    return ex.with_stage(feat.churn_features(t)).select("customer_id", "recency_days", "lifecycle_stage")


@query("churn_status")
def _churn_status(t: Tables) -> DataFrame:
    return ex.labelled(feat.churn_features(t)).select("customer_id", "churn_label", "churn_status")


# these read the feature table once (or twice, where the exchange is reused): nothing is written for them
_ONE_SCAN = {"lifecycle_distribution", "lifecycle_by_plan", "lifecycle_by_plan_pivot", "retention_funnel",
             "churn_rate_overall", "at_risk_by_plan"}

for _name, _fn in {
    "lifecycle_distribution": ex.lifecycle_distribution,
    "lifecycle_by_plan": ex.lifecycle_by_plan,
    "lifecycle_by_plan_pivot": ex.lifecycle_by_plan_pivot,
    "retention_funnel": ex.retention_funnel,
    "churn_rate_overall": ex.churn_rate_overall,
    "churn_extremes": ex.churn_extremes,
    "at_risk_by_plan": ex.at_risk_by_plan,
    "key_medians": ex.key_medians,
    "medians_by_status": ex.medians_by_status,
    "numeric_describe": ex.numeric_describe,
    "recency_kde": ex.recency_kde,
    "usage_trend_histogram": ex.usage_trend_histogram,
    "usage_trend_density": ex.usage_trend_density,
    "usage_minutes_density": ex.usage_minutes_density,
    "key_insights": ex.key_insights,
}.items():
    query(_name)((lambda fn, once: lambda t: fn(feat.churn_features(t) if once else _features(t)))(_fn, _name in _ONE_SCAN))


@query("churn_by_plan")
def _churn_by_plan(t: Tables) -> DataFrame:
    return ex.churn_by(feat.churn_features(t), "plan")


@query("churn_by_region")
def _churn_by_region(t: Tables) -> DataFrame:
    return ex.churn_by(feat.churn_features(t), "region")


@query("recency_box")
def _recency_box(t: Tables) -> DataFrame:
    return ex.box_summary(_features(t), "recency_days")


@query("tickets_box")
def _tickets_box(t: Tables) -> DataFrame:
    return ex.box_summary(_features(t), "total_tickets")


# --------------------------------------------------------------- prep ------

import datetime as _dt  # noqa: E402

from churnscope import config as C  # noqa: E402
from churnscope.functions.columns import round6  # noqa: E402
from churnscope.operators import cohort as co  # noqa: E402
from churnscope.operators import prep  # noqa: E402
from churnscope.operators import scenario as sc  # noqa: E402
from churnscope.operators import scoring  # noqa: E402


@query("risk_flags")
def _risk_flags(t: Tables) -> DataFrame:
    return feat.risk_flags(feat.churn_features(t)).select(
        "customer_id", "usage_decline_flag", "high_support_flag", "payment_issue_flag")


@query("model_base")
def _model_base(t: Tables) -> DataFrame:
    return prep.model_base(feat.churn_features(t))


@query("winsor_bounds")
def _winsor_bounds(t: Tables) -> DataFrame:
    return prep.winsor_bounds(prep.model_base(_features(t)))


@query("winsorized")
def _winsorized(t: Tables) -> DataFrame:
    return prep.winsorized(prep.model_base(_features(t)))


def _split(t: Tables) -> DataFrame:
    base = materialize(prep.winsorized(prep.model_base(_features(t))))
    return materialize(prep.stratified_split(base))


@query("stratified_split")
def _stratified_split(t: Tables) -> DataFrame:
    return _split(t).select("customer_id", "churn_label", "split")


def _imputed(t: Tables) -> DataFrame:
    split = _split(t)
    cols = C.NUMERIC_FEATURES
    med = prep.fit_medians(split.where(F.col("split") == "train"), cols)
    return prep.impute(split, med, cols).select("customer_id", "split", *cols)


@query("imputed_features")
def _imputed_features(t: Tables) -> DataFrame:
    imp = _imputed(t)
    return imp.select("customer_id", "split", *[round6(c).alias(c) for c in C.NUMERIC_FEATURES])


@query("scaled_features")
def _scaled_features(t: Tables) -> DataFrame:
    imp = _imputed(t)
    cols = C.NUMERIC_FEATURES
    scaler = prep.fit_scaler(imp.where(F.col("split") == "train"), cols)
    out = prep.scale(imp, scaler, cols)
    return out.select("customer_id", "split", *[round6(c).alias(c) for c in cols])


@query("onehot_features")
def _onehot_features(t: Tables) -> DataFrame:
    split = _split(t)
    train = split.where(F.col("split") == "train")
    out, names = prep.onehot(split, {c: prep.category_levels(train, c) for c in C.CATEGORICAL_FEATURES})
    return out.select("customer_id", "plan", "region", *names)


@query("class_weights")
def _class_weights(t: Tables) -> DataFrame:
    return prep.class_weights(_split(t).where(F.col("split") == "train"))


# ------------------------------------------------------------ scoring ------

def _scored(t: Tables) -> DataFrame:
    return materialize(scoring.scored_customers(_features(t)))


def _test_scored(t: Tables) -> DataFrame:
    return materialize(prep.stratified_split(_scored(t))).where(F.col("split") == "test")


@query("risk_scores_scorecard")
def _risk_scores_scorecard(t: Tables) -> DataFrame:
    return _scored(t).select("customer_id", "plan", "churn_label", "churn_risk_score")


@query("roc_auc")
def _roc_auc(t: Tables) -> DataFrame:
    return scoring.roc_auc(_test_scored(t))


@query("precision_at_k")
def _precision_at_k(t: Tables) -> DataFrame:
    return scoring.precision_at_top(_test_scored(t))


# ------------------------------------------------------------- cohort ------

DEFAULT_SPEC = co.CohortSpec()
SIGNUP_SPEC = co.CohortSpec(signup_range=(_dt.date(1995, 3, 1), _dt.date(1995, 8, 31)))
ACTIVE_SPEC = co.CohortSpec(active_range=(_dt.date(2001, 6, 1), _dt.date(2001, 10, 15)))
SEGMENT_SPEC = co.CohortSpec(plans=("Pro", "Enterprise"), regions=("EUROPE", "ASIA"))
THRESHOLD = 0.5
DEFAULT_LEVERS = sc.Levers(discount_pct=C.DEFAULT_DISCOUNT_PCT, priority_support=True,
                           feature_unlock=True)


def _cohort(t: Tables) -> DataFrame:
    return materialize(co.target_cohort(_scored(t), DEFAULT_SPEC))


_COHORT_COLS = ["customer_id", "plan", "region", "churn_risk_score"]


@query("overview_metrics")
def _overview(t: Tables) -> DataFrame:
    return co.overview_metrics(_scored(t))


@query("risk_tier_share")
def _risk_tier_share(t: Tables) -> DataFrame:
    return co.risk_tier_share(_scored(t))


@query("risk_histogram")
def _risk_histogram(t: Tables) -> DataFrame:
    s = _scored(t)
    h = ex.histogram(s, "churn_risk_score", 50, value_range=(0.0, 1.0))
    mean = s.agg(round6(F.avg("churn_risk_score")).alias("mean_risk"))
    return h.crossJoin(mean)


@query("top_risk_10")
def _top_risk_10(t: Tables) -> DataFrame:
    return co.top_risk(_scored(t), 10)


@query("plan_domain")
def _plan_domain(t: Tables) -> DataFrame:
    return co.domain(_scored(t), "plan")


@query("region_domain")
def _region_domain(t: Tables) -> DataFrame:
    return co.domain(_scored(t), "region")


@query("cohort_filter")
def _cohort_filter(t: Tables) -> DataFrame:
    spec = co.CohortSpec(signup_range=SIGNUP_SPEC.signup_range,
                         active_range=ACTIVE_SPEC.active_range, plans=("Pro", "Basic"))
    return co.cohort_filter(_scored(t), spec).select(*_COHORT_COLS)


@query("cohort_signup_range")
def _cohort_signup(t: Tables) -> DataFrame:
    return co.cohort_filter(_scored(t), SIGNUP_SPEC).select(*_COHORT_COLS)


@query("cohort_active_range")
def _cohort_active(t: Tables) -> DataFrame:
    return co.cohort_filter(_scored(t), ACTIVE_SPEC).select(*_COHORT_COLS)


@query("cohort_plan_region")
def _cohort_segment(t: Tables) -> DataFrame:
    return co.cohort_filter(_scored(t), SEGMENT_SPEC).select(*_COHORT_COLS)


@query("cohort_threshold")
def _cohort_threshold(t: Tables) -> DataFrame:
    return _scored(t).where(F.col("churn_risk_score") >= THRESHOLD).select(*_COHORT_COLS)


@query("risk_domain")
def _risk_domain(t: Tables) -> DataFrame:
    return co.risk_domain(_scored(t))


@query("target_limits")
def _target_limits(t: Tables) -> DataFrame:
    return co.target_limits(_scored(t), DEFAULT_SPEC).select(
        "customers", round6("threshold").alias("threshold"), "eligible", "max_target_pct_limit",
        "max_target_pct", "max_target_count")


@query("target_cohort")
def _target_cohort(t: Tables) -> DataFrame:
    return _cohort(t).select(*_COHORT_COLS, "usage_trend_30d", "total_tickets",
                             "total_payment_issues")


@query("targeting_summary")
def _targeting_summary(t: Tables) -> DataFrame:
    return co.targeting_summary(_scored(t), DEFAULT_SPEC)


@query("cohort_drivers")
def _cohort_drivers(t: Tables) -> DataFrame:
    return co.cohort_drivers(_cohort(t))


@query("cohort_trend_split")
def _cohort_trend_split(t: Tables) -> DataFrame:
    return co.cohort_trend_split(_cohort(t))


@query("plan_contribution")
def _plan_contribution(t: Tables) -> DataFrame:
    return co.plan_contribution(_cohort(t))


@query("risk_by_plan")
def _risk_by_plan(t: Tables) -> DataFrame:
    return co.risk_by(_cohort(t), "plan")


@query("risk_by_region")
def _risk_by_region(t: Tables) -> DataFrame:
    return co.risk_by(_cohort(t), "region")


@query("cohort_feature_delta")
def _cohort_feature_delta(t: Tables) -> DataFrame:
    s = _scored(t)
    return co.cohort_feature_delta(co.target_cohort(s, DEFAULT_SPEC), s)


@query("cohort_risk_lift")
def _cohort_risk_lift(t: Tables) -> DataFrame:
    s = _scored(t)
    return co.cohort_risk_lift(co.target_cohort(s, DEFAULT_SPEC), s)


@query("cohort_trend_histogram")
def _cohort_trend_histogram(t: Tables) -> DataFrame:
    return ex.histogram(_cohort(t), "usage_trend_30d", 30)


@query("risk_value_points")
def _risk_value_points(t: Tables) -> DataFrame:
    return co.risk_value_points(_cohort(t))


# ----------------------------------------------------------- scenario ------

@query("plan_revenue")
def _plan_revenue(t: Tables) -> DataFrame:
    return sc.plan_revenue_frame(_scored(t))


@query("lever_uplift")
def _lever_uplift(t: Tables) -> DataFrame:
    return sc.lever_uplift(_cohort(t), DEFAULT_LEVERS)


@query("business_summary")
def _business_summary(t: Tables) -> DataFrame:
    return sc.business_summary(_cohort(t), DEFAULT_LEVERS)


@query("cost_breakdown")
def _cost_breakdown(t: Tables) -> DataFrame:
    return sc.cost_breakdown(_cohort(t), DEFAULT_LEVERS)


@query("scenario_grid")
def _scenario_grid(t: Tables) -> DataFrame:
    return sc.scenario_grid(_cohort(t))


@query("best_scenario")
def _best_scenario(t: Tables) -> DataFrame:
    return sc.best_scenario(_cohort(t))


# -------------------------------------------------------------- spine ------

from churnscope.operators import spine  # noqa: E402


def _stats(t: Tables) -> feat.UsageStats:
    return feat.UsageStats(t["usage_daily"])


@query("calendar_spine")
def _calendar_spine(t: Tables) -> DataFrame:
    return spine.calendar_spine(t["customers"], t["usage_daily"], _stats(t))


@query("monthly_activity")
def _monthly_activity(t: Tables) -> DataFrame:
    return spine.monthly_activity(spine.daily_spine(t["customers"], t["usage_daily"], _stats(t)))


@query("expected_activity")
def _expected_activity(t: Tables) -> DataFrame:
    return spine.expected_activity(t["customers"], t["usage_daily"], _stats(t))


@query("tenure_months")
def _tenure_months(t: Tables) -> DataFrame:
    return spine.tenure(t["customers"], _stats(t))


@query("expected_tickets")
def _expected_tickets(t: Tables) -> DataFrame:
    return spine.expected_tickets(t["customers"], _stats(t))


@query("schedule_expand")
def _schedule_expand(t: Tables) -> DataFrame:
    return spine.schedule_expand(t["customers"], _stats(t))


@query("weighted_bucket")
def _weighted_bucket(t: Tables) -> DataFrame:
    return spine.weighted_bucket(spine.schedule_expand(t["customers"], _stats(t)))


@query("hash_sample")
def _hash_sample(t: Tables) -> DataFrame:
    return spine.hash_sample(t["usage_daily"]).select("customer_id", "date", "sessions",
                                                      "usage_minutes")


@query("bill_sequence")
def _bill_sequence(t: Tables) -> DataFrame:
    return spine.bill_sequence(t["billing"])


# ---------------------------------------------------- layers / profile -----

from churnscope.plans import layers as pl  # noqa: E402
from churnscope.plans.registry import raw_query  # noqa: E402
from churnscope.session import shared_path  # noqa: E402
from churnscope.sources.staging import staged_from_root  # noqa: E402


@query("staging_row_counts")
def _staging_row_counts(t: Tables) -> DataFrame:
    return pl.staging_row_counts(t)


@query("analytics_row_count")
def _analytics_row_count(t: Tables) -> DataFrame:
    return feat.churn_features(t).agg(F.count(F.lit(1)).alias("row_count"))


@query("feature_table_shape")
def _feature_table_shape(t: Tables) -> DataFrame:
    f = feat.churn_features(t)
    return f.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(f.columns)).alias("columns"))


@raw_query("export_churn_features")
def _export_churn_features(spark, sf_dir: str) -> DataFrame:
    """Write the feature table to the shared folder and read it back."""
    path = shared_path(spark, "export", "churn_features")
    pl.write_layer(feat.churn_features(staged_from_root(spark, sf_dir)), path)
    return pl.read_layer(spark, path)


def _rebuilt(spark, sf_dir: str) -> pl.Layers:
    """All layers, built under the shared folder."""
    root = shared_path(spark, "layers")
    pl.run_pipeline(spark, sf_dir, root)
    return pl.Layers(spark, root)


@raw_query("layer_profile")
def _layer_profile(spark, sf_dir: str) -> DataFrame:
    """Row counts of the rebuilt staging and analytics layers, from their file footers."""
    found = _rebuilt(spark, sf_dir).info()
    return pl.footer_counts(spark, {name: x.path for name, x in found.items() if name.split(".")[0] in ("staging", "analytics")})


@raw_query("layer_usage_range")
def _layer_usage_range(spark, sf_dir: str) -> DataFrame:
    """First and last usage date of the rebuilt staging layer, from its file footers."""
    return pl.footer_range(spark, _rebuilt(spark, sf_dir).info()["staging.usage_daily"].path, "date")


@raw_query("layer_churn_features")
def _layer_churn_features(spark, sf_dir: str) -> DataFrame:
    """The feature table from the bucketed roll-ups of a rebuild, without a shuffle."""
    layers = _rebuilt(spark, sf_dir)
    stats = feat.UsageStats.resolved(layers.read("staging.usage_daily"))
    return feat.churn_features_from_days({name: layers.read(f"days.{name}") for name in pl.DAYS}, stats)


@raw_query("recent_trends")
def _recent_trends(spark, sf_dir: str) -> DataFrame:
    """The usage trend of every customer, from the last months of the roll-up by month."""
    layers = _rebuilt(spark, sf_dir)
    stats = feat.UsageStats.resolved(layers.read("staging.usage_daily"))
    return feat.recent_trends(layers.read("staging.customers"), layers.read("months.usage"), stats)


# --------------------------------------------------------------- models ----

from churnscope.operators import forest, permute  # noqa: E402
from churnscope.operators import models as ml  # noqa: E402


def _trained(spark, sf_dir: str, *kinds: str) -> list[ml.Trained]:
    """Models of these kinds, trained on the data of the call."""
    f = materialize(feat.churn_features(staged_from_root(spark, sf_dir)))
    shared = ml.prepare_for_models(f)
    train = {"lr": lambda: ml.train_logistic(f, shared), "rf": lambda: ml.train_forest(f, prepared=shared)}
    return [train[kind]() for kind in kinds]


@raw_query("lr_scores")
def _lr_scores(spark, sf_dir: str) -> DataFrame:
    return ml.scores(_trained(spark, sf_dir, "lr")[0])


@raw_query("rf_scores")
def _rf_scores(spark, sf_dir: str) -> DataFrame:
    return ml.scores(_trained(spark, sf_dir, "rf")[0])


@raw_query("risk_scores")
def _risk_scores(spark, sf_dir: str) -> DataFrame:
    """Forest churn risk for every labelled customer (the app's scoring)."""
    return _forest_scored(spark, sf_dir).select("customer_id", "plan", "region", "churn_label", "churn_risk_score")


def _forest_scored(spark, sf_dir: str) -> DataFrame:
    t = _trained(spark, sf_dir, "rf")[0]
    return materialize(ml.Scorer(t.model, t.prep).score(feat.churn_features(staged_from_root(spark, sf_dir))))


@raw_query("forest_target_cohort")
def _forest_target_cohort(spark, sf_dir: str) -> DataFrame:
    """The default target cohort on the trained forest's scores."""
    return co.target_cohort(_forest_scored(spark, sf_dir), DEFAULT_SPEC).select(*_COHORT_COLS)


@raw_query("forest_business_summary")
def _forest_business_summary(spark, sf_dir: str) -> DataFrame:
    """The what-if of the default levers on that cohort."""
    return sc.business_summary(co.target_cohort(_forest_scored(spark, sf_dir), DEFAULT_SPEC), DEFAULT_LEVERS)


@raw_query("model_comparison")
def _model_comparison(spark, sf_dir: str) -> DataFrame:
    lr, rf = _trained(spark, sf_dir, "lr", "rf")
    return ml.evaluation(lr, "logistic_regression").unionByName(ml.evaluation(rf, "random_forest"))


@raw_query("lr_top_drivers")
def _lr_top_drivers(spark, sf_dir: str) -> DataFrame:
    return ml.lr_drivers(_trained(spark, sf_dir, "lr")[0])


@raw_query("rf_importance")
def _rf_importance(spark, sf_dir: str) -> DataFrame:
    return ml.forest_importance(_trained(spark, sf_dir, "rf")[0])


@raw_query("linear_attribution")
def _linear_attribution(spark, sf_dir: str) -> DataFrame:
    return ml.linear_attribution(_trained(spark, sf_dir, "lr")[0])


@raw_query("forest_attribution")
def _forest_attribution(spark, sf_dir: str) -> DataFrame:
    """Mean absolute Shapley value of each feature of the forest over the first 1000 test rows."""
    return forest.forest_attribution(_trained(spark, sf_dir, "rf")[0])


@query("scorecard_permutation")
def _scorecard_permutation(t: Tables) -> DataFrame:
    """The permutation importance of the scorecard's columns over all labelled customers."""
    columns = ["plan", *(c for c, _ in C.SCORECARD_COEFFICIENTS)]
    return permute.importance(_scored(t), "customer_id", columns, scoring.score)


@query("scorecard_attribution")
def _scorecard_attribution(t: Tables) -> DataFrame:
    """Exact linear attribution of the scorecard: mean |w * (x - mean)| of each feature."""
    return scoring.scorecard_attribution(_scored(t))


@query("scorecard_comparison")
def _scorecard_comparison(t: Tables) -> DataFrame:
    """The model comparison table for the scorecard on the test and on the training rows."""
    split = materialize(prep.stratified_split(_scored(t)))
    return scoring.comparison({name: split.where(F.col("split") == name) for name in ("test", "train")})


@query("cohort_insights")
def _cohort_insights(t: Tables) -> DataFrame:
    s = _scored(t)
    return co.cohort_insights(materialize(co.target_cohort(s, DEFAULT_SPEC)), s)


@raw_query("permutation_importance")
def _permutation_importance(spark, sf_dir: str) -> DataFrame:
    return ml.permutation_importance(_trained(spark, sf_dir, "lr")[0])


@query("churn_lift_by_flag")
def _churn_lift_by_flag(t: Tables) -> DataFrame:
    return ex.churn_lift_by_flag(prep.model_base(_features(t)))
