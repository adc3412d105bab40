"""Partition invariance: same results at 1, 4 and 37 shuffle partitions."""

import pytest

from conftest import SF_SMALL

KEYS = ["churn_features", "dq_summary", "key_medians", "stratified_split", "target_cohort",
        "roc_auc", "scenario_grid", "bill_sequence"]


def _normalise(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("key", KEYS)
def test_same_result_for_any_partitioning(spark, key):
    import __spark_entry__ as entry
    q = entry.queries()[key]
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (1, 4, 37):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(_normalise(q(spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old_aqe)
    assert results[0] == results[1] == results[2]
