"""Property test: percentiles equal numpy's on random data with ties and NULLs."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from churnscope.functions.quantiles import exact_percentiles

values = st.one_of(st.none(), st.integers(-5, 5).map(float),
                   st.floats(-1e3, 1e3, allow_nan=False, allow_infinity=False))


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), values), min_size=1, max_size=300),
       probs=st.lists(st.sampled_from([0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]),
                      min_size=1, max_size=3, unique=True))
def test_percentiles_match_numpy(spark, rows, probs):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.p): r.value for r in
           exact_percentiles(df, "v", probs, by=["g"]).collect()}
    for g in {r[0] for r in rows}:
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        for p in probs:
            if len(vals) == 0:
                assert got[(g, p)] is None
            else:
                assert got[(g, p)] == pytest.approx(np.percentile(vals, p * 100), rel=1e-9,
                                                    abs=1e-9)
