"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Every callable reads the test tables under ``sf_dir`` (conformed and
staged lazily) and returns an unexecuted DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnscope.sources.staging import staged_from_root

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(key: str):
    def deco(fn: Callable[[dict[str, DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(staged_from_root(spark, sf_dir))
        run.__name__ = key
        run.__doc__ = fn.__doc__
        _REGISTRY[key] = run
        return fn
    return deco


def raw_query(key: str):
    """Register a callable that needs the session itself (writes, ML)."""
    def deco(fn: QueryFn):
        _REGISTRY[key] = fn
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    # Import for the registration side effect.
    from churnscope.plans import catalog  # noqa: F401
    return dict(_REGISTRY)
