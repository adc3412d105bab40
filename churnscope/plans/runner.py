"""Submit independent Spark jobs concurrently from driver threads.

A SparkContext accepts jobs from several threads; independent outputs (the
staging tables, the layer writes, the report tables) then share the cluster
instead of queueing one after another while cores sit idle.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame

T = TypeVar("T")


def run_all(tasks: dict[str, Callable[[], T]], max_workers: int = 4) -> dict[str, T]:
    """Run the callables concurrently; re-raise the first failure."""
    if len(tasks) <= 1 or max_workers <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def force_all(frames: dict[str, DataFrame], max_workers: int = 4) -> None:
    """Fully compute each frame with the no-op sink, concurrently."""
    run_all({name: (lambda df=df: df.write.format("noop").mode("overwrite").save())
             for name, df in frames.items()}, max_workers)
