"""Readers for the raw Parquet tables.

A table is addressed as ``<root>/<name>.parquet``; that path may be a single
file or a directory of part files, so the same code reads a 1 KB fixture
and a multi-terabyte dataset.  Column pruning and predicate pushdown are
left to Catalyst: callers select what they need and the scan reads only
those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, name))
