"""Staging: conform a raw table to its declared schema (every column cast).

Casts are ANSI (Spark 4 default): text that does not parse raises instead
of silently becoming NULL.  A missing column fails at analysis time, before
any job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnscope.config import STAGING_SCHEMAS
from churnscope.session import materialize
from churnscope.sources.conform import conformed_tables, customer_lines


class SchemaDriftError(ValueError):
    pass


def stage_table(raw: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise SchemaDriftError(f"missing columns {missing}; have {raw.columns}")
    return raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage_table(raw[name], schema) for name, schema in STAGING_SCHEMAS.items()}


def staged_from_root(spark: SparkSession, root: str, all_at_once: bool = False) -> dict[str, DataFrame]:
    """Conform the test tables found under ``root`` and stage them.

    ``all_at_once``: the caller computes all of them, so what several share is written out first.
    """
    return stage_all(conformed_tables(spark, root, materialize(customer_lines(spark, root)) if all_at_once else None))
