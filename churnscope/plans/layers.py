"""The end-to-end batch pipeline: staging -> quality, roll-ups -> features.

A rebuild writes every layer into a new version folder, ``<root>/versions/<version>/...``.
Only when all of them are written, one manifest file is renamed into place, which names the
folder of each layer; ``Layers`` resolves through it.  A rebuild that fails midway leaves the
manifest and the old layers as they were.  The version before the published one stays, for
readers that opened it; older published ones are deleted.

The roll-ups hold one row for each customer and day (a hot customer has as many rows as
days), bucketed and sorted by customer_id, so the feature table needs no shuffle on it; usage
is also kept by month, so the last 60 days can be read by themselves.  Downstream layers read
the written upstream layer, which cuts lineage: a lost executor recomputes from there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope import config as C
from churnscope.config import STAGING_SCHEMAS
from churnscope.operators.features import (
    UsageStats, billing_customer_day, churn_features_from_days, support_customer_day, usage_clean, usage_customer_day)
from churnscope.operators.quality import dq_summary
from churnscope.plans.runner import run_all
from churnscope.sources.staging import staged_from_root

# Staged tables are written range-partitioned and sorted by these keys: each
# file covers its own range, so filters on the key prune files and row groups.
SORT_KEYS = {
    "customers": ["customer_id"],
    "usage_daily": ["customer_id", "date"],
    "billing": ["customer_id", "bill_date"],
    "support": ["customer_id", "ticket_date"],
}


# the table of each check in the quality layer
CHECK_TABLES = {
    "dq_negative_minutes": C.DQ_NEGATIVE_MINUTES, "dq_extreme_minutes": C.DQ_EXTREME_MINUTES,
    "dq_session_mismatch": C.DQ_SESSION_MISMATCH, "dq_zero_paid": C.DQ_ZERO_PAID,
    "dq_billing_duplicates": C.DQ_BILLING_DUPLICATES, "dq_pre_signup_tickets": C.DQ_PRE_SIGNUP_TICKETS,
}


class MissingLayerError(FileNotFoundError):
    pass


@dataclass
class PipelineResult:
    out_root: str
    version: str = ""
    paths: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)


def layer_path(out_root: str, layer: str, name: str) -> str:
    return f"{out_root.rstrip('/')}/{layer}/{name}"


# ------------------------------------------------------------- manifest ----

@dataclass
class LayerInfo:
    """Where a layer lies; of a bucketed one also its schema (as JSON), buckets and order."""

    path: str
    schema: str = ""
    buckets: int = 0
    keys: list[str] = field(default_factory=list)


class Files:
    """Small files and folders of whatever file system a path names."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        hadoop = self.jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.conf)

    def read(self, path: str) -> str | None:
        hadoop, fs = self._at(path)
        if not fs.exists(hadoop):
            return None
        stream = fs.open(hadoop)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Write ``text`` beside ``path`` and rename it over ``path``: readers see the old file or the new one."""
        beside, fs = self._at(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        kind = self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = self.jvm.java.lang.reflect.Array.newInstance(kind, 1)
        options[0] = self.jvm.java.lang.Enum.valueOf(kind, "OVERWRITE")
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), self.conf)
        context.rename(beside, self._at(path)[0], options)

    def delete(self, path: str) -> None:
        hadoop, fs = self._at(path)
        fs.delete(hadoop, True)


class Layers:
    """The published layers under a root, by name (``staging.usage_daily``, ``analytics.churn_features``, ...)."""

    def __init__(self, spark: SparkSession, out_root: str):
        self.spark, self.root, self.files = spark, out_root.rstrip("/"), Files(spark)

    @property
    def _manifest(self) -> str:
        return f"{self.root}/manifest.json"

    def _published(self) -> dict:
        text = self.files.read(self._manifest)
        return json.loads(text) if text else {"versions": [], "layers": {}}

    def info(self) -> dict[str, LayerInfo]:
        return {name: LayerInfo(**x) for name, x in self._published()["layers"].items()}

    def folder(self, version: str) -> str:
        return f"{self.root}/versions/{version}"

    def publish(self, version: str, layers: dict[str, LayerInfo]) -> None:
        """Make ``layers`` the current ones of these names; the others stay as they are."""
        old = self._published()
        named = old["layers"] | {name: asdict(x) for name, x in layers.items()}
        used = {v for v in old["versions"] if any(x["path"].startswith(self.folder(v) + "/") for x in named.values())}
        versions = [v for v in old["versions"] if v != version]
        kept = {version, *versions[-1:], *used}
        self.files.replace(self._manifest, json.dumps({"versions": [v for v in [*versions, version] if v in kept], "layers": named}))
        for v in versions:
            if v not in kept:
                self.files.delete(self.folder(v))

    def read(self, name: str) -> DataFrame:
        found = self.info().get(name)
        if found is None:
            raise MissingLayerError(f"layer {name} isn't published under {self.root}; run the pipeline first")
        return read_layer(self.spark, found.path) if not found.buckets else read_bucketed(self.spark, found)


# ------------------------------------------------------- reading, writing ---

def write_layer(df: DataFrame, path: str, sort_keys: list[str] | None = None) -> None:
    if sort_keys:
        df = df.repartitionByRange(*sort_keys).sortWithinPartitions(*sort_keys)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> LayerInfo:
    """Write ``df`` in buckets of keys[0], sorted by ``keys``; the table's name is forgotten again."""
    name = f"churnscope_{uuid.uuid4().hex}"
    (df.repartition(buckets, keys[0]).write.option("path", path).option("compression", "snappy")
     .bucketBy(buckets, keys[0]).sortBy(*keys).saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return LayerInfo(path, df.schema.json(), buckets, keys)


def read_bucketed(spark: SparkSession, info: LayerInfo) -> DataFrame:
    """The layer as a table of the session's catalog, so that its buckets are known to the planner."""
    from pyspark.sql.types import StructType

    name = f"churnscope_{uuid.uuid5(uuid.NAMESPACE_URL, info.path).hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(info.schema)))
    keys = ", ".join(info.keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({info.keys[0]}) SORTED BY ({keys}) "
              f"INTO {info.buckets} BUCKETS LOCATION '{info.path}'")
    return spark.table(name)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own settings whose Parquet reader answers count, min and max from the file footers."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, row_count) of written layers, ordered by name; no row group is read."""
    own, out = footer_session(spark), None
    for name in sorted(paths):
        one = own.read.parquet(paths[name]).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out.orderBy("table_name")


def footer_range(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row: least and greatest value of a column of a written layer, from the footers."""
    return footer_session(spark).read.parquet(path).agg(F.min(column).alias("least"), F.max(column).alias("greatest"))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise MissingLayerError(f"layer not found: {path}; run the pipeline first") from e
        raise


def staging_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every staged table, ordered by table name."""
    parts = [tables[name].agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name in sorted(tables)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


#: The roll-ups of a customer's days, and the customers, by name: sort keys after customer_id.
DAYS = {"customers": [], "usage": ["date"], "billing": ["bill_date"], "support": ["ticket_date"]}


def run_pipeline(spark: SparkSession, in_root: str, out_root: str,
                 max_workers: int = 4) -> PipelineResult:
    layers = Layers(spark, out_root)
    res = PipelineResult(out_root, uuid.uuid4().hex)
    folder = layers.folder(res.version)
    written: dict[str, LayerInfo] = {}

    def path(layer: str, name: str) -> str:
        res.paths[f"{layer}.{name}"] = layer_path(folder, layer, name)
        written[f"{layer}.{name}"] = LayerInfo(res.paths[f"{layer}.{name}"])
        return res.paths[f"{layer}.{name}"]

    # 1. staging layer: four independent writes, submitted together; what two of them share is written first
    staged = staged_from_root(spark, in_root, all_at_once=True)
    run_all({name: (lambda df=df, n=name, p=path("staging", name): write_layer(df, p, SORT_KEYS.get(n)))
             for name, df in staged.items()}, max_workers)
    tables = {name: read_layer(spark, res.paths[f"staging.{name}"]) for name in STAGING_SCHEMAS}
    # 2. the usage stats row (p99.9, observation date), computed once for the rest
    stats = UsageStats.resolved(tables["usage_daily"])
    # 3. quality layer (the summary and one table for each check) and roll-ups, from staging; features from the roll-ups
    dq_path = path("dq", "data_quality_summary")
    check_paths = {check: path("dq", name) for name, check in CHECK_TABLES.items()}
    feat_path, month_path = path("analytics", "churn_features"), path("months", "usage")
    days = {"customers": tables["customers"], "usage": usage_customer_day(usage_clean(tables["usage_daily"], stats)),
            "billing": billing_customer_day(tables["billing"]), "support": support_customer_day(tables["support"])}
    day_paths = {name: path("days", name) for name in days}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def quality() -> None:
        write_layer(dq_summary(tables, stats).coalesce(1), dq_path)
        summary = read_layer(spark, dq_path)  # six rows
        run_all({path: (lambda c=check, p=path: write_layer(summary.where(
            (F.col("check_name") == c[0]) & (F.col("table_name") == c[1])).coalesce(1), p))
            for check, path in check_paths.items()}, max_workers)

    def roll_up(name: str) -> None:
        written[f"days.{name}"] = write_bucketed(days[name], day_paths[name], ["customer_id", *DAYS[name]], buckets)

    def by_month() -> None:
        usage = read_bucketed(spark, written["days.usage"]).withColumn("month", F.date_format("date", "yyyyMM").cast("int"))
        usage.write.partitionBy("month").parquet(month_path)

    def features() -> None:
        read = {name: read_bucketed(spark, written[f"days.{name}"]) for name in days}
        write_layer(churn_features_from_days(read, stats), feat_path)

    tasks: dict[str, Callable[[], None]] = {"dq": quality}
    run_all(tasks | {f"days.{name}": (lambda n=name: roll_up(n)) for name in days}, max_workers)
    run_all({"features": features, "months": by_month}, max_workers)
    layers.publish(res.version, written)
    # 4. profile: counts per staged table and the feature table, from the footers
    for row in footer_counts(spark, {name: p for name, p in res.paths.items() if name.split(".")[0] in ("staging", "analytics")}).collect():
        res.counts[row.table_name] = row.row_count
    return res


def write_report(features: DataFrame, out_root: str, max_workers: int = 4) -> dict[str, str]:
    """Exploration layer: every report table as Parquet plus the insight lines as text.

    The tables are small aggregates; they are written concurrently, each as one file, and
    published together.  ``key_insights_text`` holds the findings, one per line.
    """
    from churnscope.operators.explore import report

    layers, version = Layers(features.sparkSession, out_root), uuid.uuid4().hex
    tables = report(features)
    paths = {name: layer_path(layers.folder(version), "report", name) for name in tables}
    text_path = layer_path(layers.folder(version), "report", "key_insights_text")
    tasks = {name: (lambda n=name, df=df: write_layer(df.coalesce(1), paths[n]))
             for name, df in tables.items()}
    tasks["key_insights_text"] = lambda: (
        tables["key_insights"].orderBy("insight_id").select("text").coalesce(1)
        .write.mode("overwrite").text(text_path))
    run_all(tasks, max_workers)
    paths["key_insights_text"] = text_path
    layers.publish(version, {f"report.{name}": LayerInfo(p) for name, p in paths.items() if p != text_path})
    return paths
