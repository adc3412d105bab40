"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings for local runs (tests, bench).  On a cluster these come from the
# submit command; nothing here assumes a particular deployment.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet test timestamps carry no zone; keep them zone-less.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str | None = "8g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("churnscope")
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for lineage cuts, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


class MissingSharedFolderError(RuntimeError):
    pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the configured checkpoint folder; a local session without one gets a temporary folder.

    On a cluster the folder must be one that all executors share, so it has to be configured.
    """
    current = checkpoint_dir(spark)
    if current:
        # Make sure RDD checkpointing uses the same folder.
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise MissingSharedFolderError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="churnscope-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder (never a machine-local tmp)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex)
    return "/".join([base, "churnscope", spark.sparkContext.applicationId, *tail])


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote under the shared folder; frames read from it end with this."""
    jvm, base = spark.sparkContext._jvm, ensure_checkpoint_dir(spark).rstrip("/")
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/churnscope/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def default_sf_dir(sf: str = "0.001") -> str:
    return os.environ.get("CHURNSCOPE_SF_DIR", f"/root/testdata/sf{sf}")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder, read it back.

    Used before operators that scan an expensive input several times (the
    exact quantile and cutoff plans), so the input is computed once and a
    lost executor recomputes from the written files, not from the raw
    tables.  Unlike ``checkpoint()``, the re-read frame carries size
    statistics of the real files, which the size-gated operators rely on
    (a checkpoint keeps the pre-cut estimate, inflated by any join).
    """
    spark = df.sparkSession
    path = shared_path(spark, "materialized")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
