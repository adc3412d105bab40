"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line stripped of ASCII white space with A-Z lower-cased, held as a
128-bit hash.  A store keeps runs of (key, number of documents), each sorted by key and
written as Parquet.  A new batch of documents is merge-joined with the runs: keys that the
runs already know as frequent are anti-joined away, the rest becomes a new run on level 0.
When a level holds ``fanout`` runs they are compacted into one run of the next level, which
adds their counts.  Keys whose counts over all runs reach the threshold are frequent, and
their lines are dropped from every document.

A null or empty text is one empty line, which is never dropped.  Rows that share a doc_id
count as one document; rows without an id count as one document together.  Repeated rows
give repeated results.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm.common import arrow_stage, cut, record_batch, scratch, table, texts_of

#: Documents that must share a line, batches of a table, runs of a level.
MIN_DOCS, BATCHES, FANOUT = 10, 4, 2
_STRIP = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes | None:
    """The hash of a line's key; None if the key is empty."""
    key = line.strip(_STRIP).lower()  # bytes: ASCII letters only
    return hashlib.blake2b(key, digest_size=16).digest() if key else None


def row_key() -> Column:
    """A hash of a row's doc_id and text, which only copies share."""
    return F.xxhash64("doc_id", "text")


def line_keys(docs: DataFrame) -> DataFrame:
    """doc_id, row (``row_key``), key: each distinct key of a row once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners = [], []
            for k, text in enumerate(texts_of(batch)):
                own = {line_key(line) for line in text.encode().split(b"\n")} - {None}
                keys += own
                owners += [k] * len(own)
            at = pa.array(owners, pa.int64())
            yield record_batch(doc_id=batch.column("doc_id").take(at), row=batch.column("row").take(at), key=pa.array(keys, pa.binary()))

    return arrow_stage(docs.select("doc_id", row_key().alias("row"), "text"), run, "doc_id long, row long, key binary")


class LineRuns:
    """Levelled runs of (key, docs) in a shared folder.

    A run is a table bucketed and sorted by key, so runs of one store meet in merge joins
    without a shuffle.  The store ends with ``close()``, which forgets the tables' names.
    """

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.folder, self.min_docs, self.fanout = spark, folder, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.names: list[str] = []

    def _write(self, counts: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (counts.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
         .option("path", f"{self.folder}/level{level}-{name}").saveAsTable(name))
        self.names.append(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _merged(self, names: list[str]) -> DataFrame | None:
        """key, docs summed over runs, by merge joins."""
        out = None
        for name in names:
            run = self.spark.table(name)
            if out is None:
                out = run
                continue
            both = out.join(run.select(F.col("key"), F.col("docs").alias("more")), "key", "full_outer")
            out = both.select("key", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"))
        return out

    def counts(self) -> DataFrame | None:
        """key, docs over all runs; None if there is no run."""
        return self._merged([name for level in self.levels for name in level])

    def frequent(self) -> DataFrame | None:
        """The keys found in at least ``min_docs`` documents; None if there is no run."""
        counts = self.counts()
        return None if counts is None else counts.where(F.col("docs") >= self.min_docs).select("key")

    def add(self, batch: DataFrame) -> None:
        """Add a batch of (doc_id, key); all rows of a document must be in one batch.

        Keys that are frequent already are anti-joined away; their counts need not grow.
        """
        own = batch.select("key", "doc_id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
        known = self.frequent()
        self._write(own if known is None else own.join(known, "key", "left_anti"), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._write(self._merged(runs), level + 1)
            level += 1

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_frequent_lines(docs: DataFrame, keep: list[str], min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``keep`` columns of each row, n_lines, n_dropped and kept: the text without frequent lines.

    The keys of all lines are extracted once and written by batch of documents; the batches
    then go through the runs one after the other.  ``docs`` has doc_id and text.  A row meets
    the frequent keys among its own text's, by its row_key, so an array is bounded by one
    text's lines however many rows share a doc_id or have none; rows whose hashes collide meet
    both texts' keys, which are frequent all the same.  The arrays are written first, so that
    the planner can split a join with very many copies of a row, and met in a merge join at
    every size.  The runs may be large, so no side is broadcast but by the planner's own size
    check.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "line-runs")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    line_keys(docs).withColumn("batch", batch).write.partitionBy("batch").parquet(f"{folder}/keys")
    keys = spark.read.schema("doc_id long, row long, key binary, batch int").parquet(f"{folder}/keys")
    runs = LineRuns(spark, folder, min_docs)
    for k in range(batches):
        runs.add(keys.where(F.col("batch") == k).select("doc_id", "key"))
    frequent = scratch(spark, "frequent-lines")
    runs.frequent().write.parquet(frequent)
    runs.close()
    found = keys.select("row", "key").join(spark.read.parquet(frequent), "key", "left_semi")
    found = cut(found.groupBy(F.col("row").alias("of")).agg(F.collect_set("key").alias("frequent")), "frequent-of-rows")
    columns = [F.col(c).alias(f"kept_{k}") for k, c in enumerate(keep)]
    joined = docs.select(*columns, row_key().alias("own"), "text").join(found.hint("merge"), F.col("own") == F.col("of"), "left")
    carried = [f.name for f in docs.select(*columns).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, kept = [], [], []
            for text, gone in zip(texts_of(batch), batch.column("frequent").to_pylist()):
                own = text.encode().split(b"\n")
                left = own
                if gone:
                    gone = set(gone)
                    left = [line for line in own if line_key(line) not in gone]
                lines.append(len(own))
                dropped.append(len(own) - len(left))
                kept.append(text if left is own else b"\n".join(left).decode())
            yield record_batch(**{c: batch.column(c) for c in carried}, n_lines=pa.array(lines, pa.int64()),
                               n_dropped=pa.array(dropped, pa.int64()), kept=pa.array(kept, pa.string()))

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    out = arrow_stage(joined.select(*carried, "text", "frequent"), run, f"{types}, n_lines long, n_dropped long, kept string")
    return out.select(*(F.col(f"kept_{k}").alias(c) for k, c in enumerate(keep)), "n_lines", "n_dropped", "kept")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that at least ten documents share."""
    out = drop_frequent_lines(table(spark, sf_dir, "documents", "doc_id", "text"), ["doc_id"])
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: White space is stripped and A-Z lower-cased by the same rule; a document is its doc_id.
OP9_SQL = """
WITH lines AS (
  SELECT row, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
  FROM (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -1)) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY row
"""
