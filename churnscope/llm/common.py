"""Shared helpers of the text operators: reading tables, Arrow stages, word hashes.

Python stages run through ``mapInArrow``: Spark partitions and shuffles the rows, and a
task sees one Arrow batch at a time, so memory is bounded by a batch and by one text.
The functions of this subpackage travel to the executors by value, which spares a cluster
an installed copy of the repository.
"""

from __future__ import annotations

import ctypes
import re
import sys
import types
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import churnscope.llm as _package
from churnscope.session import shared_path

cloudpickle.register_pickle_by_value(_package)

#: A word of the shingle operators: a run of letters, digits or underscores, lower-cased.
WORD = re.compile(r"\w+")
#: Words of a shingle.
SHINGLE = 5


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder; made files count as lineage cuts."""
    return shared_path(spark, name)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: ``df`` written as Parquet in the shared folder and read again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out() -> Column:
    """True where crc32 of the decimal doc_id leaves remainder 2 modulo 4 (null ids: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def evenly_by_label(rows: DataFrame, label: str, most: int, seed: int, *keys: str) -> tuple[DataFrame, list]:
    """About ``most`` of the rows, as many of each label as they come, with the hash ``h`` that chose them; the labels.

    Rows are chosen by a hash of ``keys`` against a share for each label.
    """
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(most).collect()
    if not counts:
        return rows.limit(0).withColumn("h", F.lit(0).cast("long")), []
    share = {r[label]: min(1.0, 1.3 * (most // len(counts)) / r["count"]) for r in counts}
    limit = F.create_map(*(F.lit(x) for k, v in share.items() for x in (k, v * (1 << 30))))
    chosen = rows.withColumn("h", F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 30)))
    return chosen.where(F.col("h") < limit[F.col(label)]), list(share)


def excerpts(chosen: DataFrame, label: str, labels: list, most: int, chars: int, seed: int) -> list[tuple[str, object]]:
    """(text, label) of at most ``most`` of the chosen rows (doc_id, text, label, h), those of the least hashes.

    A longer text gives ``chars`` characters from a place that a hash of its id chooses.
    """
    begin = 1 + F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.greatest(F.length("text") - chars, F.lit(1)))
    cut_out = chosen.select("h", label, F.substring("text", begin.cast("int"), F.lit(chars)).alias("text"))
    got, out = cut_out.orderBy("h", label, "text").limit(2 * most).collect(), []
    for k in labels:
        out += [(r["text"], k) for r in got if r[label] == k][: most // len(labels)]
    return out


def arrow_stage(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over the Arrow batches of each partition; batches without rows are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(batch for batch in batches if batch.num_rows)

    return df.mapInArrow(run, schema)


def record_batch(**columns) -> pa.RecordBatch:
    """A batch of the given arrays (name=Arrow array)."""
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def kept_in_process(key: Hashable, make: Callable[[], Any]) -> Any:
    """``make()``, made once in a Python worker and kept for the tasks that it runs later.

    The functions of this subpackage come anew with each task, so their module's own globals
    don't last; a module of the process does.
    """
    held = sys.modules.setdefault("churnscope_kept", types.ModuleType("churnscope_kept")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def trim() -> None:
    """Give freed memory back, so that a Python worker that waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if give_back is not None:
        give_back(0)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column as str; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def in_slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes sum to about ``most``; a larger item stands alone."""
    begin, total, k = 0, 0, 0
    for k, size in enumerate(sizes, 1):
        if total and total + size > most:
            yield begin, k - 1
            begin, total = k - 1, 0
        total += size
    if k > begin:
        yield begin, k


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    words = WORD.findall(text.lower())
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (two xor-shift-multiply rounds)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``width`` words; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    width = min(width, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        out = mixed(out + words[k : k + len(out)])
    return out


def by_group(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[dict], dict | None], schema: str) -> DataFrame:
    """``fn`` over the rows of each group, given as lists by column, sorted by ``order``.

    ``keys`` are whole numbers without nulls.  A task streams through its groups and holds one at
    a time, so the caller sees to it that groups are of bounded size.
    """
    names = df.columns
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def ready(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            changes = np.zeros(max(0, rows.num_rows - 1), bool)
            for key in keys:
                changes |= np.diff(rows.column(key).to_numpy()) != 0
            cuts = [0, *(np.nonzero(changes)[0] + 1).tolist(), rows.num_rows]
            for lo, hi in zip(cuts, cuts[1:] if last else cuts[1:-1]):
                out = fn({n: rows.column(n).slice(lo, hi - lo).to_pylist() for n in names})
                if out is not None:
                    yield record_batch(**out)
            held = None if last else rows.slice(cuts[-2])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            yield from ready(rows if held is None else pa.concat_tables([held, rows]), False)
        if held is not None:
            yield from ready(held, True)

    return arrow_stage(dealt, run, schema)
