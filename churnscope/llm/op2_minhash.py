"""Document fingerprints: MinHash over word shingles.

A fingerprint is the least value of each of PERMUTATIONS universal hashes (odd multiply and
add modulo 2^64, of which 16 mixed bits are kept) over the hashes of a text's five-word
shingles, in numpy.  The share of equal values estimates the Jaccard similarity of two
texts.  ``near_duplicates`` joins bands of the values in Spark and verifies the Jaccard
similarity of the sets that share a band.

Null texts count as empty; texts without a word have the fingerprint of all ones; fewer
than five words make one shingle.  The order of documents is by doc_id, nulls first, then by
text, so that repeated rows follow one another.  The one document of a table is followed by
itself.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm.common import arrow_stage, cut, mixed, record_batch, shingle_hashes, table, texts_of, word_hashes
from churnscope.llm.links import classes, distinct_sets, set_rows, verified_links

#: Hashes of a fingerprint; bands of so many values for the join; Jaccard similarity of near duplicates.
PERMUTATIONS, BANDS, BAND_ROWS, THRESHOLD = 128, 25, 5, 0.8
#: Ranges of ids at most: their cuts go through the driver and into the plan.
MOST_RANGES = 1 << 12
_RNG = np.random.default_rng(2)
_FACTOR = _RNG.integers(0, 1 << 63, (PERMUTATIONS, 1), np.uint64) << np.uint64(1) | np.uint64(1)
_OFFSET = _RNG.integers(0, 1 << 63, (PERMUTATIONS, 1), np.uint64) << np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The fingerprint's values (uint16) of an array of shingle hashes."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 512):  # a block of hashes stays in the cache
        hashed = _FACTOR * shingles[None, lo : lo + 512]
        hashed += _OFFSET
        np.minimum(least, hashed.min(axis=1), out=least)
    return (mixed(least) >> np.uint64(48)).astype("<u2")  # a least value's own top bits are mostly zero


def fingerprint(text: str) -> np.ndarray:
    """The fingerprint's values of a text."""
    return signature(shingle_hashes(word_hashes(text)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal values."""
    return float((a == b).mean())


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _followed(docs: DataFrame, rows_a_range: int) -> DataFrame:
    """at, place, doc_id, text, last: documents by range of ids, each range ending with the next one's first row.

    The ranges are cut at ids of the table (approximate quantiles, which are ids themselves), so
    the first row of the next range is known to exist; it is added as a row marked ``last``.
    There are MOST_RANGES at most, whatever the table holds: a range is sorted on disk and
    streamed, with one row held, so it needs no bound itself.
    """
    keyed = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("place"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    count = keyed.count()
    ranges = max(1, min(MOST_RANGES, -(-count // rows_a_range)))
    if not count:
        return keyed.select(F.lit(0).alias("at"), "place", "doc_id", "text", F.lit(False).alias("last"))
    shares = [k / ranges for k in range(ranges)]
    found = keyed.agg(F.min("place").alias("least"), F.percentile_approx("place", shares, 20 * ranges).alias("cuts")).first()
    cuts = sorted({found.least, *found.cuts})
    # the range of an id: by the coarse cuts first, then among as many fine ones
    step = max(1, int(len(cuts) ** 0.5))
    coarse, fine = F.array(*map(F.lit, cuts[::step])), F.array(*map(F.lit, cuts))
    block = F.size(F.filter(coarse, lambda c: c <= F.col("place"))) - 1
    at = block * step + F.size(F.filter(F.slice(fine, block * step + 1, F.lit(step)), lambda c: c <= F.col("place"))) - 1
    placed = keyed.withColumn("at", at.cast("int")).withColumn("last", F.lit(False))
    firsts = placed.where(F.col("place").isin(cuts)).groupBy("at", "place", "doc_id").agg(F.min("text").alias("text"))
    before = F.when(F.col("at") == 0, len(cuts) - 1).otherwise(F.col("at") - 1)
    columns = ["at", "place", "doc_id", "text", "last"]
    return placed.select(columns).unionByName(firsts.withColumn("at", before.cast("int")).withColumn("last", F.lit(True)).select(columns))


def fingerprints(docs: DataFrame, rows_a_range: int = 4096) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint (arrays of values), near_edited, near_next of each row."""
    dealt = _followed(docs, rows_a_range).repartition("at").sortWithinPartitions("at", "last", "place", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # at, doc_id, text, values of the row whose next one is to come
        for batch in batches:
            out = []
            for at, doc_id, text in zip(*(batch.column(n).to_pylist() for n in ("at", "doc_id", "text"))):
                values = held[3] if held and held[2] == text else fingerprint(text)
                if held and held[0] == at:
                    edited = edited_text(held[2], text)
                    other = fingerprint(edited)
                    out.append((held[1], len(held[2]), edited, held[3].tobytes(), other.tobytes(), likeness(held[3], other), likeness(held[3], values)))
                held = (at, doc_id, text, values)
            names = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
            columns = zip(*out) if out else [[]] * len(names)
            yield record_batch(**{n: pa.array(c, kind) for n, c, kind in zip(names, columns, kinds)})

    return arrow_stage(dealt, run, "doc_id long, n_chars long, edited string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, root, class_id, n_links: sets that share a band of values, verified by their Jaccard similarity."""

    def bands(tokens: np.ndarray) -> list[int]:
        values = signature(tokens)[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
        return [int.from_bytes(hashlib.blake2b(bytes([k]) + v.tobytes(), digest_size=8).digest(), "little", signed=True) for k, v in enumerate(values)]

    rows = cut(set_rows(docs, bands, pa.list_(pa.int64()), "array<long>"), "sets")
    sets = cut(distinct_sets(rows), "distinct-sets")
    shared = cut(sets.select("rid", F.explode("extra").alias("bucket")), "bands")
    members = shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return classes(rows, sets, verified_links(docs, sets, shared.join(members, "bucket"), threshold))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they and the next one's are."""
    out = fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.lower(F.hex("fingerprint")).alias("fingerprint"),
                      F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
