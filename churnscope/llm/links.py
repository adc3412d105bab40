"""Exact links between sets that share buckets, and classes of linked sets.

Sets are word shingles, told apart by a 128-bit hash, so that copies are one set.  The
callers say which sets share a bucket; here a pair is compared once however many buckets
it shares, within tasks of bounded size, and no pair becomes a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.llm.common import arrow_stage, by_group, cut, record_batch, shingle_hashes, texts_of, word_hashes

#: Weight of the sets that one task compares with as much again, tokens of a weight of 1; bytes of a set's sketch.
BLOCK, TOKENS, SKETCH = 1024, 2048, 64
#: A sketch rules a pair out if it has this many bytes to compare, of which fewer than this share agree.
SKETCH_LEAST, SKETCH_MARGIN = 40, 0.3


def shingle_set(text: str) -> np.ndarray:
    """The sorted hashes of a text's word shingles."""
    return np.unique(shingle_hashes(word_hashes(text)))


def set_id(tokens: np.ndarray) -> bytes:
    """A 128-bit hash of a set; equal sets have equal ids."""
    return xxhash.xxh3_128_digest(tokens.tobytes())


def sketch(tokens: np.ndarray) -> bytes:
    """One byte of the least token of each of SKETCH equal ranges of hashes, 0 for an empty range."""
    out = np.zeros(SKETCH, np.uint8)
    bins, first = np.unique(tokens >> np.uint64(58), return_index=True)
    out[bins.astype(np.int64)] = (tokens[first] % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


def weight(tokens: np.ndarray) -> int:
    """How many sets of TOKENS tokens a set counts for: 1 unless it is larger."""
    return -(-len(tokens) // TOKENS)


def _incidence(members: list[np.ndarray]) -> Iterator[np.ndarray]:
    """0/1 matrices whose columns are the tokens that at least two members hold, some at a time."""
    owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
    _, token, count = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    shared = count >= 2
    number = np.cumsum(shared) - 1
    keep = shared[token]
    token, owner = number[token[keep]], owner[keep]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for lo in range(0, int(shared.sum()), 2048):
        a, b = np.searchsorted(token, [lo, lo + 2048])
        out = np.zeros((len(members), 2048), np.float32)
        out[owner[a:b], token[a:b] - lo] = 1
        yield out


def common_counts(members: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two members (arrays without repeats) share."""
    out = np.zeros((len(members), len(members)), np.float32)
    if sum(map(len, members)):
        for m in _incidence(members):
            out += m @ m.T
    return out


def _unlike(sketches: np.ndarray, threshold: float) -> np.ndarray:
    """True for the pairs that the sketches rule out."""
    out = np.zeros((len(sketches), len(sketches)), bool)
    for lo in range(0, len(sketches), 64):
        part = sketches[lo : lo + 64, None, :]
        used = ((part | sketches[None]) != 0).sum(axis=2)
        alike = ((part == sketches[None]) & (part != 0)).sum(axis=2)
        out[lo : lo + 64] = (used >= SKETCH_LEAST) & (alike < (threshold - SKETCH_MARGIN) * used)
    return out


def _open_pairs(buckets: list[list[int]], bucket: int, side: np.ndarray) -> np.ndarray:
    """True for the pairs that belong to this task: of both sides, without an earlier bucket in common."""
    earlier = [np.array([b for b in own if b < bucket], np.int64) for own in buckets]
    out = common_counts(earlier) == 0
    out &= (side[:, None] != side[None, :]) | (side < 0)[:, None]
    np.fill_diagonal(out, False)
    return out


def _roots(links: np.ndarray) -> np.ndarray:
    """The first member of each member's component."""
    root = np.arange(len(links))
    while True:
        least = np.where(links, root[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _needed(threshold: float) -> Callable[[dict], dict | None]:
    def fn(rows: dict) -> dict | None:
        if len(rows["rid"]) < 2:
            return None
        bucket, side = rows["bucket"][0], np.array(rows["side"])
        sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(-1, SKETCH)
        pairs = ~_unlike(sketches, threshold)
        pairs &= _open_pairs(rows["buckets"], bucket, side)
        use = np.nonzero(pairs.any(axis=1))[0].tolist()
        if not use:
            return None
        pick = lambda name, kind: pa.array([rows[name][k] for k in use], kind)
        return {"task": pick("task", pa.int64()), "bucket": pick("bucket", pa.int64()), "side": pick("side", pa.int32()),
                "rid": pick("rid", pa.binary()), "copies": pick("copies", pa.int64()),
                "buckets": pick("buckets", pa.list_(pa.int64()))}

    return fn


def _linked(threshold: float) -> Callable[[dict], dict | None]:
    def fn(rows: dict) -> dict | None:
        if len(rows["rid"]) < 2:
            return None
        tokens = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
        size = np.array([len(t) for t in tokens], np.float64)
        common = common_counts(tokens).astype(np.float64)
        links = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
        links &= _open_pairs(rows["buckets"], rows["bucket"][0], np.array(rows["side"]))
        use = np.nonzero(links.any(axis=1))[0]
        if not len(use):
            return None
        root = _roots(links)
        return {"rid": pa.array([rows["rid"][k] for k in use], pa.binary()),
                "links": pa.array((links @ np.array(rows["copies"], np.int64))[use]),
                "root": pa.array([rows["rid"][root[k]] for k in use], pa.binary())}

    return fn


def set_rows(docs: DataFrame, extra: Callable[[np.ndarray], object], extra_type: pa.DataType, extra_ddl: str) -> DataFrame:
    """doc_id, text_hash, rid, sketch, weight and extra (of the tokens) of each row; the last four null if it has no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text) for text in texts_of(batch)]
            each = lambda fn, kind: pa.array([fn(s) if len(s) else None for s in sets], kind)
            yield record_batch(doc_id=batch.column("doc_id"), text_hash=batch.column("text_hash"), rid=each(set_id, pa.binary()),
                               sketch=each(sketch, pa.binary()), weight=each(weight, pa.int64()), extra=each(extra, extra_type))

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return arrow_stage(rows, run, f"doc_id long, text_hash long, rid binary, sketch binary, weight long, extra {extra_ddl}")


def distinct_sets(rows: DataFrame) -> DataFrame:
    """rid, first_id (its least doc_id), copies, sketch, weight, extra: one row for each set."""
    return rows.where("rid IS NOT NULL").groupBy("rid").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
                                   F.first("sketch").alias("sketch"), F.first("weight").alias("weight"), F.first("extra").alias("extra"))


def _tokens(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in texts_of(batch)]
            yield record_batch(rid=pa.array([set_id(s) for s in sets], pa.binary()), tokens=pa.array([s.tobytes() for s in sets], pa.binary()))

    return arrow_stage(docs.select("text"), run, "rid binary, tokens binary")


def first_ids(sets: DataFrame, rids: DataFrame) -> DataFrame:
    """wanted: the least documents of the sets named in ``rids``."""
    return rids.join(sets.select("rid", "first_id"), "rid").select(F.col("first_id").alias("wanted")).distinct()


def tokens_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rid, tokens of the sets of the documents in ``wanted`` (and of others under the same doc_id), made again from their texts.

    The texts are shuffled, unless ``wanted`` is a written table that Spark finds small enough to broadcast.
    """
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    return _tokens(texts).dropDuplicates(["rid"])


def verified_links(docs: DataFrame, sets: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """rid, links, root: what each comparison found.

    ``entries`` (rid, bucket, members) says which sets share a bucket of how many members; a
    bucket whose members weigh more than BLOCK is compared block by block, so that a task holds
    about BLOCK x TOKENS tokens a side at most, or one larger set.  links counts the documents of the
    linked sets, root is the least set of the rid's component there.  First the sketches and the
    lists of buckets decide which sets a task needs at all; only for those are the tokens made
    again from the documents' texts and sent to the task.
    """
    lists = entries.groupBy("rid").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    held = cut(lists.join(sets.select("rid", "sketch", "copies"), "rid"), "bucket-lists")
    heavy = entries.join(sets.where("weight > 1").select("rid", "weight"), "rid")
    heavy = cut(heavy.groupBy("bucket").agg(F.sum(F.col("weight") - 1).alias("more")), "heavy-buckets")
    entries = entries.join(heavy, "bucket", "left")
    blocks = F.ceil((F.col("members") + F.coalesce("more", F.lit(0))) / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    dealt = (
        entries.withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("rid", "bucket",
                F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
                F.when(F.col("own") == F.col("other"), F.lit(-1)).when(F.col("own") < F.col("other"), F.lit(0)).otherwise(F.lit(1)).alias("side"))
    )
    tasks = dealt.join(held, "rid").select("task", "bucket", "side", "rid", "copies", "buckets", "sketch")
    kept = "task long, bucket long, side int, rid binary, copies long, buckets array<long>"
    needed = cut(by_group(tasks, ["task", "bucket"], ["rid"], _needed(threshold), kept), "needed-sets")
    tokens = tokens_of(docs, first_ids(sets, needed.select("rid").distinct()))
    return by_group(needed.join(tokens, "rid"), ["task", "bucket"], ["rid"], _linked(threshold), "rid binary, links long, root binary")


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """One step of large-star or small-star: neighbours are tied to the least one instead."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.where(F.col("v") > F.col("u")) if large else both
    tied = tied.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        tied = tied.union(least.select("u", F.col("m").alias("v")))
    return tied.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the component's least node) of all nodes of ``edges`` (u, v) but the roots.

    Alternates large-star and small-star steps until the edges stay as they are.
    """
    edges = cut(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "edges")
    state = None
    while True:
        edges = cut(_starred(_starred(edges, True), False), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def classes(rows: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, text_hash, root, class_id (the least doc_id of its class), n_links (documents it is linked to) of each row.

    Rows without a word are classes of their own, without links and with a null root.
    """
    found = cut(found, "links")
    counts = found.groupBy("rid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rid").alias("u"), F.col("root").alias("v")))
    rooted = (
        sets.select("rid", "first_id", "copies").join(roots.withColumnRenamed("node", "rid"), "rid", "left")
        .withColumn("root", F.coalesce("root", "rid")).join(counts, "rid", "left")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    by_set = rooted.join(least, "root").select(
        "rid", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    own = rows.select("doc_id", "text_hash", "rid")
    linked = own.where("rid IS NOT NULL").join(by_set, "rid").select("doc_id", "text_hash", "root", "class_id", "n_links")
    wordless = own.where("rid IS NULL").select("doc_id", "text_hash", F.col("rid").alias("root"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.union(wordless)


def first_of_each_class(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay if one of each class does: the least doc_id, then the least hash of the text.

    named: doc_id, text_hash, root of the rows of ``docs``.  Only rows that repeat both id and text are
    gathered to drop all but one; the other texts move once.
    """
    own = named.withColumn("alone", F.when(F.col("root").isNull(), F.struct("doc_id", "text_hash")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    stay = own.groupBy("root", "alone").agg(first).select(F.col("first.doc_id").alias("stay_id"), F.col("first.text_hash").alias("stay_hash"))
    times = named.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"))
    stay = stay.join(times, F.col("stay_id").eqNullSafe(F.col("doc_id")) & (F.col("stay_hash") == F.col("text_hash"))).select("stay_id", "stay_hash", "times")
    columns = docs.columns
    kept = docs.withColumn("stay_hash_of_text", F.xxhash64("text")).join(
        stay, F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("stay_hash_of_text") == F.col("stay_hash")))
    again = kept.where("times > 1").dropDuplicates(["stay_id", "stay_hash"])
    return kept.where("times = 1").select(columns).union(again.select(columns))
