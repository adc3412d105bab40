"""N-gram Jaccard join by chosen paths.

In every run, each set walks a random tree: at a node it goes on to the children named by
those of its tokens whose hash at that node falls under 1 / (threshold * size).  Two sets
whose Jaccard similarity reaches the threshold share one child on average at every node,
unlike sets share few.  Small buckets (nodes) are compared by brute force, larger ones are
split by the next sampled token, and the runs are repeated until the chance to meet in one
of them reaches the target recall.  Sets that meet are compared exactly (``links``), so no
pair under the threshold is linked.

Two levels are made of all sets.  Where a bucket is then still larger than a block of the
comparison and its sets are unlike on average, only its sets go further down, level by
level, and repeat more runs, as a pair meets more rarely at a deeper node.  Large buckets of
sets that are alike (a group of near copies doesn't get smaller by splitting), and those at
the last level, are compared block by block.

Null texts count as empty; texts without a word have no links; texts of fewer than five
words have one shingle of all their words.  Copies are one set and are linked to one
another.  A class is a connected component of links, named by its least doc_id (null if it
has no other).  Repeated rows are copies; an empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm import links
from churnscope.llm.common import arrow_stage, cut, mixed, record_batch, table
from churnscope.llm.links import classes, distinct_sets, first_ids, set_rows, tokens_of, verified_links

#: Jaccard similarity that links, chance to find a pair at the threshold, members of a bucket that isn't split.
THRESHOLD, RECALL, SMALL_BUCKET = 0.8, 0.999, 128
#: The last level; a bucket is alike if its mean similarity is this share of the threshold, by so many bytes of its sketches.
#: At a share r, 48 runs of 12 levels come to 48 r^12 buckets of all its sets, 11 runs of two to 11 r^2: splitting saves nine
#: tenths of the comparisons under r = 0.69, and hardly any near 0.9.
DEPTH, ALIKE, ALIKE_BYTES = 12, 0.65, 16
_PATHS = pa.list_(pa.struct([("path", pa.int64()), ("next", pa.list_(pa.int64()))]))


def runs_for(recall: float, depth: int = 2) -> int:
    """Runs until a pair at the threshold meets at ``depth`` with this chance.

    Such a pair shares a Poisson number of children of mean 1 at every node.
    """
    meet = 1.0
    for _ in range(depth):
        meet = 1 - math.exp(-meet)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


class ChosenPaths:
    """The nodes that a set comes to in all runs."""

    def __init__(self, threshold: float, runs: int, seed: int):
        rng = np.random.default_rng(seed)
        self.threshold, self.seed = threshold, np.uint64(seed)
        self.factor = rng.integers(0, 1 << 63, (runs, 1), np.uint64) << np.uint64(1) | np.uint64(1)
        self.offset = rng.integers(0, 1 << 63, (runs, 1), np.uint64)

    def _chosen(self, tokens: np.ndarray, factor: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node, token) places of the tokens chosen at each node."""
        limit = np.uint64(min(2**64 - 1, int(2**64 / (self.threshold * len(tokens)))))
        nodes, places = [], []
        for lo in range(0, len(tokens), 4096):
            node, place = np.nonzero(tokens[None, lo : lo + 4096] * factor + offset <= limit)
            nodes.append(node)
            places.append(place + lo)
        return np.concatenate(nodes), np.concatenate(places)

    def _first(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of the first level and the place of the token that led to each."""
        node, place = self._chosen(tokens, self.factor, self.offset)
        return mixed(mixed(tokens[place]) + self.offset[node, 0]), place

    def _next(self, tokens: np.ndarray, nodes: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The children of the nodes, the row of each one's parent and the places on its path; ``used``: those of the nodes."""
        parent, place = self._chosen(tokens, (mixed(nodes) | np.uint64(1))[:, None], mixed(nodes ^ self.seed)[:, None])
        new = (used[parent] != place[:, None]).all(axis=1)
        parent, place = parent[new], place[new]
        child = mixed(nodes[parent] ^ mixed(tokens[place] + self.seed))
        return child, parent, np.column_stack([used[parent], place])

    def __call__(self, tokens: np.ndarray) -> list[dict]:
        """The first two levels."""
        first, place = self._first(tokens)
        if not len(first):
            return []
        second, parent, _ = self._next(tokens, first, place[:, None])
        return [{"path": path, "next": second[parent == k].view(np.int64).tolist()}
                for k, path in enumerate(first.view(np.int64).tolist())]

    def below(self, tokens: np.ndarray, split: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """The children of the ``fresh`` nodes; beyond the first level the way goes through nodes that are ``split``."""
        nodes, used = self._first(tokens)
        used, out = used[:, None], []
        while len(nodes):
            child, parent, path = self._next(tokens, nodes, used)
            out.append(child[np.isin(nodes, fresh)[parent]])
            on = np.isin(child, split)
            nodes, used = child[on], path[on]
        return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def path_maker(threshold: float, runs: int, seed: int = 5) -> ChosenPaths:
    """A function from tokens to the first two levels of the set's paths in all runs."""
    return ChosenPaths(threshold, runs, seed)


def _counted(entries: DataFrame, path: str) -> DataFrame:
    """Paths that at least two sets took, and how many did."""
    return entries.groupBy(path).agg(F.count(F.lit(1)).alias("members")).where("members > 1")


def bucket_entries(sets: DataFrame, small: int = SMALL_BUCKET) -> DataFrame:
    """rid, bucket, members of the buckets to compare: a path that few sets took, or its next level."""
    first = sets.select("rid", F.explode("extra").alias("p")).select("rid", F.col("p.path").alias("bucket"), F.col("p.next").alias("next"))
    first = cut(first.join(_counted(first, "bucket"), "bucket"), "paths")
    second = first.where(F.col("members") > small).select("rid", F.explode("next").alias("bucket")).distinct()
    second = second.join(_counted(second, "bucket"), "bucket").select("rid", "bucket", "members")
    return cut(first.where(F.col("members") <= small).select("rid", "bucket", "members").union(second), "buckets")


def unlike_buckets(entries: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """bucket of those with more than a block of members whose sketches agree less than ALIKE x ``threshold`` on average."""
    large = entries.where(F.col("members") > links.BLOCK).join(sets.select("rid", "sketch"), "rid")
    byte = F.expr(f"explode(transform(sequence(1, {ALIKE_BYTES}), k -> struct(k AS place, substring(sketch, k, 1) AS byte)))")
    counts = large.select("bucket", byte.alias("b")).where("b.byte != X'00'").groupBy("bucket", "b.place", "b.byte").agg(F.count(F.lit(1)).cast("double").alias("n"))
    agree = counts.groupBy("bucket", "place").agg((F.sum(F.col("n") * F.col("n")) / F.pow(F.sum("n"), F.lit(2))).alias("agree"))
    return agree.groupBy("bucket").agg(F.avg("agree").alias("agree")).where(F.col("agree") < ALIKE * threshold).select("bucket")


def _children(tokens: DataFrame, split: DataFrame, level: int, makers: list[ChosenPaths]) -> DataFrame:
    """rid, bucket, members below the nodes that were split at ``level``; tokens: rid, tokens; split: rid, bucket, level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            below = []
            for raw, all_, fresh in zip(*(batch.column(n).to_pylist() for n in ("tokens", "split", "fresh"))):
                way, last = (np.array(x, np.int64).view(np.uint64) for x in (all_, fresh))
                below.append(np.concatenate([m.below(np.frombuffer(raw, np.uint64), way, last) for m in makers]).view(np.int64))
            yield record_batch(rid=batch.column("rid"), below=pa.array(below, pa.list_(pa.int64())))

    fresh = F.collect_list(F.when(F.col("level") == level, F.col("bucket"))).alias("fresh")
    ways = split.groupBy("rid").agg(F.collect_list("bucket").alias("split"), fresh).where(F.size("fresh") > 0)
    found = arrow_stage(tokens.join(ways, "rid").select("rid", "tokens", "split", "fresh"), run, "rid binary, below array<long>")
    entries = cut(found.select("rid", F.explode("below").alias("bucket")).distinct(), "deeper-paths")
    return entries.join(_counted(entries, "bucket"), "bucket").select("rid", "bucket", "members")


def split_large(docs: DataFrame, sets: DataFrame, entries: DataFrame, threshold: float, recall: float) -> DataFrame:
    """``entries`` (rid, bucket, members) with large buckets of unlike sets replaced by deeper ones.

    The sets of such buckets repeat the runs that a pair needs to meet at the last level with a chance
    of ``recall``; the other sets keep the runs of two levels.  All these runs begin at once, so that
    buckets of sets with a passage in common get fewer with each level.
    """
    runs = runs_for(recall)
    makers = [path_maker(threshold, runs), path_maker(threshold, runs_for(recall, DEPTH) - runs, seed=6)]
    tokens = split = None
    kept: list[DataFrame] = []
    for level in range(2, DEPTH + 1):  # the added runs are a level behind
        buckets = cut(unlike_buckets(entries, sets, threshold), "unlike-buckets")
        if buckets.isEmpty():
            break
        opened = cut(entries.join(buckets, "bucket", "left_semi").select("rid", "bucket", F.lit(level).alias("level")), "split-buckets")
        kept.append(entries.join(buckets, "bucket", "left_anti").select("rid", "bucket", "members"))
        split = opened if split is None else split.union(opened)
        if tokens is None:
            named = opened.select("rid").distinct()
            wanted = cut(first_ids(sets, named), "split-ids")
            tokens = cut(tokens_of(docs, wanted).join(named, "rid", "left_semi"), "split-tokens")
            again = arrow_stage(tokens, _two_levels(makers[1]), "rid binary, extra array<struct<path: long, next: array<long>>>")
            entries = _children(tokens, split, level, makers).union(bucket_entries(cut(again, "more-runs")))
        else:
            entries = _children(tokens, split, level, makers)
        entries = cut(entries, "deeper-buckets")
    for part in kept:
        entries = entries.union(part)
    return cut(entries, "all-buckets") if kept else entries


def _two_levels(maker: ChosenPaths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = [maker(np.frombuffer(raw, np.uint64)) for raw in batch.column("tokens").to_pylist()]
            yield record_batch(rid=batch.column("rid"), extra=pa.array(extra, _PATHS))

    return run


def similar_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, text_hash, root, class_id, n_links of every row of ``docs``."""
    paths = path_maker(threshold, runs_for(recall))
    rows = cut(set_rows(docs, paths, _PATHS, "array<struct<path: long, next: array<long>>>"), "sets")
    sets = cut(distinct_sets(rows), "distinct-sets")
    entries = split_large(docs, sets, bucket_entries(sets), threshold, recall)
    return classes(rows, sets, verified_links(docs, sets, entries, threshold))


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of near copies and its number of links."""
    return similar_classes(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "class_id", "n_links")
