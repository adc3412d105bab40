"""Quality classifier: logistic regression on hashed word n-grams.

Words are runs of letters or digits and runs of marks.  Single words and pairs of words are
hashed into 2^BITS weights; one more weight stands for a word that repeats the one before,
one for a pair that the text has had before.  A text's features are the frequencies of its
n-grams.  Training is follow-the-regularised-leader (proximal, per-coordinate rates, L1 and
L2); a score is the logistic function of a sparse dot product.

Training takes SAMPLE_DOCS labelled documents at most (chosen by a hash of their ids, as
many of either label as there are, up to half) and excerpts of SAMPLE_CHARS of longer ones.
A null text counts as empty and has only the intercept; without any label every score is
0.5.  Null labels are ignored; a document with several labels trains with each.  Repeated
rows give repeated results, an empty table an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm.common import arrow_stage, evenly_by_label, excerpts, held_out, mixed, record_batch, table, texts_of

#: Hashed weights (as bits); labelled documents and characters of one that training may use; passes.
BITS, SAMPLE_DOCS, SAMPLE_CHARS, EPOCHS = 18, 6000, 20_000, 4
#: Learning rate, its smoothing, L1 and L2; what frequencies are multiplied by; score of the label 1.
ALPHA, BETA, L1, L2, SCALE, CUT = 0.3, 1.0, 0.02, 0.1, 10.0, 0.7
_WORD = re.compile(r"\w+|[^\w\s]+")
_AGAIN, _SEEN, _ONE, SLOTS = (1 << BITS), (1 << BITS) + 1, (1 << BITS) + 2, (1 << BITS) + 3


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text's features."""
    words = _WORD.findall(text)
    if not words:
        return np.array([_ONE]), np.ones(1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    pairs = mixed(h[:-1] * np.uint64(3) + h[1:])
    again = int((h[1:] == h[:-1]).sum())
    seen = len(pairs) - len(np.unique(pairs))
    grams = np.concatenate([h, pairs]) >> np.uint64(64 - BITS)
    slots, counts = np.unique(grams.astype(np.int64), return_counts=True)
    values = np.concatenate([counts, [again, seen]]) * (SCALE / len(words))
    return np.concatenate([slots, [_AGAIN, _SEEN, _ONE]]), np.append(np.sqrt(values), 1.0)


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(35.0, max(-35.0, x))))


def train(samples: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 3) -> np.ndarray:
    """Weights by follow-the-regularised-leader updates, one text at a time."""
    z, n = np.zeros(SLOTS), np.zeros(SLOTS)

    def weights(slots: np.ndarray) -> np.ndarray:
        zs = z[slots]
        w = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[slots])) / ALPHA + L2)
        return np.where(np.abs(zs) <= L1, 0.0, w)

    rows = [(*features(text), label) for text, label in samples]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            slots, values, label = rows[k]
            w = weights(slots)
            g = (_sigmoid(float(w @ values)) - label) * values
            squared = n[slots]
            z[slots] += g - (np.sqrt(squared + g * g) - np.sqrt(squared)) / ALPHA * w
            n[slots] = squared + g * g
    return weights(np.arange(SLOTS)).astype(np.float32)


def score(weights: np.ndarray, text: str) -> float:
    slots, values = features(text)
    return float(_sigmoid(float(weights[slots] @ values)))


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> list[tuple[str, int]]:
    """(excerpt, quality) of at most ``most`` documents that training may use."""
    usable = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out()).distinct()
    usable = usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")  # labels of absent documents take no places
    chosen, marks = evenly_by_label(usable, "quality", most, 3, "doc_id")
    chosen = F.broadcast(chosen.orderBy("h", "doc_id", "quality").limit(2 * most))  # so many rows of three numbers at most
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    return excerpts(texts, "quality", marks, most, SAMPLE_CHARS, 3)


def score_documents(docs: DataFrame, weights: np.ndarray, carried: list[str]) -> DataFrame:
    """``carried`` columns and score of each row.  The weights are a fixed 1 MB and are broadcast."""
    columns = [F.col(c).alias(f"kept_{k}") for k, c in enumerate(carried)]
    rows = docs.select(*columns, "text")
    names = rows.columns[:-1]
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            yield record_batch(**{n: batch.column(n) for n in names}, score=pa.array([score(own, t) for t in texts_of(batch)], pa.float64()))

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1])
    out = arrow_stage(rows, run, f"{types}, score double")
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, carried)), "score")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    weights = train(sample(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))
    scored = score_documents(docs, weights, ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
