"""Quality rules: fixed base rules, then a calibrated logistic regression on hashed n-grams.

Words are runs of characters other than space, tab and the line breaks \\n to \\r.  The base
rules count, per text, words, their characters, symbols, lines that repeat an earlier one, and
the words that lie in a window of WINDOW words found twice or more; a text with under MIN_WORDS
words, or with over REPEAT_PERCENT percent repeated words, fails.

The rest is judged by the model.  Its features are the shares that byte n-grams of each of
CHAR_GRAMS lengths, single words and pairs of words have of a text, hashed into 2^BITS weights
(a pair of equal words counts as one feature, whatever the word).  A text's logit is therefore
a sum of means of weights, which is taken for whole Arrow batches at once.  Weights are
trained by stochastic gradients with a rate for each weight, on three quarters of the labelled
sample; a logistic curve fitted to the other quarter (Platt's, with his smoothed targets)
turns logits into probabilities.  A text is kept if its probability of being good is KEEP or
more.

Training takes SAMPLE_DOCS labelled documents at most, chosen by a hash of their ids, as many
of either label as there are, up to half, and excerpts of SAMPLE_CHARS of longer ones; a
quarter of the ids (held_out) is never learned from.  Without any label the model judges
nothing: each probability is KEEP, and the base rules decide.  A null text counts as empty
and fails the base rules.  Repeated rows give repeated results, an empty table an empty
result; null labels and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm.bytewords import Words, byte_class, numbered, text_slices, utf8
from churnscope.llm.common import arrow_stage, evenly_by_label, excerpts, held_out, mixed, record_batch, table

#: Base rules: least words, words of a window, most repeated words in percent, symbols.
MIN_WORDS, WINDOW, REPEAT_PERCENT, SYMBOLS = 20, 8, 30, "#*$%&|<>"
#: Least calibrated probability of a kept text.
KEEP = 0.5
#: Hashed weights (as bits), lengths of byte n-grams; documents and characters of one that training may use; passes, rate, decay.
BITS, CHAR_GRAMS, SAMPLE_DOCS, SAMPLE_CHARS, EPOCHS, RATE, DECAY = 18, (2, 3, 4), 4000, 3000, 6, 0.5, 1e-6
#: Bytes of text of a slice; bytes of a text whose n-grams are held at once.
SLICE_BYTES, CHUNK = 1 << 20, 1 << 20
_BLANK = byte_class(" \t\n\x0b\x0c\r")
_SYMBOL = byte_class(SYMBOLS)
_GROUPS = len(CHAR_GRAMS) + 2


class Texts:
    """The bytes, words and word numbers of a slice of texts."""

    def __init__(self, column: pa.Array):
        self.raw, self.at = utf8(column)
        self.count = len(column)
        self.words = Words(self.raw, self.at, ~_BLANK)
        self.code, self.spelling = self.words.codes()

    def per_text(self, places: np.ndarray) -> np.ndarray:
        """How many of the byte places lie in each text."""
        return np.diff(np.searchsorted(places, self.at))


def repeated_words(doc: np.ndarray, code: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """True for each word in a window that its text holds twice or more.

    Windows are met by a 64-bit hash; those that share one are compared word by word.
    """
    out = np.zeros(len(code), bool)
    n = len(code) - window + 1
    if n <= 1:
        return out
    h = mixed(doc[:n].astype(np.uint64) + np.uint64(1))
    for k in range(window):
        h = mixed(h + code[k : k + n].astype(np.uint64))
    inside = np.flatnonzero(doc[:n] == doc[window - 1 :])
    h = h[inside]
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    shared = twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h
    inside, h = inside[shared], h[shared]
    order = np.argsort(h, kind="stable")
    inside, h = inside[order], h[order]
    same = doc[inside[1:]] == doc[inside[:-1]]
    for k in range(window):
        same &= code[inside[1:] + k] == code[inside[:-1] + k]
    if (same != (h[1:] == h[:-1])).any():  # different windows share a hash
        rows = np.stack([doc[inside], *(code[inside + k] for k in range(window))], axis=1)
        _, group, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        inside = inside[counts[group.ravel()] > 1]
    covered = np.zeros(len(code) + 1, np.int64)
    np.add.at(covered, inside, 1)
    np.add.at(covered, inside + window, -1)
    return np.cumsum(covered[:-1]) > 0


def repeated_lines(texts: Texts) -> np.ndarray:
    """Lines with a word that equal an earlier one, of each text."""
    breaks = np.flatnonzero(texts.raw == 10)
    begin = np.sort(np.concatenate([texts.at[:-1], breaks + 1]))
    doc = np.sort(np.concatenate([np.arange(texts.count), np.searchsorted(texts.at, breaks, "right") - 1]))
    removed = np.searchsorted(breaks, begin)
    offsets = np.append(begin - removed, len(texts.raw) - len(breaks))
    lines = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(texts.raw[texts.raw != 10])])
    coded = lines.dictionary_encode()
    with_word = np.zeros(len(begin), bool)
    with_word[np.searchsorted(begin, texts.words.first, "right") - 1] = True
    doc, code = doc[with_word], coded.indices.to_numpy(zero_copy_only=False)[with_word].astype(np.int64)
    distinct, _ = numbered(doc * max(1, len(coded.dictionary)) + code)
    return np.bincount(doc, minlength=texts.count) - np.bincount(distinct // max(1, len(coded.dictionary)), minlength=texts.count)


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The base rules' counts of each text, as whole numbers."""
    begins = (texts.raw & 0xC0) != 0x80  # bytes that begin a character
    repeated = repeated_words(texts.words.doc, texts.code)
    return {
        "n_words": np.bincount(texts.words.doc, minlength=texts.count),
        "word_chars": texts.per_text(np.flatnonzero(begins & ~_BLANK[texts.raw])),
        "n_symbols": texts.per_text(np.flatnonzero(_SYMBOL[texts.raw])),
        "n_dup_lines": repeated_lines(texts),
        "n_repeat_words": np.bincount(texts.words.doc[repeated], minlength=texts.count),
    }


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > REPEAT_PERCENT * counts["n_words"])


def _slots(h: np.ndarray) -> np.ndarray:
    """Weights of 32-bit hashes."""
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - BITS)


def gram_slots(texts: Texts) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, text, slot) arrays of all n-grams, in text order; those of bytes come in chunks."""
    for group, n in enumerate(CHAR_GRAMS):
        for begin in range(0, len(texts.raw) - n + 1, CHUNK):
            raw = texts.raw[begin : begin + CHUNK + n - 1].astype(np.uint32)
            count = len(raw) - n + 1
            h = np.full(count, n, np.uint32)
            for k in range(n):
                h = h * np.uint32(0x01000193) + raw[k : k + count]
            doc = np.repeat(np.arange(texts.count, dtype=np.int32), np.diff(np.clip(texts.at, begin, begin + count)))
            whole = np.ones(count, bool)
            for k in range(1, n):  # what begins so near to a text's end reaches into the next one
                near = (texts.at[1:] - k)[np.diff(texts.at) >= k] - begin
                whole[near[(near >= 0) & (near < count)]] = False
            yield group, doc[whole], _slots(h[whole])
    spelled = np.fromiter((xxhash.xxh32_intdigest(w) for w in texts.spelling.to_pylist()), np.uint32, len(texts.spelling))
    word, doc = spelled[texts.code], texts.words.doc
    yield len(CHAR_GRAMS), doc, _slots(word)
    pair = np.where(texts.code[1:] == texts.code[:-1], np.uint32(1), word[:-1] * np.uint32(0x01000193) + word[1:] * np.uint32(3))
    within = doc[1:] == doc[:-1]
    yield len(CHAR_GRAMS) + 1, doc[1:][within], _slots(pair[within])


class Model(NamedTuple):
    """Weights (by group and slot), intercept, and slope and intercept of the calibration."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def logits(texts: Texts, weights: np.ndarray, bias: float) -> np.ndarray:
    """The logit of each text: the sum over the groups of the mean weight of its n-grams."""
    total, count = np.zeros((_GROUPS, texts.count)), np.zeros((_GROUPS, texts.count))
    for group, doc, slot in gram_slots(texts):
        if len(doc):
            first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            total[group, doc[first]] += np.add.reduceat(weights[group][slot], first, dtype=np.float64)
            count[group, doc[first]] += np.diff(np.append(first, len(doc)))
    return bias + (total / np.maximum(count, 1)).sum(axis=0)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def sparse_rows(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text its distinct weights (group * 2^BITS + slot) and their shares."""
    found: list[list[np.ndarray]] = [[] for _ in range(texts.count)]
    for group, doc, slot in gram_slots(texts):
        ends = np.searchsorted(doc, np.arange(texts.count + 1))
        for k in range(texts.count):
            found[k].append(slot[ends[k] : ends[k + 1]].astype(np.int64) + (group << BITS))
    out = []
    for grams in found:
        slots, counts = np.unique(np.concatenate(grams), return_counts=True)
        sizes = np.bincount(slots >> BITS, weights=counts, minlength=_GROUPS)
        out.append((slots, counts / sizes[slots >> BITS]))
    return out


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 13) -> tuple[np.ndarray, float]:
    """Weights by group and slot, and the intercept, by stochastic gradients with a rate for each weight."""
    w, squares, bias, bias_squares = np.zeros(_GROUPS << BITS), np.full(_GROUPS << BITS, 1e-6), 0.0, 1.0
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            slots, shares = rows[k]
            error = float(_sigmoid(w[slots] @ shares + bias)) - labels[k]
            gradient = error * shares + DECAY * w[slots]
            squares[slots] += gradient * gradient
            w[slots] -= RATE * gradient / np.sqrt(squares[slots])
            bias_squares += error * error
            bias -= RATE * error / np.sqrt(bias_squares)
    return w.reshape(_GROUPS, 1 << BITS), bias


def fit_calibration(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of least cross-entropy against smoothed labels, by Newton steps."""
    good = labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    theta, x = np.array([1.0, 0.0]), np.stack([z, np.ones(len(z))], axis=1)

    def loss(t: np.ndarray) -> float:
        s = x @ t
        return float((np.logaddexp(0, s) - target * s).sum())

    for _ in range(100):
        p = _sigmoid(x @ theta)
        gradient = x.T @ (p - target)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), gradient)
        while loss(theta - step) > loss(theta) and np.abs(step).max() > 1e-12:
            step /= 2
        theta = theta - step
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def train(samples: list[tuple[str, int]]) -> Model | None:
    """The model of (text, label) samples; None without any.  Every fourth sample of each label calibrates."""
    if not samples:
        return None
    place = {0: 0, 1: 0}
    calibrates = np.zeros(len(samples), bool)
    for k, (_, label) in enumerate(samples):
        place[label] += 1
        calibrates[k] = place[label] % 4 == 0
    labels = np.array([label for _, label in samples])
    rows = sparse_rows(Texts(pa.array([t for (t, _), c in zip(samples, calibrates) if not c], pa.string())))
    weights, bias = fit_weights(rows, labels[~calibrates])
    weights = weights.astype(np.float32)
    if not calibrates.any():
        return Model(weights, bias, 1.0, 0.0)
    z = logits(Texts(pa.array([t for (t, _), c in zip(samples, calibrates) if c], pa.string())), weights, bias)
    return Model(weights, bias, *fit_calibration(z, labels[calibrates]))


def probabilities(texts: Texts, model: Model | None) -> np.ndarray:
    """The calibrated probability of each text of being good."""
    if model is None:
        return np.full(texts.count, KEEP)
    return _sigmoid(model.slope * logits(texts, model.weights, model.bias) + model.shift)


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> list[tuple[str, int]]:
    """(excerpt, quality) of at most ``most`` labelled documents that are not held out."""
    usable = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out()).distinct()
    usable = usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen, marks = evenly_by_label(usable, "quality", most, 13, "doc_id")
    chosen = F.broadcast(chosen.orderBy("h", "doc_id", "quality").limit(2 * most))  # so many rows of three numbers at most
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    return excerpts(texts, "quality", marks, most, SAMPLE_CHARS, 13)


def judge(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, the base counts, base_failed, probability and kept of each row.  The model is a fixed 5 MB and is broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            texts = Texts(batch.column("text"))
            counts = base_counts(texts)
            failed, probability = base_failed(counts), probabilities(texts, sent.value)
            yield record_batch(doc_id=batch.column("doc_id"), **{k: pa.array(v.astype(np.int64)) for k, v in counts.items()},
                               base_failed=pa.array(failed), probability=pa.array(probability), kept=pa.array(~failed & (probability >= KEEP)))

    return arrow_stage(docs.select("doc_id", "text"), run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                       "n_repeat_words long, base_failed boolean, probability double, kept boolean")


def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts and the verdict of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return judge(docs, train(sample(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))))
