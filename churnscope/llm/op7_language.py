"""Language ID by a bidirectional gated recurrent network over bytes.

The UTF-8 bytes of a text are cut into windows.  One gated recurrent layer reads a window
forwards, another backwards; at every byte a softmax over both states gives label
probabilities, and a document's probabilities are their mean over all its bytes.  Training
is backpropagation through time in numpy (Adam, cross-entropy at every byte).

Training takes SAMPLE_DOCS documents at most (a bounded sample by a hash of their ids, spread
evenly over the labels) and SAMPLE_WINDOWS windows of an excerpt of SAMPLE_CHARS of each.  A null text, or one without a
letter, is ``und`` with score 0; so is every text if there is nothing to learn from.
Repeated rows give repeated results, an empty table an empty result; other columns are
ignored.  The network is a few kilobytes and travels with the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm.common import arrow_stage, evenly_by_label, excerpts, held_out, in_slices, record_batch, table

#: Bytes of a window, hidden units of each direction.
WINDOW, HIDDEN = 64, 8
#: Documents, characters of one and windows of one that training may use; passes over them; windows of a step; step size.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_WINDOWS, EPOCHS, STEP_WINDOWS, RATE = 2400, 4096, 2, 6, 64, 0.02
#: Windows that are labelled at once, bytes of texts that are held at once.
BATCH_WINDOWS, SLICE_BYTES = 2048, 2_000_000
UNKNOWN = "und"


@dataclass
class Network:
    """Weights of both directions (first axis 0 forwards, 1 backwards) and of the output.

    table: input weights of each byte, (2, 256, 3, hidden), for the gates reset and update and
    the candidate; inner: (2, 3, hidden, hidden); out: (2 * hidden, labels); bias: (labels,).
    """

    table: np.ndarray
    inner: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    labels: list[str]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def states(net: Network, direction: int, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each byte, (window, rows, hidden), of windows ``ids`` (rows, window).

    ``keep`` gets what backpropagation needs of each step.
    """
    table, inner = net.table[direction], net.inner[direction]
    rows, width = ids.shape
    hidden = inner.shape[1]
    kind = table.dtype
    out = np.empty((width, rows, hidden), kind)
    state = np.zeros((rows, hidden), kind)
    parts = [np.ascontiguousarray(table[:, k]) for k in range(3)]
    columns = np.ascontiguousarray(ids.T)
    gate, forget, new = (np.empty((rows, hidden), kind) for _ in range(3))
    for t in range(width) if direction == 0 else range(width - 1, -1, -1):
        if keep is not None:
            gate, forget, new = (np.empty((rows, hidden), kind) for _ in range(3))
        ids_t = columns[t]
        np.matmul(state, inner[0], out=gate)
        gate += parts[0].take(ids_t, axis=0)
        _sigmoid(gate)
        np.matmul(state, inner[1], out=forget)
        forget += parts[1].take(ids_t, axis=0)
        _sigmoid(forget)
        past = np.matmul(state, inner[2])
        np.multiply(gate, past, out=new)
        new += parts[2].take(ids_t, axis=0)
        np.tanh(new, out=new)
        if keep is not None:
            keep.append((t, state, gate, forget, past, new))
        np.subtract(state, new, out=out[t])
        out[t] *= forget
        out[t] += new
        state = out[t]
    return out


def probabilities(net: Network, ids: np.ndarray) -> np.ndarray:
    """Label probabilities at each byte, (window, rows, labels)."""
    hidden = net.inner.shape[2]
    logits = states(net, 0, ids) @ net.out[:hidden]
    logits += states(net, 1, ids) @ net.out[hidden:]
    logits += net.bias
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=2, keepdims=True)
    return logits


def gradients(net: Network, ids: np.ndarray, known: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over the known bytes (rows, window) of windows with these labels, and its gradients."""
    hidden = net.inner.shape[2]
    kept: list[list] = [[], []]
    both = [states(net, d, ids, kept[d]) for d in (0, 1)]
    joined = np.concatenate(both, axis=2)
    logits = joined @ net.out + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    weight = (known.T / max(1, known.sum())).astype(net.table.dtype)
    rows = np.arange(len(label))
    loss = float(-(np.log(np.maximum(p[:, rows, label], 1e-12)) * weight).sum())
    p[:, rows, label] -= 1
    p *= weight[:, :, None]
    flat = p.reshape(-1, p.shape[2])
    g_out, g_bias = joined.reshape(-1, 2 * hidden).T @ flat, flat.sum(axis=0)
    g_joined = p @ net.out.T
    g_table, g_inner = np.zeros_like(net.table), np.zeros_like(net.inner)
    for d in (0, 1):
        back = np.zeros((len(label), hidden), net.table.dtype)
        for t, state, gate, forget, past, new in reversed(kept[d]):
            g = g_joined[t, :, d * hidden : (d + 1) * hidden] + back
            g_new = g * (1 - forget) * (1 - new * new)
            g_forget = g * (state - new) * forget * (1 - forget)
            g_gate = g_new * past * gate * (1 - gate)
            g_past = g_new * gate
            back = g * forget + g_gate @ net.inner[d, 0].T + g_forget @ net.inner[d, 1].T + g_past @ net.inner[d, 2].T
            for k, x in enumerate((g_gate, g_forget, g_past)):
                g_inner[d, k] += state.T @ x
            np.add.at(g_table[d], ids[:, t], np.stack([g_gate, g_forget, g_new], axis=1))
    return loss, [g_table, g_inner, g_out, g_bias]


def windows(raw: bytes, width: int = WINDOW) -> np.ndarray:
    """The bytes in rows of ``width``, the last one filled up with zeros."""
    out = np.zeros(max(1, -(-len(raw) // width)) * width, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(-1, width)


def train(samples: list[tuple[str, str]], hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 7) -> Network | None:
    """A network from (text, label) pairs; None without any."""
    samples = [(text.encode(), label) for text, label in samples if text]
    if not samples:
        return None
    rng = np.random.default_rng(seed)
    labels = sorted({label for _, label in samples})
    ids, known, target = [], [], []
    for raw, label in samples:
        rows = windows(raw)
        for k in rng.permutation(len(rows))[:SAMPLE_WINDOWS]:
            ids.append(rows[k])
            known.append(np.arange(WINDOW) < len(raw) - k * WINDOW)
            target.append(labels.index(label))
    ids, known, target = np.array(ids), np.array(known), np.array(target)
    scale = 1 / np.sqrt(hidden)
    net = Network(rng.normal(0, 0.3, (2, 256, 3, hidden)).astype(np.float32), rng.normal(0, scale, (2, 3, hidden, hidden)).astype(np.float32),
                  rng.normal(0, scale, (2 * hidden, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32), labels)
    weights = [net.table, net.inner, net.out, net.bias]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    steps = epochs * -(-len(ids) // STEP_WINDOWS)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for lo in range(0, len(order), STEP_WINDOWS):
            part = order[lo : lo + STEP_WINDOWS]
            _, grads = gradients(net, ids[part], known[part], target[part])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            step += 1
            rate = RATE * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for w, (m, v), g in zip(weights, moments, grads):
                g = g * min(1.0, 1.0 / max(norm, 1e-12))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def pooled(net: Network, raws: list[bytes]) -> np.ndarray:
    """The mean label probabilities over all bytes of each text, (texts, labels); texts aren't empty."""
    rows = [windows(raw) for raw in raws]
    sizes = np.array([len(r) for r in rows])
    ids = np.concatenate(rows)
    owner = np.repeat(np.arange(len(raws)), sizes)
    left = np.array([len(raw) for raw in raws])[owner] - WINDOW * (np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    sums = np.empty((len(ids), len(net.labels)), np.float32)
    for lo in range(0, len(ids), BATCH_WINDOWS):
        p = probabilities(net, ids[lo : lo + BATCH_WINDOWS])
        for k in np.nonzero(left[lo : lo + BATCH_WINDOWS] < WINDOW)[0]:
            p[left[lo + k] :, k] = 0
        sums[lo : lo + BATCH_WINDOWS] = p.sum(axis=0)
    out = np.add.reduceat(sums.astype(np.float64), np.cumsum(sizes) - sizes, axis=0)
    return out / out.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, most: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """(excerpt, lang) of at most ``most`` documents (doc_id, text, lang) that training may use."""
    usable = docs.where("lang IS NOT NULL AND length(text) > 0").where(~held_out())
    chosen, langs = evenly_by_label(usable.select("doc_id", "text", "lang"), "lang", most, 7, "doc_id", "text")
    return excerpts(chosen, "lang", langs, most, SAMPLE_CHARS, 7)


def identify(docs: DataFrame, net: Network | None, carried: list[str]) -> DataFrame:
    """``carried`` columns of each row, lang_pred and score (the pooled probability of lang_pred)."""
    columns = [F.col(c).alias(f"kept_{k}") for k, c in enumerate(carried)]
    rows = docs.select(*columns, "text")
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            preds, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            usable = [k for k, t in enumerate(texts) if net is not None and t and any(map(str.isalpha, t))]
            raws = [texts[k].encode() for k in usable]
            for lo, hi in in_slices(map(len, raws), SLICE_BYTES):
                p = pooled(net, raws[lo:hi])
                for k, row in zip(usable[lo:hi], p):
                    best = int(row.argmax())
                    preds[k], scores[k] = net.labels[best], float(min(1.0, row[best]))
            yield record_batch(**{n: batch.column(n) for n in names}, lang_pred=pa.array(preds, pa.string()), score=pa.array(scores, pa.float64()))

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1])
    out = arrow_stage(rows, run, f"{types}, lang_pred string, score double")
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, carried)), "lang_pred", "score")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    net = train(sample(docs))
    return identify(docs, net, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
