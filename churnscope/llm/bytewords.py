"""Words of whole Arrow columns at once, found on their UTF-8 bytes.

Every class of characters used here is made of ASCII characters, or of all but some of them,
so a byte decides by itself: bytes of longer characters are never separators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from churnscope.llm.common import in_slices, trim

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(members: str) -> np.ndarray:
    """True at the bytes of the given ASCII characters."""
    out = np.zeros(256, bool)
    out[list(members.encode("ascii"))] = True
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, end to end, and where each text begins (and the last ends); null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def text_slices(batches: Iterator[pa.RecordBatch], most: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of the batches, regrouped to about ``most`` bytes of text; a longer text stands alone."""
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_pylist()
        for lo, hi in in_slices(sizes, most):
            part = sum(sizes[lo:hi])
            if held and size + part > most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(batch.slice(lo, hi - lo))
            size += part
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    trim()


class Words:
    """The words of consecutive texts.

    ``array``: the words as binary values; ``doc``: the number of each word's text; ``first``,
    ``last``: the byte where it begins and the one after it ends.
    """

    def __init__(self, raw: np.ndarray, at: np.ndarray, member: np.ndarray, lower: bool = False):
        inside = member[raw]
        cut = np.zeros(len(raw) + 1, bool)
        cut[at] = True
        before = np.zeros(len(raw), bool)
        before[1:] = inside[:-1]
        self.first = np.flatnonzero(inside & (cut[:-1] | ~before))
        after = np.zeros(len(raw), bool)
        after[:-1] = inside[1:]
        self.last = np.flatnonzero(inside & (cut[1:] | ~after)) + 1
        self.doc = np.searchsorted(at, self.first, "right") - 1
        data = raw[inside]
        offsets = np.zeros(len(self.first) + 1, np.int64)
        np.cumsum(self.last - self.first, out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data] if lower else data)]
        self.array = pa.Array.from_buffers(pa.large_binary(), len(self.first), buffers)

    def __len__(self) -> int:
        return len(self.first)

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, the same for equal words, and the words by number."""
        coded = self.array.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def first_after(places: np.ndarray, words: Words) -> np.ndarray:
    """For each byte place, the number of the first word that begins at it or later."""
    return np.searchsorted(words.first, places)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the number of each key among them."""
    if len(keys) and int(keys.max()) < 8 * len(keys):
        present = np.zeros(int(keys.max()) + 1, bool)
        present[keys] = True
        return np.flatnonzero(present), (np.cumsum(present) - 1)[keys]
    return np.unique(keys, return_inverse=True)
