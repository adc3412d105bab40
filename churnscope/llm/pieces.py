"""Pieces of many texts at once, by classes of their UTF-8 bytes.

Splits as the pattern  's|'t|'re|'ve|'m|'ll|'d|LETTERS+|DIGIT|OTHERS+  does, with white space
dropped and lower-cased.  Letters are A-Z, a-z and the two-byte letters of LATIN whose lower
case is one of them; a run between white space that holds anything else beyond ASCII, or a
control character from 0x1c on, is one piece that is marked and left as it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE, LETTER, DIGIT, OTHER, LEAD, ODD = range(6)
_CLASS = np.full(256, ODD, np.uint8)
_CLASS[0x00:0x1C] = _CLASS[0x20:0x7F] = OTHER
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Two-byte letters begin with these bytes (U+00C0 to U+01BF).
_LEADS = range(0xC3, 0xC7)
_CLASS[list(_LEADS)] = LEAD


def _two_byte_letters() -> tuple[np.ndarray, np.ndarray]:
    """By (lead, second byte): whether it's a letter that is kept, and the bytes of its lower case."""
    kept, lower = np.zeros(256, bool), np.zeros((256, 2), np.uint8)
    for k in range(256):
        c = chr(0xC0 + k)
        low = c.lower()
        if c.isalpha() and len(low) == 1 and 0xC0 <= ord(low) < 0x1C0:
            kept[k] = True
            lower[k] = list(low.encode())
    return kept, lower


_KEPT, _LOW = _two_byte_letters()


def _shifted(mask: np.ndarray) -> np.ndarray:
    """The mask one place later."""
    out = np.zeros_like(mask)
    out[1:] = mask[:-1]
    return out


def pieces_of(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The pieces of all texts (binary), which are marked, and where each text's pieces end."""
    raws = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join([*raws, b""]), np.uint8)
    text_ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
    kind, low = _CLASS[data], _LOWER[data]
    lead = np.flatnonzero(kind == LEAD)
    if len(lead):
        code = (data[lead].astype(np.int64) - _LEADS[0]) * 64 + data[lead + 1] - 0x80
        good = lead[_KEPT[code]]
        low[good], low[good + 1] = _LOW[code[_KEPT[code]]].T
        kind[lead] = ODD
        kind[good] = kind[good + 1] = LETTER
    filled = kind != SPACE
    begins = filled & ((kind != np.concatenate([[SPACE], kind[:-1]])) | (kind == DIGIT))
    _join_contractions(data, low, kind, begins)
    odd = np.flatnonzero(kind == ODD)
    marked_at = np.zeros(0, np.int64)
    if len(odd):
        run_begin = np.flatnonzero(filled & ~_shifted(filled))
        run_end = np.flatnonzero(_shifted(filled) & ~filled)
        runs = np.unique(np.searchsorted(run_begin, odd, "right") - 1)
        marked_at = run_begin[runs]
        depth = np.zeros(len(data) + 1, np.int8)
        depth[marked_at] = 1
        depth[run_end[runs]] = -1
        inside = np.cumsum(depth[:-1], dtype=np.int8).astype(bool)
        begins[inside] = False
        begins[marked_at] = True
        low[inside] = data[inside]
    at = np.flatnonzero(begins)
    marked = np.zeros(len(at), bool)
    marked[np.searchsorted(at, marked_at)] = True
    offsets = np.empty(len(at) + 1, np.int64)
    offsets[:-1] = np.cumsum(filled, dtype=np.int64)[at] - 1
    offsets[-1] = np.count_nonzero(filled)
    array = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(low[filled])])
    return array, marked, np.searchsorted(at, text_ends)


def _join_contractions(data: np.ndarray, low: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> None:
    """An apostrophe that begins a piece takes the s, t, m, d, re, ve or ll after it."""
    mark = np.flatnonzero((data == 0x27) & begins)
    mark = mark[(mark + 2 < len(data)) & (kind[np.minimum(mark + 1, len(data) - 1)] == LETTER)]
    if not len(mark):
        return
    a, b = low[mark + 1], low[mark + 2]
    ahead = lambda first, second: (a == ord(first)) & (b == ord(second))
    one = np.isin(a, list(b"stmd"))
    two = ahead("r", "e") | ahead("v", "e") | ahead("l", "l")
    length = np.where(one, 1, np.where(two, 2, 0))
    mark, length = mark[length > 0], length[length > 0]
    begins[mark + 1] = False
    rest = mark + 1 + length
    begins[rest[kind[rest] == LETTER]] = True
