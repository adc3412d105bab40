"""BPE merges by segment trees, and texts as sequences of repeated chunks.

The bytes of a piece are the leaves of a tree that keeps the leftmost minimum rank of an
adjacent pair.  A merge reads the root, joins two neighbours and updates the leaves of the
pairs it touched, each in logarithmic time.  Trees of many short pieces are worked on
together in numpy; a long piece has a tree of its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np

#: Longer pieces (bytes) get a tree of their own; chunks, and pieces, that are kept as encoded.
LONG_PIECE, CACHED = 128, 500_000
NONE = np.int32(2**31 - 1)
#: In strings of these characters only, the letters are A-Z, a-z and LATIN and the digits 0-9;
#: the standard library's faster expressions then split them as Unicode classes do.
LATIN = "À-ÖØ-öø-ƿ"
LETTERS = "A-Za-z" + LATIN
UNUSUAL = re.compile(f"[^\\x00-\\x1b\\x20-\\x7e{LATIN}]")
#: White space beyond a space, tab and line ends.
ODD_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_RNG = np.random.default_rng(20)
_CODES, _ODD = _RNG.integers(0, 1 << 63, 256, np.uint64), np.uint64(1)


def plain_pattern(pattern: str) -> re.Pattern:
    """The pattern's meaning for strings without UNUSUAL characters."""
    pattern = pattern.replace(r"\p{L}+", f"[{LETTERS}]+").replace(r"\p{N}+", "[0-9]+")
    return re.compile(pattern.replace(r"\p{L}", LETTERS).replace(r"\p{N}", "0-9"))


class MergeTrees:
    """Merges of pairs of tokens in the order of their ranks."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], byte_id: Iterable[int], last_byte_id: Iterable[int] | None = None):
        """pairs: (left, right) → (rank, token); byte_id: the token of each byte, of a piece's last byte if it differs."""
        self.byte_id = np.array(list(byte_id), np.int32)
        self.last_byte_id = self.byte_id if last_byte_id is None else np.array(list(last_byte_id), np.int32)
        self.rank_of = {(left << 20) | right: rank for (left, right), (rank, _) in pairs.items()}
        self.token_of = np.zeros(max((r for r, _ in pairs.values()), default=0) + 1, np.int32)
        for rank, token in pairs.values():
            self.token_of[rank] = token
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        for key, slot in zip(self.rank_of, self._slot(np.array(list(self.rank_of), np.int64)).tolist()):
            while self.keys[slot] != -1:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.ranks[slot] = key, self.rank_of[key]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE if they don't merge: open addressing with linear probes."""
        key = (left.astype(np.int64) << 20) | right
        slot = self._slot(key)
        out, at = self.ranks.take(slot), self.keys.take(slot)
        open_ = np.nonzero((at != key) & (at != -1))[0]
        out[at != key] = NONE
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            at = self.keys.take(slot[open_])
            hit = at == key[open_]
            out[open_[hit]] = self.ranks.take(slot[open_[hit]])
            open_ = open_[~hit & (at != -1)]
        return out

    def short(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids (int32, as bytes) of pieces of 1 to ``width`` (a power of two) bytes, one tree per row.

        A leaf holds rank * width + position, so a tree's root is the leftmost minimum.
        The arrays are flat; cell ``row * width + position`` has leaf ``row * 2 * width + width + position``.
        """
        n, lengths = len(pieces), np.fromiter(map(len, pieces), np.int32, len(pieces))
        cell = np.arange(width, dtype=np.int32)
        live = cell < lengths[:, None]
        token = np.zeros((n, width), np.int32)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        token[live] = self.byte_id[raw]
        token[np.arange(n), lengths - 1] = self.last_byte_id[raw[np.cumsum(lengths) - 1]]
        following = np.where(cell + 1 < lengths[:, None], cell + 1, -1).ravel()
        before = np.tile(cell - 1, n)
        tree = np.full((n, 2 * width), NONE, np.int32)
        row, left = np.nonzero(following.reshape(n, width) >= 0)
        rank = self._rank(token[row, left], token[row, left + 1])
        tree[row, width + left] = np.where(rank == NONE, NONE, rank * width + left)
        level = width
        while level > 1:
            half = level // 2
            np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2], out=tree[:, half:level])
            level = half
        rows = np.nonzero(tree[:, 1] != NONE)[0]
        tree, token, alive, levels = tree.ravel(), token.ravel(), live.ravel().copy(), width.bit_length() - 1

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            root, node = rows * (2 * width), at + width
            tree[root + node] = value
            for _ in range(levels):
                node = node >> 1
                children = root + 2 * node
                tree[root + node] = np.minimum(tree.take(children), tree.take(children + 1))

        while len(rows):
            rank, at = np.divmod(tree.take(rows * (2 * width) + 1), width)
            joined = self.token_of.take(rank)
            base = rows * width
            cells = base + at
            gone = following.take(cells)
            after = following.take(base + gone)
            token[cells], following[cells], alive[base + gone] = joined, after, False
            has = np.nonzero(after >= 0)[0]
            value = np.full(len(rows), NONE, np.int32)
            new = self._rank(joined[has], token.take(base[has] + after[has]))
            value[has] = np.where(new == NONE, NONE, new * width + at[has])
            before[base[has] + after[has]] = at[has]
            tree[rows * (2 * width) + width + gone] = NONE
            put(rows, at, value)
            apart = np.nonzero((gone ^ at) > 1)[0]  # the removed leaf has another parent than the merged one
            put(rows[apart], gone[apart], NONE)
            prior = before.take(cells)
            has = np.nonzero(prior >= 0)[0]
            prior = prior[has]
            new = self._rank(token.take(base[has] + prior), joined[has])
            put(rows[has], prior, np.where(new == NONE, NONE, new * width + prior))
            rows = rows[tree.take(rows * (2 * width) + 1) != NONE]
        ids = token[alive].tobytes()
        ends = (4 * np.cumsum(alive.reshape(n, width).sum(axis=1))).tolist()
        return [ids[lo:hi] for lo, hi in zip([0, *ends], ends)]

    def long(self, piece: bytes) -> bytes:
        """Ids (int32, as bytes) of one piece, with a tree in lists."""
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        none = (1 << 62, n)
        token = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        token[-1] = int(self.last_byte_id[piece[-1]])
        token_of = self.token_of.tolist()
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def leaf(i: int) -> tuple[int, int]:
            j = following[i]
            rank = self.rank_of.get((token[i] << 20) | token[j]) if j < n else None
            return none if rank is None else (rank, i)

        tree = [none] * width + [leaf(i) for i in range(n)] + [none] * (width - n)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            node = i + width
            tree[node] = value
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1] != none:
            rank, i = tree[1]
            gone = following[i]
            token[i], following[i] = token_of[rank], following[gone]
            if following[i] < n:
                before[following[i]] = i
            put(gone, none)
            put(i, leaf(i))
            if before[i] >= 0:
                put(before[i], leaf(before[i]))
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = following[i]
        return np.array(out, np.int32).tobytes()

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (int32, as bytes) of each piece; pieces aren't empty."""
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if len(piece) > LONG_PIECE:
                out[k] = self.long(piece)
            else:
                by_width.setdefault((len(piece) - 1).bit_length(), []).append(k)
        for bits, group in by_width.items():
            most = max(1, (1 << 17) >> bits)  # trees of about 1 MB at once
            for lo in range(0, len(group), most):
                part = group[lo : lo + most]
                for k, ids in zip(part, self.short([pieces[k] for k in part], 1 << bits)):
                    out[k] = ids
        return out


# -- chunks of texts -------------------------------------------------------------------


def distinct_chunks(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct chunks, the chunk at each place of all texts, and where each text's places end.

    A chunk begins at a text's start and at each single space between other characters, so
    patterns that keep a space with what follows, or drop it, split chunk by chunk.  Texts with
    other white space than spaces, tabs and line ends are one chunk.  Chunks are grouped by a
    64-bit hash and then compared byte by byte.  The texts must be under 2 GB together.
    """
    raws = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    data = np.frombuffer(b"".join(raws), np.uint8)
    text_ends = np.cumsum(sizes)
    begins = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        space = _SPACES[data]
        begins[1 : len(data) - 1] = (data[1:-1] == 32) & ~space[:-2] & ~space[2:]
    if ODD_SPACE.search("".join(texts)):
        for t, lo, hi in zip(texts, (text_ends - sizes).tolist(), text_ends.tolist()):
            if ODD_SPACE.search(t):
                begins[lo:hi] = False
    begins[(text_ends - sizes)] = True
    begins[-1] = False
    starts = np.nonzero(begins)[0]
    ends = np.append(starts[1:], len(data))
    if not len(starts):
        return [], starts, np.zeros(len(texts), np.int64)
    lengths = ends - starts
    at = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    factor = np.random.default_rng(21).integers(0, 1 << 63, int(lengths.max()) + 1, np.uint64) << _ODD | _ODD
    hashed = factor.take(at)
    hashed *= _CODES.take(data)
    hashed = np.add.reduceat(hashed, starts) ^ (lengths.astype(np.uint64) << np.uint64(40))
    _, where, inverse = np.unique(hashed, return_index=True, return_inverse=True)
    like = starts[where]
    at += np.repeat(like[inverse].astype(np.int32), lengths)
    whole = data.tobytes()
    if (lengths[where][inverse] == lengths).all() and (data.take(at, mode="clip") == data).all():
        chunks = [whole[lo:hi] for lo, hi in zip(like.tolist(), ends[where].tolist())]
    else:  # two chunks of one hash: tell them apart by themselves
        number: dict[bytes, int] = {}
        inverse = np.array([number.setdefault(whole[lo:hi], len(number)) for lo, hi in zip(starts.tolist(), ends.tolist())])
        chunks = list(number)
    return chunks, inverse, np.searchsorted(starts, text_ends)


def encode_texts(texts: list[str], ids_of: Callable[[list[bytes]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids (int32) of the texts one after the other, and where each text's ids end.

    ``ids_of`` gives the ids of chunks as bytes.
    """
    chunks, places, place_ends = distinct_chunks(texts)
    if not chunks:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    ids = ids_of(chunks)
    flat = np.frombuffer(b"".join(ids), np.int32)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.cumsum(sizes) - sizes
    size = sizes.take(places)
    ends = np.cumsum(size)
    out = flat.take(np.repeat(starts.take(places) - ends + size, size) + np.arange(ends[-1]))
    return out, np.append(0, ends).take(place_ends)


class PieceCache:
    """Ids of chunks, piece by piece; chunks and pieces are encoded once while they are kept.

    ``split`` gives the pieces of usual chunks.  Chunks with UNUSUAL characters go to ``unusual``,
    which gives their pieces or, in place of the list, their ids.
    """

    def __init__(self, split: Callable[[str], list[str]], unusual: Callable[[str], list[str] | bytes], encode: Callable[[list[str]], list[bytes]]):
        self.split, self.unusual, self.encode = split, unusual, encode
        self.chunks: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def ids_of(self, chunks: list[bytes]) -> list[bytes]:
        if len(self.chunks) + len(chunks) > CACHED:
            self.chunks.clear()
        known = self.chunks
        got = list(map(known.get, chunks))
        new = [c for c, ids in zip(chunks, got) if ids is None]
        text = [c.decode() for c in new]
        if UNUSUAL.search("".join(text)):
            split = [self.unusual(t) if UNUSUAL.search(t) else self.split(t) for t in text]
        else:
            split = list(map(self.split, text))
        seen = set().union(*(p for p in split if p.__class__ is list))
        if len(self.pieces) + len(seen) > CACHED:
            self.pieces.clear()
        fresh = list(seen - self.pieces.keys())
        self.pieces.update(zip(fresh, self.encode(fresh)))
        get = self.pieces.__getitem__
        known.update(zip(new, [p if p.__class__ is bytes else b"".join(map(get, p)) for p in split]))
        return [known[c] if ids is None else ids for c, ids in zip(chunks, got)]
