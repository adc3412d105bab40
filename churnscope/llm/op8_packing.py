"""Packing of documents into sequences of a fixed capacity.

Documents are tokenized once and dealt into randomised groups.  Each group is packed on its
own: whole sequences are cut off a document's front, the rests are placed first-fit
decreasing with a tournament tree of bin capacities (its root tells whether any open bin
has room, a descent finds the leftmost one).  Then the emptiest bins are taken apart to
fill the gaps of the others, and what is left makes sequences whose lengths are powers of
two, which need no padding.

Null texts count as empty.  Each row is one document, also where ids or texts repeat; a
null id is kept.  An empty table gives no pieces.  Other columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm.common import arrow_stage, in_slices, kept_in_process, record_batch, table, texts_of
from churnscope.llm.merges import MergeTrees
from churnscope.llm.pieces import pieces_of

#: Tokens of a sequence, documents of a group on average, tokens and documents that one task packs at once.
CAPACITY, GROUP_DOCS, GROUP_TOKENS, GROUP_ROWS = 4096, 1024, 1 << 24, 1 << 15
#: Characters that are tokenized at once; pieces of either generation of the cache.
SLICE_CHARS, CACHED = 2_000_000, 250_000

Piece = tuple[int, int, int]  # item, start, length


# -- packing of one group --------------------------------------------------------------


class OpenBins:
    """A tournament tree over the room left in each bin."""

    def __init__(self, bins: int, capacity: int):
        self.width = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.width)

    def first_fit(self, size: int) -> int:
        """Take ``size`` from the leftmost bin that has room for it, and return that bin."""
        room, node = self.room, 1
        while node < self.width:
            node *= 2
            node += room[node] < size
        room[node] -= size
        found = node - self.width
        while node > 1:
            node >>= 1
            room[node] = max(room[2 * node], room[2 * node + 1])
        return found


def first_fit_decreasing(rests: list[Piece], capacity: int) -> list[list[Piece]]:
    """Bins of the given pieces, none of which is longer than ``capacity``."""
    tree, bins = OpenBins(len(rests), capacity), []
    for piece in sorted(rests, key=lambda p: (-p[2], p[0])):
        at = tree.first_fit(piece[2])
        if at == len(bins):
            bins.append([])
        bins[at].append(piece)
    return bins


def _cut(stream: list[Piece], tokens: int) -> list[Piece]:
    """Take ``tokens`` tokens from the end of ``stream`` (a list of pieces), cutting at most one."""
    out = []
    while tokens and stream:
        item, start, length = stream.pop()
        take = min(tokens, length)
        out.append((item, start, take))
        if take < length:
            stream.append((item, start + take, length - take))
        tokens -= take
    return out


def fill_gaps(bins: list[list[Piece]], capacity: int) -> list[list[Piece]]:
    """Take the emptiest bins apart to fill the others; the rest gets power-of-two lengths."""
    full = sorted(bins, key=lambda b: -sum(p[2] for p in b))
    gaps = sum(capacity - sum(p[2] for p in b) for b in full)
    stream: list[Piece] = []
    while gaps > sum(p[2] for p in stream) and full:
        apart = full.pop()
        gaps -= capacity - sum(p[2] for p in apart)
        stream += apart
    out = [b + _cut(stream, capacity - sum(p[2] for p in b)) for b in full]
    while left := sum(p[2] for p in stream):
        out.append(_cut(stream, min(capacity, 1 << (left.bit_length() - 1))))
    return out


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[Piece]]:
    """Sequences of pieces that hold each token of the items of these lengths once."""
    whole = [[(k, at, capacity)] for k, n in enumerate(lengths) for at in range(0, n - capacity + 1, capacity)]
    rests = [(k, n - n % capacity, n % capacity) for k, n in enumerate(lengths) if n % capacity]
    return whole + fill_gaps(first_fit_decreasing(rests, capacity), capacity)


# -- tokens ----------------------------------------------------------------------------


#: The split pattern of the tokenizer's pre-tokenizer, without white space.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}


class WordBPE:
    """Ids of texts by a tokenizer file: byte-level BPE with marked word ends, lower case, no white space.

    Usual pieces are split and merged here; runs with other characters go to the
    ``tokenizers`` library.  Both give the library's ids.  The ids of pieces are kept in two
    generations: when the newer one is full it becomes the older, whose pieces come back as
    they are met.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        model, split = described["model"], described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if described["normalizer"] != _NORMAL or split != _SPLIT or model["ignore_merges"]:
            raise ValueError(f"{path} isn't a tokenizer of the expected kind")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        pairs = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            pairs[vocab[left], vocab[right]] = (rank, vocab[left + right])
        # byte-level symbols: printable Latin-1 characters stand for themselves, other bytes for 256 and up
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        symbols = [chr(b if b in printable else next(others)) for b in range(256)]
        self.trees = MergeTrees(pairs, (vocab[s] for s in symbols), (vocab[s + end] for s in symbols))
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.size = self.tokenizer.get_vocab_size()

    def _by_library(self, run: str) -> bytes:
        return np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, np.int32).tobytes()

    def _ids_of(self, pieces: list[bytes], marked: list[bool]) -> list[bytes]:
        """The ids (int32, as bytes) of distinct pieces."""
        out = list(map(self.newer.get, pieces))
        unknown = [k for k, ids in enumerate(out) if ids is None]
        fresh = []
        for k in unknown:
            out[k] = self.older.get(pieces[k])
            if out[k] is None:
                if marked[k]:
                    out[k] = self._by_library(pieces[k].decode())
                else:
                    fresh.append(k)
        for k, ids in zip(fresh, self.trees.encode([pieces[k] for k in fresh])):
            out[k] = ids
        if len(self.newer) + len(unknown) > CACHED:
            self.newer, self.older = {}, self.newer
        self.newer.update((pieces[k], out[k]) for k in unknown)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text's ids end."""
        pieces, marked, piece_ends = pieces_of(texts)
        coded = pieces.dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False)
        odd = np.zeros(len(coded.dictionary), bool)
        odd[place[marked]] = True
        ids = self._ids_of(coded.dictionary.to_pylist(), odd.tolist())
        flat = np.frombuffer(b"".join(ids), np.int32)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        size = sizes.take(place)
        ends = np.cumsum(size)
        begin = (np.cumsum(sizes) - sizes).take(place)
        out = flat.take(np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0))
        return out, np.append(0, ends).take(piece_ends)


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, part (the group's key), tokens long, ids binary: unsigned ids, ``end_id`` last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_in_process(("word_bpe", tokenizer_path), lambda: WordBPE(tokenizer_path))
        dtype = np.dtype("<u2" if max(words.size, end_id + 1) <= 1 << 16 else "<u4")
        end = np.array([end_id], dtype).tobytes()
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in in_slices(map(len, texts), SLICE_CHARS):
                ids, ends = words.encode(texts[lo:hi])
                raw = ids.astype(dtype).tobytes()
                places = [0, *ends.tolist()]
                kept = batch.slice(lo, hi - lo)
                yield record_batch(doc_id=kept.column("doc_id"), part=kept.column("part"),
                                   tokens=pa.array([b - a + 1 for a, b in zip(places, places[1:])], pa.int64()),
                                   ids=pa.array([raw[dtype.itemsize * a : dtype.itemsize * b] + end for a, b in zip(places, places[1:])], pa.binary()))

    return arrow_stage(docs.select("doc_id", "part", "text"), run, "doc_id long, part long, tokens long, ids binary")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY,
                   group_docs: int = GROUP_DOCS, seed: int = 8) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids binary (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset.

    Groups are dealt by a hash of ``seed`` and the row's number (its partition and its place
    there), which copies and rows without an id don't share.  A group of more than GROUP_TOKENS
    tokens or GROUP_ROWS documents is packed in parts of that size.
    """
    groups = max(1, -(-docs.count() // group_docs))
    part = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(groups))
    dealt = tokenized(docs.select("doc_id", "text", part.alias("part")), tokenizer_path, end_id)
    dealt = dealt.repartition("part").sortWithinPartitions("part", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        part, held, sequence = None, 0, 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal rows, held, sequence
            out: list[tuple] = []
            size = 0
            for bin_ in pack([r[1] for r in rows], capacity):
                offset = 0
                for item, start, length in bin_:
                    doc_id, tokens, ids = rows[item]
                    ids = np.frombuffer(ids, f"<u{len(ids) // tokens}", length, start * (len(ids) // tokens))
                    out.append((doc_id, start, length, ids.astype("<u4").tobytes(), tokens, (part << 32) | sequence, offset))
                    offset += length
                    size += length
                sequence += 1
                if size > 1 << 20:
                    yield as_batch(out)
                    out, size = [], 0
            rows, held = [], 0
            if out:
                yield as_batch(out)

        def as_batch(out: list[tuple]) -> pa.RecordBatch:
            names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
            return record_batch(**{n: pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, zip(*out))})

        for batch in batches:
            for doc_id, of, tokens, ids in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "part", "tokens", "ids"))):
                if rows and (of != part or held + tokens > GROUP_TOKENS or len(rows) >= GROUP_ROWS):
                    yield from packed()
                if of != part:
                    part, sequence = of, 0
                rows.append((doc_id, tokens, ids))
                held += tokens
        if rows:
            yield from packed()

    return arrow_stage(dealt, run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def packed_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's columns of each piece of ``docs``."""
    import public_tokenizers

    pieces = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 4096 tokens."""
    return packed_digest(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
