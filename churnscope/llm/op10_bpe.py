"""Byte-level BPE encoding and decoding by a table of merge ranks.

Each match of the split pattern is encoded on its own, by a segment tree over its bytes
(``merges.MergeTrees``).  Chunks of text and pieces that repeat are encoded once.

Nulls count as empty texts; an empty text has no ids.  Rows are independent: repeated rows
give repeated results, an empty table an empty result, other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm.common import arrow_stage, in_slices, record_batch, table, texts_of
from churnscope.llm.merges import MergeTrees, PieceCache, encode_texts, plain_pattern

#: Characters of text that are worked on at once.
SLICE_CHARS = 3_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes → rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBPE:
    """Encoder and decoder for a table of ranks and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        pairs = {(ranks[t[:k]], ranks[t[k:]]): (rank, rank) for t, rank in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.trees = MergeTrees(pairs, (ranks[bytes([b])] for b in range(256)))
        self.cache = PieceCache(plain_pattern(pattern).findall, regex.compile(pattern).findall, self._encode_pieces)
        tokens = {rank: token for token, rank in ranks.items()}
        ordered = [tokens.get(rank, b"") for rank in range(max(tokens) + 1)]
        self.token_size = np.fromiter(map(len, ordered), np.int64, len(ordered))
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(ordered), np.uint8)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        raws = [p.encode() for p in pieces]
        out = [None if (whole := self.ranks.get(raw)) is None else np.int32(whole).tobytes() for raw in raws]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(rest, self.trees.encode([raws[k] for k in rest])):
            out[k] = ids
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text's ids end."""
        return encode_texts(texts, self.cache.ids_of)

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes that the ids stand for, and where each id's bytes end."""
        sizes = self.token_size.take(ids)
        ends = np.cumsum(sizes)
        places = np.repeat(self.token_start.take(ids) - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.token_bytes.take(places).tobytes(), ends


def encode_documents(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int>, decoded binary (the bytes of the ids) of each row of ``docs``.

    ``rank_path`` must be readable on the executors, as an installed vocabulary is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE(read_ranks(rank_path), pattern)
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in in_slices(map(len, texts), SLICE_CHARS):
                ids, ends = bpe.encode(texts[lo:hi])
                decoded, byte_ends = bpe.decode(ids)
                places = np.append(0, ends)
                cuts = np.append(0, byte_ends).take(places).tolist()
                yield record_batch(doc_id=batch.column("doc_id").slice(lo, hi - lo),
                                   ids=pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids)),
                                   decoded=pa.array([decoded[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()))

    return arrow_stage(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>, decoded binary")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    import public_tokenizers

    coded = encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                             public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
