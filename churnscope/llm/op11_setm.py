"""Phrase collocations by SETM: occurrence relations, merge-joined, counted and semi-joined.

A-Z are lower-cased, texts are cut at PIECE characters into pieces and those at spaces and
tabs into words.  The documents are dealt into blocks.  The relation of length k holds, for
each block, the phrase of k words that begins at each position, sorted by position; a place
between two pieces is a position of its own, so adjacent positions always are of one piece.
A phrase has a number of its block's own and, where it is frequent, one of the whole table.

Level k merge-joins the relation of k-1 with itself at the next position, counts the phrases
within each block and writes relation and counts as one table bucketed by block.  The counts
are grouped by phrase over all blocks, and the frequent ones written back by block, bucketed
alike: the next level semi-joins them with the relation without a shuffle, and only the
relation's frequent rows are extended.  No part of a frequent phrase is rarer than itself, so
no phrase is lost.

What is shuffled are the distinct phrases of each block, whose parts are frequent, with their
counts.  They travel packed, a row for each block and bucket of phrases; a phrase's hash gives
its bucket.  There are at least as many buckets as blocks, so a task that counts holds one
bucket of about a block's phrases, and a hot phrase is one entry of each block.  The tasks
before hold one block: BLOCK_BYTES of text, or one longer text, which is cut into blocks of
BLOCK positions that overlap by LONGEST - 1.

Everything is by lang, null as "und".  Null and empty texts have no words.  Repeated rows
count as often as they occur.  An empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnscope.llm.bytewords import Words, byte_class, first_after, numbered, text_slices, utf8
from churnscope.llm.common import arrow_stage, by_group, cut, mixed, scratch, table, trim

#: Words of a phrase, at most; its least number of occurrences; share of a phrase's count that a longer one must have to replace it.
LONGEST, LEAST, COVER = 4, 30, (80, 100)
#: Phrases reported of a lang; what the score is multiplied by.
REPORTED, SCALE = 2000, 2_000_000
#: Text of a block in bytes; positions of a block of one longer text; salts of the first ranking.
BLOCK_BYTES, BLOCK, SALTS = 4 << 20, 1 << 20, 16
PIECE = ".,;:!?\n\x0b\x0c\r"
_SEPARATOR = byte_class(PIECE)
_WORD = ~(_SEPARATOR | byte_class(" \t"))

#: A level's rows: of each block one with the relation, and the packed phrases of each lang (level 1) and bucket.
#: A block numbers its phrases by lang and bucket, so those of a row are numbered on from ``first``.
_LEVEL = pa.schema([("block", pa.int64()), ("own", pa.int32()), ("relation", pa.binary()), ("bucket", pa.int32()),
                    ("first", pa.int32()), ("lang", pa.string()), ("n", pa.int64()), ("packed", pa.binary())])
#: Counted rows: of each block its frequent phrases (packed), and each frequent phrase itself.
_COUNTED = "block long, packed binary, gid long, lang string, word string, before long, after long, f long"

#: Spark's setting that shuffle files go when their query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


# -- packed phrases ------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, the first bytes of all numbers before the second ones and so on, compressed."""
    raw = b"".join(a.view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _raw(packed: bytes) -> bytes:
    return pa.decompress(packed[4:], decompressed_size=int.from_bytes(packed[:4], "little"), codec="zstd", asbytes=True)


def _column(raw: bytes, dtype: str, count: int, at: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(raw, np.uint8, count * size, at).reshape(size, count).T.copy().view(dtype).reshape(count)


def unpack(packed: bytes, *dtypes: str) -> list[np.ndarray]:
    """The arrays of one length and of these dtypes."""
    raw, out, at = _raw(packed), [], 0
    count = len(raw) // sum(np.dtype(d).itemsize for d in dtypes)
    for d in dtypes:
        out.append(_column(raw, d, count, at))
        at += count * np.dtype(d).itemsize
    return out


def pack_words(n: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> bytes:
    """Counts and spellings of words; ``offsets`` say where each word lies in ``data``."""
    return pack(np.array([len(n)], "<i4"), n.astype("<i4"), np.diff(offsets).astype("<i4"), data[offsets[0] : offsets[-1]])


def unpack_words(packed: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """n, lengths of the words, and the words end to end."""
    raw = _raw(packed)
    count = int(_column(raw, "<i4", 1, 0)[0])
    return _column(raw, "<i4", count, 4), _column(raw, "<i4", count, 4 + 4 * count), raw[4 + 8 * count :]


def pack_pairs(n: np.ndarray, before: np.ndarray, after: np.ndarray) -> bytes:
    """Counts and parts of phrases; first parts rise and are held as differences."""
    return pack(np.diff(before, prepend=0).astype("<i8"), after.astype("<i8"), n.astype("<i4"))


def unpack_pairs(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n, before, after."""
    before, after, n = unpack(packed, "<i8", "<i8", "<i4")
    return n, np.cumsum(before), after


def _slices(buckets: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[int, int, int]]]:
    """An order that brings equal buckets together, each in the order it has, and (bucket, begin, end) in it."""
    order = np.argsort(buckets.astype(np.uint16) if len(buckets) and buckets.max() < 1 << 16 else buckets, kind="stable")
    sorted_ = buckets[order]
    cuts = np.flatnonzero(np.diff(sorted_, prepend=-1))
    return order, zip(sorted_[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(order)])


def _numbered_by(order: np.ndarray, relation: np.ndarray) -> bytes:
    """The relation with its phrases numbered by their places in ``order``, packed."""
    place = np.full(len(order) + 1, -1, "<i4")  # the last entry is for -1
    place[order] = np.arange(len(order))
    return pack(place[relation])


# -- relations -----------------------------------------------------------------------------


def positions(raw: np.ndarray, at: np.ndarray, words: Words) -> np.ndarray:
    """The position of each word: one more than the word before, two more at the start of a piece."""
    starts = np.zeros(len(words) + 1, bool)
    starts[first_after(at, words)] = True
    starts[first_after(np.flatnonzero(_SEPARATOR[raw]), words)] = True
    return np.arange(len(words)) + np.cumsum(starts[:-1])


def in_blocks(keys: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, int]]:
    """Parts of a relation and the positions that each counts; the rest of a part only extends phrases."""
    for begin in range(0, len(keys), block):
        part = keys[begin : begin + block + LONGEST - 1]
        yield part, min(block, len(keys) - begin)


def grouped(keys: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a part (keys by position, -1: none): its distinct keys, their counts, and the part with their numbers."""
    rows = np.flatnonzero(keys >= 0)
    distinct, code = numbered(keys[rows])
    relation = np.full(len(keys), -1, np.int32)
    relation[rows] = code
    return distinct, np.bincount(code[rows < own], minlength=len(distinct)), relation


def _level(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LEVEL)], schema=_LEVEL)


def word_relation(docs: DataFrame, buckets: int, block_bytes: int = BLOCK_BYTES, block: int = BLOCK) -> DataFrame:
    """Blocks of the first level: the relation of their words, and these by lang, counted and packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in text_slices(batches, block_bytes):
            raw, at = utf8(batch.column("text"))
            words = Words(raw, at, _WORD, lower=True)
            if not len(words):
                continue
            code, spelling = words.codes()
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, spelling.to_pylist()), np.uint64, len(spelling))
            bucket_of = (hashes % np.uint64(buckets)).astype(np.int64)
            langs = batch.column("lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            lang = langs.indices.to_numpy()[words.doc].astype(np.int64)
            place = positions(raw, at, words)
            keys = np.full(int(place[-1]) + 1, -1, np.int64)
            keys[place] = lang * len(spelling) + code
            for part, own in in_blocks(keys, block):
                distinct, counts, relation = grouped(part, own)
                of_lang, of_word = np.divmod(distinct, len(spelling))
                order, slices = _slices(of_lang * buckets + bucket_of[of_word])
                spelled = spelling.take(pa.array(of_word[order]))
                offsets, data = np.frombuffer(spelled.buffers()[1], np.int64), np.frombuffer(spelled.buffers()[2] or b"", np.uint8)
                rows = [(number, own, _numbered_by(order, relation), None, None, None, None, None)]
                for both, lo, hi in slices:
                    n = counts[order[lo:hi]]
                    rows.append((number, own, None, both % buckets, lo, names[both // buckets], int(n.sum()), pack_words(n, offsets[lo : hi + 1], data)))
                yield _level(rows)
                number += 1

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return arrow_stage(rows, run, _ddl(_LEVEL))


def extended(relation: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Merge-join of a block's relation with itself at the next position, on the frequent rows.

    ``code`` are the block's numbers of the frequent phrases.  Gives the joined rows by position
    as first * len(code) + second, in places of ``code`` (-1: none).
    """
    frequent = np.full(max(int(relation.max(initial=-1)), int(code.max(initial=-1))) + 2, -1, np.int64)  # the last entry is for -1
    frequent[code] = np.arange(len(code))
    now = frequent[relation]
    after = np.append(now[1:], -1)
    return np.where((now >= 0) & (after >= 0), now * max(1, len(code)) + after, -1)


def next_relation(blocks: DataFrame, counted: DataFrame, buckets: int, persist: bool) -> DataFrame:
    """Blocks of the next level; the relation itself only if it will be extended again."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], schema=_LEVEL)
        block, own = left["block"][0].as_py(), left["own"][0].as_py()
        parts = [unpack(x, "<i8", "<i4") for x in right["packed"].to_pylist()]
        gid, code = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(gid)  # so that equal first parts of a phrase come together, with rising numbers
        gid, code = gid[order], code[order]
        keys = extended(unpack(left["relation"][0].as_py(), "<i4")[0], code)
        distinct, counts, relation = grouped(keys, own)
        first, second = np.divmod(distinct, len(gid))
        before, after = gid[first], gid[second]
        order, slices = _slices((mixed(mixed(before.astype(np.uint64)) + after.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64))
        rows = [(block, own, _numbered_by(order, relation), None, None, None, None, None)] if persist else []
        for bucket, lo, hi in slices:
            at = order[lo:hi]
            rows.append((block, own, None, bucket, lo, None, None, pack_pairs(counts[at], before[at], after[at])))
        out = pa.Table.from_batches([_level(rows)] if rows else [], schema=_LEVEL)
        trim()
        return out

    left = blocks.where(F.col("relation").isNotNull()).select("block", "own", "relation")
    right = counted.where(F.col("packed").isNotNull()).select("block", "packed")
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, _ddl(_LEVEL))


# -- counts over all blocks ----------------------------------------------------------------


def _counter(keys_of: Callable[[list[bytes]], tuple], least: int) -> Callable[[dict], dict | None]:
    """The function that counts one bucket.

    ``keys_of`` unpacks its rows: (n, keys as an Arrow array, row of each entry, and the columns
    of the keys that are wanted).
    """
    given = [0]  # numbers that this task has given; a task writes one part, so they are unique with its partition

    def count(rows: dict) -> dict | None:
        out: dict[str, list] = {name.split(" ")[0]: [] for name in _COUNTED.split(", ")}
        for lang in sorted({*rows["lang"]}, key=str):  # one, None, beyond level 1
            mine = [k for k, x in enumerate(rows["lang"]) if x == lang]
            n, keys, row, columns = keys_of([rows["packed"][k] for k in mine])
            coded = keys.dictionary_encode()
            place = coded.indices.to_numpy(zero_copy_only=False)
            total = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(total, place, n)
            chosen = np.flatnonzero(total >= least)
            gid = np.full(len(total), -1, np.int64)
            gid[chosen] = (TaskContext.get().partitionId() << 40) + given[0] + np.arange(len(chosen))
            given[0] += len(chosen)
            own = gid[place]
            for k, part in zip(mine, np.split(own, np.searchsorted(row, np.arange(1, len(mine))))):
                at = np.flatnonzero(part >= 0)
                if len(at):
                    _append(out, block=rows["block"][k], packed=pack(part[at].astype("<i8"), (rows["first"][k] + at).astype("<i4")))
            for g, f, key in zip(gid[chosen].tolist(), total[chosen].tolist(), columns(coded.dictionary.take(pa.array(chosen)))):
                _append(out, block=g, gid=g, lang=lang, f=f, **key)
        types = {"packed": pa.binary(), "lang": pa.string(), "word": pa.string()}
        return {name: pa.array(c, types.get(name, pa.int64())) for name, c in out.items()} if out["block"] else None

    return count


def _append(out: dict[str, list], **row) -> None:
    for name, column in out.items():
        column.append(row.get(name))


def _words_of(packed: list[bytes]) -> tuple:
    n, lengths, data = zip(*map(unpack_words, packed))
    row = np.repeat(np.arange(len(n)), list(map(len, n)))
    offsets = np.append(0, np.cumsum(np.concatenate(lengths), dtype=np.int64))
    keys = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(data))])
    return np.concatenate(n), keys, row, lambda chosen: [{"word": w.decode()} for w in chosen.to_pylist()]


def _pairs_of(packed: list[bytes]) -> tuple:
    n, before, after = zip(*map(unpack_pairs, packed))
    row = np.repeat(np.arange(len(n)), list(map(len, n)))
    both = np.stack([np.concatenate(before), np.concatenate(after)], axis=1)
    keys = pa.Array.from_buffers(pa.binary(16), len(row), [None, pa.py_buffer(both.tobytes())])

    def columns(chosen: pa.Array) -> list[dict]:
        return [{"before": int.from_bytes(k[:8], "little", signed=True), "after": int.from_bytes(k[8:], "little", signed=True)} for k in chosen.to_pylist()]

    return np.concatenate(n), keys, row, columns


def counted_phrases(blocks: DataFrame, first: bool, least: int) -> DataFrame:
    """The frequent phrases (gid, f and their parts), and those of each block, packed."""
    rows = blocks.where(F.col("packed").isNotNull()).select("bucket", "block", "first", "lang", "packed")
    return by_group(rows, ["bucket"], ["block"], _counter(_words_of if first else _pairs_of, least), _COUNTED)


class Relations:
    """Tables bucketed by block in a shared folder; ``close()`` drops those that are left.

    Until then Spark deletes the shuffle files of each query of the session when it ends, as what a
    level needs of the one before is written by then.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, scratch(spark, "phrases")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.names: list[str] = []
        self.cleanup = spark.conf.get(_CLEANUP)
        spark.conf.set(_CLEANUP, "true")

    def write(self, df: DataFrame, dealt: bool) -> DataFrame:
        """``df`` as a table; ``dealt``: rows of a block lie in many tasks and are brought together first."""
        name = f"phrases_{uuid.uuid4().hex}"
        df = df.repartition(self.buckets, "block") if dealt else df
        self.names.append(name)
        (df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1").option("path", f"{self.folder}/{name}")
         .bucketBy(self.buckets, "block").sortBy("block").saveAsTable(name))
        return self.spark.table(name)

    def drop_all_but(self, last: int) -> None:
        """Drop all tables, with their files, but the ``last`` ones written."""
        path_of = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        while len(self.names) > last:
            name = self.names.pop(0)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            path = path_of(f"{self.folder}/{name}")
            path.getFileSystem(conf).delete(path, True)

    def close(self) -> None:
        self.spark.conf.set(_CLEANUP, self.cleanup)
        self.drop_all_but(0)


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES,
                  block: int = BLOCK) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n): words of each lang; and for each length its frequent phrases.

    Those have gid, lang, phrase, last (its last word), f, before and after (gids of the
    phrase without its last and without its first word), heads and tails (f of its first 1,
    2, ... words and of its last 1, 2, ... words).
    """
    if longest > LONGEST:
        raise ValueError(f"blocks overlap for phrases of at most {LONGEST} words")
    spark = docs.sparkSession
    tables = Relations(spark)
    try:
        buckets = max(tables.buckets, 4 * docs.rdd.getNumPartitions())
        blocks = tables.write(word_relation(docs, buckets, block_bytes, block), dealt=False)
        totals = cut(blocks.where(F.col("packed").isNotNull()).groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
        counted = tables.write(counted_phrases(blocks, True, least), dealt=True)
        nothing, one = F.lit(None).cast("long"), counted.where(F.col("gid").isNotNull())
        levels = [one.select("gid", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", nothing.alias("before"),
                             nothing.alias("after"), F.array("f").alias("heads"), F.array("f").alias("tails"))]
        levels = [cut(levels[0], "phrases")]
        buckets = max(tables.buckets, blocks.where(F.col("relation").isNotNull()).count())
        for k in range(2, longest + 1):
            blocks = tables.write(next_relation(blocks, counted, buckets, persist=k < longest), dealt=False)
            tables.drop_all_but(1)
            counted = counted_phrases(blocks, False, least)
            counted = tables.write(counted, dealt=True) if k < longest else cut(counted, "phrases-last")
            own = counted.where(F.col("gid").isNotNull()).select("gid", "before", "after", "f")
            head = levels[-1].select(F.col("gid").alias("before"), "lang", F.col("phrase").alias("head"), "heads")
            tail = levels[-1].select(F.col("gid").alias("after"), "last", "tails")
            both = own.join(head, "before").join(tail, "after")
            levels.append(cut(both.select("gid", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f", "before", "after",
                                          F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails")), "phrases"))
    finally:
        tables.close()
    return totals, levels


def lowest_cut(k: int) -> Column:
    """(score, k, l, r) of the lowest-scoring cut of a phrase of ``k`` words; ties go to the smallest k."""
    cuts = []
    for c in range(1, k):
        l, r = F.col("heads")[c - 1], F.col("tails")[k - c - 1]
        score = F.expr(f"(CAST({SCALE} AS DECIMAL(38,0)) * f) div CAST(heads[{c - 1}] + tails[{k - c - 1}] AS DECIMAL(38,0))")
        cuts.append(F.struct(score.cast("long").alias("score"), F.lit(c).alias("k"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, least: int = LEAST, reported: int = REPORTED, **blocks) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each lang's first ``reported`` phrases.

    A phrase goes if its words lie within a longer frequent one with at least COVER of its
    count; as a part is never rarer, it's enough to look one word further.
    """
    totals, levels = phrase_counts(docs, least, **blocks)
    kept = []
    for k, level in enumerate(levels[1:], 2):
        if k < len(levels):
            longer = levels[k]
            around = longer.select(F.col("before").alias("gid"), "f").unionByName(longer.select(F.col("after").alias("gid"), "f"))
            around = around.groupBy("gid").agg(F.max("f").alias("longer"))
            level = level.join(around, "gid", "left").where(F.expr(f"longer IS NULL OR CAST({COVER[1]} AS DECIMAL(38,0)) * longer < CAST({COVER[0]} AS DECIMAL(38,0)) * f"))
        kept.append(level.withColumn("cut", lowest_cut(k)).select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"))
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.unionByName(more)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= reported)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= reported)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_setm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each lang's best collocations over all documents."""
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


OP11_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), sequences AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM sequences GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM sequences
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM starts, range(1, 5) t(k) WHERE i + k - 1 <= len(w)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), parts AS (
  SELECT lang, k, phrase, f, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k >= 2)
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, c.cut, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.f // (l.f + r.f) AS BIGINT) AS score
  FROM parts c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.tail
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + short - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS short FROM f WHERE k >= 3), range(1, 4) t(i)
  WHERE i + short - 1 <= k GROUP BY ALL
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN inside x USING (lang, phrase) WHERE x.longer IS NULL OR 100 * x.longer < 80 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000
"""
