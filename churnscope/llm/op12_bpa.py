"""Ranked lexical search by the Best Position Algorithm over impact lists.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z are
lower-cased.  One pass over the documents keeps, of each, its number of terms and its
occurrences of the queries' terms, and counts the documents that hold a term; weights and
lengths follow from these counts.

The postings are dealt into shards of POSTINGS entries.  In a shard each term has an impact
list, sorted by falling impact.  A query reads the lists of its terms side by side, a step of
positions at a time; each document met is looked up in all lists (direct access), which gives
its score and its position in each.  The best position of a list is the end of its unbroken
run of seen positions from the top, whether they were seen by reading or by lookup, so it is
never above the last-read one.  No unseen document scores more than the sum of the impacts
at the best positions; a query stops once that sum is strictly below its kth score (equal
scores are ranked by id, so at an equal sum it reads on) or once all lists are read.  The
shards' best are merged in Spark.

Queries are taken in blocks of BLOCK_CHARS characters (a longer one alone), each a pass over
the documents, so what a task and the driver hold of them is bounded.  A document holds at
most one posting of each of a block's terms, so a shard is bounded too.

Each row of queries is a query of its own, each row of documents a document of its own:
repeated rows give repeated results.  A query without a term, null or empty, finds nothing;
a null or empty document has no terms.  Equal scores are ranked by doc_id, those without an
id last.  Empty tables give an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnscope.llm.bytewords import Words, numbered, text_slices, utf8
from churnscope.llm.common import arrow_stage, cut, record_batch, table

#: Documents of an item; characters of a block of queries; bytes of text of a slice; postings of a shard; first step down the lists.
TOP, BLOCK_CHARS, SLICE_BYTES, POSTINGS, STEP = 10, 4_000_000, 16 << 20, 2_000_000, 32
#: Scale of the weights, of a term's share, slope of its occurrences and of the length, share of the length in percent.
WEIGHT, SHARE, SLOPE, LENGTH, PERCENT = 1000, 1_000_000_000, 1000, 8, 75

_TERM = np.ones(256, bool)
_TERM[0x00:0x30] = _TERM[0x3A:0x41] = _TERM[0x5B:0x61] = _TERM[0x7B:0x80] = False


def terms_of(texts: list[str]) -> list[list[bytes]]:
    """The terms of each text, in order."""
    raw, at = utf8(pa.array(texts, pa.string()))
    words = Words(raw, at, _TERM, lower=True)
    found = words.array.to_pylist()
    ends = np.searchsorted(words.doc, np.arange(len(texts) + 1))
    return [found[a:b] for a, b in zip(ends, ends[1:])]


def query_blocks(queries: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """(item_id, text) of the queries, about ``chars`` characters at a time; a query without a text is left out."""
    block, size = [], 0
    for row in queries.select("item_id", "text").where("text IS NOT NULL").toLocalIterator(prefetchPartitions=False):
        if block and size + len(row.text) > chars:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text)
    if block:
        yield block


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n, and where the document holds any of the vocabulary: terms (int32 numbers) and tfs (int64), packed."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of one block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.large_binary())
        for batch in text_slices(batches, SLICE_BYTES):
            raw, at = utf8(batch.column("text"))
            words = Words(raw, at, _TERM, lower=True)
            rows = batch.num_rows
            n = np.bincount(words.doc, minlength=rows)
            code, spelling = words.codes()
            number = pc.index_in(spelling, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            term = number[code]
            held = term >= 0
            keys, tf = _counted(words.doc[held] * max(1, len(known)) + term[held])
            doc, term = keys // max(1, len(known)), (keys % max(1, len(known))).astype(np.int32)
            ends = np.searchsorted(doc, np.arange(rows + 1))
            yield record_batch(doc_id=batch.column("doc_id"), n=pa.array(n),
                               terms=pa.array([term[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                               tfs=pa.array([tf[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()))

    return arrow_stage(docs.select("doc_id", "text"), run, "doc_id long, n long, terms binary, tfs binary")


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, code = numbered(keys)
    return distinct, np.bincount(code, minlength=len(distinct)).astype(np.int64)


def document_counts(posted: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and df of each of the block's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=terms)
        some = np.flatnonzero(df)
        yield record_batch(term=pa.array(some), df=pa.array(df[some]))

    total = posted.agg(F.count_if(F.col("n") > 0).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    df = np.zeros(terms, np.int64)
    for row in arrow_stage(posted.select("terms"), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row.term] = row.df
    return total.N, total.L, df


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """The whole weight of each term."""
    return np.array([math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Shard:
    """The impact lists of some documents.

    A posting is one entry of a term's list; entries lie document by document (for direct
    access) and, by ``order``, list by list with falling impact (for sorted access).
    """

    def __init__(self, lengths: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, terms: int):
        self.doc, self.term, self.impact = doc, term, impact
        self.begin = np.searchsorted(doc, np.arange(len(lengths) + 1))  # postings of each document
        self.order = np.lexsort((doc, -impact, term))
        self.place = np.empty(len(doc), np.int64)  # where each posting lies in the lists
        self.place[self.order] = np.arange(len(doc))
        self.list = np.searchsorted(term[self.order], np.arange(terms + 1))  # where each term's list begins

    def lookup(self, docs: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the documents, and the places of their postings in the query's lists."""
        sizes = self.begin[docs + 1] - self.begin[docs]
        ends = np.cumsum(sizes)
        at = np.repeat(self.begin[docs] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        times = repeats[self.term[at]]
        total = np.append(0, np.cumsum(times * self.impact[at]))
        return total[ends] - total[ends - sizes], self.place[at[times > 0]]

    def best(self, query: dict[int, int], ids: np.ndarray, repeats: np.ndarray, top: int = TOP, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the query's best (term → repeats), best first; and the positions read.

        ``ids`` ranks the documents among equal scores; ``repeats`` is a zeroed array by term,
        left as it was.
        """
        lists = np.array([t for t in sorted(query) if self.list[t + 1] > self.list[t]], np.int64)
        if not len(lists):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for t in lists:
            repeats[t] = query[t]
        begin, end = self.list[lists], self.list[lists + 1]
        best_position, read = begin.copy(), begin.copy()
        seen = np.zeros(len(self.doc), bool)
        met = np.zeros(len(self.begin) - 1, bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while True:
            upto = np.minimum(read + step, end)
            fresh = np.unique(self.doc[self.order[np.concatenate([np.arange(a, b) for a, b in zip(read, upto)])]])
            read = upto
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            score, places = self.lookup(fresh, repeats)
            seen[places] = True
            docs, scores = np.concatenate([docs, fresh]), np.concatenate([scores, score])
            first = np.lexsort((ids[docs], -scores))[:top]
            docs, scores = docs[first], scores[first]
            bound = 0
            for k, (a, b) in enumerate(zip(best_position.tolist(), end.tolist())):
                run = seen[a:b]
                stop = int(run.argmin()) if len(run) else 0
                a = best_position[k] = b if not len(run) or run[stop] else a + stop
                if a < b:  # documents that aren't seen yet lie below the best position
                    bound += query[int(lists[k])] * int(self.impact[self.order[a - 1]])
            if (read == end).all() or (len(docs) == top and bound < scores[-1]):
                break
            step *= 2
        repeats[lists] = 0
        return docs[scores > 0], scores[scores > 0], int((read - begin).sum())


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows of postings regrouped to about ``most`` postings."""
    held, size = [], 0
    for batch in batches:
        counts = [len(t) // 4 for t in batch.column("terms").to_pylist()]
        lo = 0
        for k, count in enumerate(counts):
            if size and size + count > most:
                held.append(batch.slice(lo, k - lo))
                yield pa.Table.from_batches(held)
                held, size, lo = [], 0, k
            size += count
        held.append(batch.slice(lo))
    if size:
        yield pa.Table.from_batches(held)


def shard_best(posted: DataFrame, queries: list[dict[int, int]], documents: int, length: int, weight: np.ndarray,
               top: int = TOP, most: int = POSTINGS) -> DataFrame:
    """query (number), doc_id, score: each shard's best of each query."""
    sent = posted.sparkSession.sparkContext.broadcast((queries, weight))  # of one block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = sent.value
        repeats = np.zeros(len(weight), np.int64)
        for rows in _shards(batches, most):
            packed = rows["terms"].to_pylist()
            sizes = np.array([len(t) // 4 for t in packed])
            term = np.frombuffer(b"".join(packed), np.int32).astype(np.int64)
            tf = np.frombuffer(b"".join(rows["tfs"].to_pylist()), np.int64)
            m = np.array([100 - PERCENT + (PERCENT * n * documents) // length for n in rows["n"].to_pylist()], np.int64)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            impact = weight[term] * ((SHARE * tf) // (SLOPE * tf + LENGTH * m[doc]))
            shard = Shard(sizes, doc, term, impact, len(weight))
            ids = rows["doc_id"].to_numpy() if not rows["doc_id"].null_count else np.array([2**63 - 1 if i is None else i for i in rows["doc_id"].to_pylist()], np.int64)
            for k, query in enumerate(asked):
                docs, scores, _ = shard.best(query, ids, repeats, top)
                yield record_batch(query=pa.array(np.full(len(docs), k)), doc_id=rows["doc_id"].combine_chunks().take(pa.array(docs)), score=pa.array(scores))

    return arrow_stage(posted.where(F.length("terms") > 0), run, "query long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS, most: int = POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each query."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in query_blocks(queries, block_chars):
        found = [Counter(terms) for terms in terms_of([text for _, text in block])]
        vocabulary = sorted(set().union(*found))
        if not vocabulary:
            continue
        number = {t: k for k, t in enumerate(vocabulary)}
        posted = cut(postings(docs, vocabulary), "postings")
        documents, length, df = document_counts(posted, len(vocabulary))
        best = shard_best(posted, [{number[t]: c for t, c in q.items()} for q in found], documents, length, weights(df, documents), top, most)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        items = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], "query long, item_id long")
        out = out.unionByName(ranked.join(items, "query").select("item_id", "rank", "doc_id", "score"))
    return out


def op12_bpa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


OP12_SQL = """
WITH words AS (
  SELECT row, doc_id, unnest(regexp_extract_all(lowered, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents)
), lengths AS (
  SELECT row, doc_id, count(*) AS n FROM words GROUP BY ALL
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM lengths
), asked AS (
  SELECT query, item_id, term, count(*) AS repeats
  FROM (SELECT query, item_id, unnest(regexp_extract_all(lowered, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS query, item_id,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM benchmark))
  GROUP BY ALL
), tfs AS (
  SELECT row, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), impacts AS (
  SELECT t.row, l.doc_id, t.term,
         CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) OVER (PARTITION BY term) + 1 AS DOUBLE))) AS BIGINT)
         * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // len))) AS impact
  FROM tfs t JOIN lengths l ON l.row = t.row, total
), scores AS (
  SELECT query, item_id, row, doc_id, CAST(sum(repeats * impact) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
