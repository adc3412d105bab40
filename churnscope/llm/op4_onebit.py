"""Approximate nearest neighbours by randomly rotated one-bit codes.

Unit vectors are rotated at random (a QR decomposition of a Gaussian matrix); the signs of
the rotated components are packed into bits.  With x' the vector and c its code (+-1/sqrt(D)
in each component), <q, x'> is estimated as <q, c> / <x', c>; the factor <x', c> is kept as
the correction.  The estimate's error is within BOUND * sqrt((1 - <x', c>^2) / (D - 1)) /
<x', c> with high probability, so each code gives a lower and an upper bound of the cosine.
Of a query's candidates in a block only those whose upper bound reaches the k-th best lower
bound are reranked, by the exact cosine of the original vectors in double precision.

Equal vectors are searched as one; of their ids the k + 1 least are kept, as no other can be
among the k nearest (ties go to the smaller id, one may be the query's own).  Vectors that
are null, zero, of another length than most or hold null or non-finite components take no
part, nor do rows without an id.  Repeated rows count once; a query skips all rows of its
own id.  A query without a candidate has no rows.  Other columns are ignored.

Queries meet all codes in blocks: a block of queries with a block of codes is one group of
work, and only its nearest leave it.  Blocks of queries are large, as each has a copy of every
code, and a group takes them in slices, which bound its estimates.  Vectors travel as they are
given, in single precision where the column has that, and a query without code or ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnscope.llm.common import arrow_stage, by_group, cut, record_batch, table

#: Neighbours, error bound in deviations, codes and queries of a block, queries compared at once.
NEAREST, BOUND, CODE_BLOCK, QUERY_BLOCK, SLICE = 5, 3.5, 8192, 16384, 1024


def rotation(dim: int, seed: int = 4) -> np.ndarray:
    """A random rotation of ``dim`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, rotated_by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and corrections <x', c> of unit vectors (rows)."""
    turned = unit @ rotated_by
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def bounds(query: np.ndarray, bits: np.ndarray, correction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of rotated unit queries (rows) with codes (columns), and each code's error bound."""
    dim = query.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    estimate = (query.astype(np.float32) @ signs.T) / (np.sqrt(dim) * correction).astype(np.float32)
    error = BOUND * np.sqrt(np.maximum(0, 1 - correction**2) / max(1, dim - 1)) / correction
    return estimate, error.astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact cosines of paired rows in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def dimension(vectors: DataFrame) -> int:
    """The most frequent length of a vector, 0 without any."""
    sizes = vectors.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("n")).count()
    row = sizes.where("n > 0").orderBy(F.desc("count"), "n").first()
    return row.n if row else 0


def number_type(vectors: DataFrame) -> str:
    """The numpy type that holds the components of ``embedding`` exactly."""
    return "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"


def index(vectors: DataFrame, dim: int, rotated_by: np.ndarray, keep: int) -> DataFrame:
    """vid, vector (``number_type`` as bytes), bits, correction, ids (the ``keep`` least), queries of each batch's distinct usable vectors.

    vectors: vec_id, embedding, query (whether the row is a query).  Each batch is reduced first,
    so a vector that very many rows hold is small before the shuffle.
    """
    held = number_type(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            fits = np.nonzero(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) == dim)[0]
            values = np.array(lists.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
            ids, query = batch.column("vec_id").to_pylist(), batch.column("query").to_pylist()
            found: dict[bytes, tuple[set, set]] = {}
            for k, row, good in zip(fits.tolist(), values, np.isfinite(values).all(axis=1) & values.any(axis=1)):
                if good and ids[k] is not None:
                    own, asked = found.setdefault(row.astype(held).tobytes(), (set(), set()))
                    own.add(ids[k])
                    if query[k]:
                        asked.add(ids[k])
            unit = np.frombuffer(b"".join(found), held).reshape(-1, dim).astype(np.float64)
            unit = unit / np.abs(unit).max(axis=1, keepdims=True, initial=0)
            bits, correction = encode(unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True)), rotated_by)
            yield record_batch(vid=pa.array([xxhash.xxh3_128_digest(v) for v in found], pa.binary()), vector=pa.array(list(found), pa.binary()),
                               bits=pa.array([b.tobytes() for b in bits], pa.binary()), correction=pa.array(correction, pa.float64()),
                               ids=pa.array([sorted(own)[:keep] for own, _ in found.values()], pa.list_(pa.int64())),
                               queries=pa.array([sorted(asked) for _, asked in found.values()], pa.list_(pa.int64())))

    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "query")
    return arrow_stage(rows, run, "vid binary, vector binary, bits binary, correction double, ids array<long>, queries array<long>")


def _search(dim: int, rotated_by: np.ndarray, k: int, held: str):
    """The k + 1 nearest ids of each query of a group of query rows and code rows."""

    def fn(rows: dict) -> dict | None:
        asked = [n for n, kind in enumerate(rows["kind"]) if kind]
        codes = [n for n, kind in enumerate(rows["kind"]) if not kind]
        if not asked or not codes:
            return None
        matrix = lambda at: np.frombuffer(b"".join(rows["vector"][n] for n in at), held).reshape(-1, dim).astype(np.float64)
        vectors = matrix(codes)
        bits = np.frombuffer(b"".join(rows["bits"][n] for n in codes), np.uint8).reshape(len(codes), -1)
        correction = np.array([rows["correction"][n] for n in codes])
        place = {rows["vid"][n]: at for at, n in enumerate(codes)}
        out: list[tuple] = []
        for lo in range(0, len(asked), SLICE):
            part = asked[lo : lo + SLICE]
            queries = matrix(part)
            turned = queries / np.abs(queries).max(axis=1, keepdims=True)
            turned = turned / np.sqrt((turned * turned).sum(axis=1, keepdims=True)) @ rotated_by
            estimate, error = bounds(turned, bits, correction)
            lower = estimate - error
            own = [(at, place[rows["vid"][n]]) for at, n in enumerate(part) if rows["vid"][n] in place]
            for pair in own:  # the query's own vector may stand for the query alone
                lower[pair] = -np.inf
            least = np.partition(lower, len(codes) - k, axis=1)[:, len(codes) - k] if len(codes) > k else np.full(len(part), -np.inf)
            chosen = estimate + error >= least[:, None]
            for pair in own:
                chosen[pair] = True
            for at, n in enumerate(part):
                found = np.nonzero(chosen[at])[0]
                exact = cosine(np.broadcast_to(queries[at], (len(found), dim)), vectors[found])
                if len(found) > k + 2:  # no less near one can be among the k + 1 nearest; the own vector may have no other id
                    enough = exact >= np.partition(exact, len(exact) - k - 2)[len(exact) - k - 2]
                    found, exact = found[enough], exact[enough]
                best = sorted((-score, id_) for score, c in zip(exact.tolist(), found) for id_ in rows["ids"][codes[c]])
                out += [(rows["vid"][n], id_, -score) for score, id_ in best[: k + 1]]
        vid, id_, score = zip(*out)
        return {"vid": pa.array(vid, pa.binary()), "vec_id": pa.array(id_, pa.int64()), "score": pa.array(score, pa.float64())}

    return fn


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row of ``vectors`` (vec_id, embedding) that is a query."""
    spark = vectors.sparkSession
    dim = dimension(vectors)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rotated_by = rotation(dim)
    marked = vectors.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("query"))
    rows = cut(index(marked, dim, rotated_by, k + 1), "vector-codes")
    least = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    codes = cut(rows.groupBy("vid").agg(F.first("vector").alias("vector"), F.first("bits").alias("bits"), F.first("correction").alias("correction"),
                                        least.alias("ids"), F.max(F.size("queries") > 0).alias("query")), "distinct-codes")
    sizes = codes.agg(F.count(F.lit(1)).alias("codes"), F.count_if("query").alias("queries")).first()
    code_blocks, query_blocks = max(1, -(-sizes.codes // CODE_BLOCK)), max(1, -(-sizes.queries // QUERY_BLOCK))
    block = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "vid"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    columns = ["code_block", "query_block", "kind", "vid", "vector"]
    asked = codes.where("query").withColumn("kind", F.lit(1)).withColumn("query_block", block(2, query_blocks)).withColumn("code_block", every(code_blocks))
    work = (
        codes.withColumn("kind", F.lit(0)).withColumn("code_block", block(1, code_blocks)).withColumn("query_block", every(query_blocks))
        .select(*columns, "bits", "correction", "ids").unionByName(asked.select(columns), allowMissingColumns=True)
    )
    found = by_group(work, ["code_block", "query_block"], ["kind", "vid"], _search(dim, rotated_by, k, number_type(vectors)), "vid binary, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("vid").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    queries = rows.select("vid", F.explode("queries").alias("query_id")).distinct()
    others = F.slice(F.filter("found", lambda x: x.vec_id != F.col("query_id")), 1, k)
    ranked = queries.join(found, "vid").select("query_id", F.posexplode(others).alias("at", "near"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("near.vec_id").alias("vec_id"), F.col("near.score").alias("score"))


def op4_onebit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)
