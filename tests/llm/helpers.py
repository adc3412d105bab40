"""Small tables for the text operators, and plain versions to hold them against."""

from __future__ import annotations

import os
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SCHEMAS = {
    "documents": DOCUMENTS,
    "benchmark": T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]),
    "labels": T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]),
    "pages": T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]),
    "embeddings": T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]),
}


def put(spark, folder, name: str, rows, extra: dict[str, object] | None = None) -> str:
    """Write rows as a table of ``folder``; extra columns hold one value."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMAS[name])
    for column, value in (extra or {}).items():
        df = df.withColumn(column, F.lit(value))
    df.write.mode("overwrite").parquet(os.path.join(str(folder), f"{name}.parquet"))
    return str(folder)


def documents(spark, folder, texts, extra=None, langs=None) -> str:
    """A table of documents with ids from 0 (or of (id, text) pairs)."""
    rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
    langs = langs or ["en"] * len(rows)
    return put(spark, folder, "documents", [(i, t, lang, "src", None if t is None else len(t)) for (i, t), lang in zip(rows, langs)], extra)


def words(text: str | None) -> list[str]:
    return re.findall(r"\w+", (text or "").lower())


def shingles(text: str | None) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a and b else 0.0


def classes(texts: dict[int, str | None], threshold: float = 0.8) -> dict[int, tuple[int, int]]:
    """doc_id → (least id of its class, links), by comparing all pairs."""
    sets = {k: shingles(t) for k, t in texts.items()}
    ids = sorted(sets)
    root, links = {k: k for k in ids}, dict.fromkeys(ids, 0)

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if jaccard(sets[a], sets[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (find(k), links[k]) for k in ids}


def near_copies(rng, count: int, length: int, changes: int) -> list[str]:
    """Texts of one base text with a few words changed in each."""
    base = [f"w{rng.randrange(10_000)}" for _ in range(length)]
    out = []
    for _ in range(count):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(length)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(own))
    return out
