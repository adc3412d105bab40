"""Merkle fixity audit of WARC replicas.

Records lie in WARC files at byte offsets.  A file is cut into ordered offset ranges; a leaf
is the SHA-256 of a range's records in order (their offsets and digests), inner nodes are the
SHA-256 of up to FANOUT children in order, the top is the file's root.  An audit compares
the roots of two replicas and descends, level by level, only below nodes that differ; in the
leaves that differ it compares the records by offset.  All of it is DataFrame work: only
digests are compared and only differing branches are read again.

A record that one replica lacks, or that lies elsewhere, is reported with nulls for that
replica.  Null urls and payloads count as empty; records with a null id lie in
files of negative numbers, by the first 20 bits of their digest.  Repeated records lie one after the other at
offsets of their own; they are counted before offsets are summed up, so very many copies are one row until then.
Empty replicas have no roots and no differences.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnscope.llm.common import cut, table

#: Ids of pages in a file, bytes of an offset range, children of an inner node.
FILE_IDS, RANGE_BYTES, FANOUT = 512, 65536, 16


def page_record(url: Column, payload: Column) -> Column:
    """A WARC 1.1 resource record of a payload, as text."""
    lengths = F.octet_length(payload).cast("string")
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    lengths, F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def page_records(pages: DataFrame, file_ids: int = FILE_IDS) -> DataFrame:
    """file, record_id, offset, length, digest: the pages as records of WARC files, in the order of their ids.

    A file holds the pages of ``file_ids`` consecutive ids; its records follow one another.
    """
    record = page_record(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))
    rows = pages.select(F.col("page_id").alias("record_id"), record.alias("record"))
    rows = rows.select("record_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    own = F.floor(F.col("record_id") / F.lit(file_ids)).cast("long")
    apart = -1 - F.conv(F.substring("digest", 1, 5), 16, 10).cast("long")  # records without an id are spread over files of negative numbers
    alike = rows.groupBy(F.coalesce(own, apart).alias("file"), "record_id", "length", "digest").agg(F.count(F.lit(1)).alias("times"))
    before = Window.partitionBy("file").orderBy(F.asc_nulls_first("record_id"), "digest").rowsBetween(Window.unboundedPreceding, -1)
    begins = alike.withColumn("begin", F.coalesce(F.sum(F.col("length") * F.col("times")).over(before), F.lit(0).cast("long")))
    each = begins.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    return each.select("file", "record_id", "length", "digest", (F.col("begin") + F.col("k") * F.col("length")).alias("offset"))


def _hashed(rows: DataFrame, node: Column, order: str, value: Column) -> DataFrame:
    """file, node, hash: of the values of each node's rows in order."""
    grouped = rows.groupBy("file", node.alias("node")).agg(F.sort_array(F.collect_list(F.struct(F.col(order), value.alias("v")))).alias("parts"))
    return grouped.select("file", "node", F.sha2(F.concat_ws("\n", F.col("parts.v")), 256).alias("hash"))


def leaves(records: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """file, node, hash of the offset ranges that hold the beginning of a record."""
    value = F.concat_ws(" ", F.col("offset").cast("string"), F.col("length").cast("string"), F.col("digest"))
    return _hashed(records, F.floor(F.col("offset") / F.lit(range_bytes)).cast("long"), "offset", value)


def parents(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """file, node, hash of the next level up."""
    value = F.concat_ws(" ", F.col("node").cast("string"), F.col("hash"))
    return _hashed(level, F.floor(F.col("node") / F.lit(fanout)).cast("long"), "node", value)


def tree(records: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT, levels: int | None = None) -> list[DataFrame]:
    """The levels of all files' trees, leaves first; the last has one node, the root, for each file.

    ``levels`` fixes the height, so that two replicas have trees of the same shape.
    """
    out = [cut(leaves(records, range_bytes), "merkle-leaves")]
    if levels is None:
        levels = height(out[0], fanout)
    for _ in range(levels):
        out.append(cut(parents(out[-1], fanout), "merkle-level"))
    return out


def height(leaf_level: DataFrame, fanout: int = FANOUT) -> int:
    """Levels above the leaves until each file has one node."""
    last, levels = leaf_level.agg(F.max("node")).first()[0] or 0, 0
    while last:
        last, levels = last // fanout, levels + 1
    return levels


def differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """file, node of the nodes that differ or that one side lacks."""
    both = one.select("file", "node", F.col("hash").alias("a")).join(other.select("file", "node", F.col("hash").alias("b")), ["file", "node"], "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node")


def audit(one: DataFrame, other: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """file, offset, record_id, length_a, digest_a, length_b, digest_b of the records in which two replicas differ."""
    trees = [tree(one, range_bytes, fanout), tree(other, range_bytes, fanout)]
    while len(trees[0]) != len(trees[1]):  # the shorter tree gets levels of one node until both are as high
        short = min(trees, key=len)
        short.append(cut(parents(short[-1], fanout), "merkle-level"))
    below = differing(trees[0][-1], trees[1][-1])
    for a, b in zip(reversed(trees[0][:-1]), reversed(trees[1][:-1])):
        above = below.select("file", F.col("node").alias("up"))
        under = lambda level, above=above: level.withColumn("up", F.floor(F.col("node") / F.lit(fanout)).cast("long")).join(above, ["file", "up"], "left_semi")
        below = cut(differing(under(a), under(b)), "merkle-differing")
    at = F.floor(F.col("offset") / F.lit(range_bytes)).cast("long")
    suspect = lambda r: r.withColumn("node", at).join(below, ["file", "node"], "left_semi")
    sided = lambda r, s: suspect(r).select("file", "offset", F.col("record_id").alias(f"id_{s}"), F.col("length").alias(f"length_{s}"), F.col("digest").alias(f"digest_{s}"))
    both = sided(one, "a").join(sided(other, "b"), ["file", "offset"], "full_outer")
    both = both.where(~(F.col("digest_a").eqNullSafe(F.col("digest_b")) & F.col("length_a").eqNullSafe(F.col("length_b"))))
    return both.select("file", "offset", F.coalesce("id_a", "id_b").alias("record_id"), "length_a", "digest_a", "length_b", "digest_b")


def worn_replica(pages: DataFrame) -> DataFrame:
    """The pages as a replica with decayed payloads of the same length: by id, one page in 61 has
    another letter in a tag, one in 509 in all of its paragraphs."""
    page = F.col("html")
    worn = F.when(F.col("page_id") % 509 == 7, F.replace(page, F.lit("<p>"), F.lit("<q>")))
    return pages.withColumn("html", worn.when(F.col("page_id") % 61 == 3, F.replace(page, F.lit("<body>"), F.lit("<bodY>"))).otherwise(page))


def op6_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a decayed replica of all pages differs from the pages."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    one = cut(page_records(pages), "warc-records")
    other = cut(page_records(worn_replica(pages)), "warc-records")
    return audit(one, other)


_RECORDS_SQL = """
  SELECT file, record_id, length, digest,
         sum(length) OVER (PARTITION BY file ORDER BY record_id NULLS FIRST, digest ROWS UNBOUNDED PRECEDING) - length AS "offset"
  FROM (SELECT coalesce(page_id // 512, -1 - CAST('0x' || substr(sha256(record), 1, 5) AS BIGINT)) AS file,
               page_id AS record_id, strlen(record) AS length, sha256(record) AS digest
  FROM (SELECT page_id, 'WARC/1.1' || crlf || 'WARC-Type: resource' || crlf || 'WARC-Target-URI: ' || coalesce(url, '') || crlf
               || 'Content-Type: text/html' || crlf || 'Content-Length: ' || strlen(page) || crlf || crlf || page || crlf || crlf AS record
        FROM (SELECT page_id, url, chr(13) || chr(10) AS crlf, {page} AS page FROM pages)))
"""
OP6_SQL = f"""
WITH a AS ({_RECORDS_SQL.format(page="coalesce(html, '')")}),
b AS ({_RECORDS_SQL.format(page="""coalesce(CASE WHEN page_id % 509 = 7 THEN replace(html, '<p>', '<q>')
  WHEN page_id % 61 = 3 THEN replace(html, '<body>', '<bodY>') ELSE html END, '')""")})
SELECT CAST(file AS BIGINT) AS file, CAST("offset" AS BIGINT) AS "offset", coalesce(a.record_id, b.record_id) AS record_id,
       a.length AS length_a, a.digest AS digest_a, b.length AS length_b, b.digest AS digest_b
FROM a FULL JOIN b USING (file, "offset")
WHERE a.digest IS DISTINCT FROM b.digest OR a.length IS DISTINCT FROM b.length
"""
