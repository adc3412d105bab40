"""From raw documents to packed training sequences, stage by stage.

Each stage works on all rows that the stage before kept; its result is written as Parquet
and read again as the next one's input.  All stages but the last return the columns of
documents (doc_id, text, lang, source, n_chars).

* language: documents whose language can't be told go: those without a letter and those
  whose pooled probability is under least_probability of the number of languages.  The
  network learns from the table's own lang labels.
* quality: documents that the classifier scores under its cut go.
* line_dedup: lines that at least ten documents share are dropped from the texts.
* near_duplicates: of each class of documents linked by a Jaccard similarity of 0.8 or more
  over five-word shingles, the one of the least doc_id stays (of the least hash of its text,
  if rows share the id).
* packing: the texts become sequences of at most 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm import op3_quality, op5_chosen_path, op7_language, op8_packing, op9_line_dedup
from churnscope.llm.common import scratch, table
from churnscope.llm.links import first_of_each_class

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: How far a document's probability must be on the way from that of a guess (1 / languages) to 1.
LANGUAGE_MARGIN = 1 / 15


def least_probability(languages: int) -> float:
    """The least probability of a language that a document is kept with: 0.3 of four languages."""
    return 1 / languages + LANGUAGE_MARGIN * (1 - 1 / languages)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = op7_language.train(op7_language.sample(docs.select("doc_id", "text", "lang")))
    told = op7_language.identify(docs, net, COLUMNS)
    least = least_probability(len(net.labels)) if net is not None else 1.0
    return told.where((F.col("lang_pred") != op7_language.UNKNOWN) & (F.col("score") >= least)).select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = op3_quality.train(op3_quality.sample(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))
    return op3_quality.score_documents(docs, weights, COLUMNS).where(F.col("score") >= op3_quality.CUT).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = op9_line_dedup.drop_frequent_lines(docs, ["doc_id", "lang", "source"])
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(COLUMNS)
    return first_of_each_class(docs, op5_chosen_path.similar_classes(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_packing.packed_digest(spark, docs)


STAGES = [("language", language), ("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("packing", packing)]
#: The stages hold trained models, a similarity join and a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
