"""From raw documents to packed training sequences.

Stages: the quality classifier drops documents it rejects, line dedup removes repeated
lines, the Jaccard join leaves one document of each group of near copies, benchmark
decontamination drops documents that hold a benchmark item, and best-fit packing lays
out what is left. Every stage is written as Parquet and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import decontaminate, jaccard, lines, packing, quality
from salesmart.llm.shared import table, vocabulary
from salesmart.storage import materialize


#: Rows that Spark hands to a Python worker at once. The executor and the worker both hold such a batch, with whole texts.
BATCH_ROWS = 1000


def in_small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows of a batch to ``BATCH_ROWS``; it stays so, since stages are run after they are built."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are judged good; every column stays."""
    in_small_batches(spark)
    return quality.classify(docs, table(spark, sf_dir, "labels"), cut=0.5).filter("keep").select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without their repeated lines; ``n_chars`` follows the text."""
    in_small_batches(spark)
    kept = lines.dedup_lines(docs, least_chars=20, least_docs=3)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return kept.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one of the smallest id."""
    in_small_batches(spark)
    return jaccard.without_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 4096 tokens."""
    in_small_batches(spark)
    return packing.pack(docs, vocabulary(), capacity=4096, end_id=1)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the trained classifier and the tokenizer. Tests hold every stage but the classifier, whose verdicts
#: they take from the operator, against a plain version on what the stage was given, and ``run`` against the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
