"""Cleaning a corpus: from documents to piece ids, in five stages.

Each stage takes the rows its predecessor kept, written as Parquet and read again, and gives rows with
the columns of ``documents``; the last gives piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import classifier, jaccard_join, line_dedup, mixing, sentencepiece
from tallymark.plans.lineage import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows a task takes at a time: some megabytes of text, where Spark's 10,000 rows are tens, held by a worker and twice by its executor.
ROWS, ROWS_SETTING = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: SQL has no counterpart of the classifier, of the random mix or of the encoding.
ORACLE_SQL = None


def in_small_batches(spark: SparkSession) -> None:
    """Set the session's rows a batch, unless its owner has."""
    if spark.conf.get(ROWS_SETTING, None) is None:
        spark.conf.set(ROWS_SETTING, str(ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from labels that are not held out."""
    in_small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    labels = labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    scored = classifier.score(docs.select(*COLUMNS), classifier.train(docs, labels))
    return scored.where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; their length is counted anew."""
    return line_dedup.drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    in_small_batches(spark)
    return jaccard_join.one_per_group(docs).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix."""
    in_small_batches(spark)
    return sentencepiece.encode(docs.select("doc_id", "lang", "source", "text")).drop("text")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("mixing", mix),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
