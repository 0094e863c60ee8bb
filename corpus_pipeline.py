"""Corpus pipeline over the documents table: five stages, each written and read again.

Every stage works on all rows that the stage before it kept. The first four return the
columns of documents; the last returns the encoded corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hilvan.llm import bpe, decontaminate, jaccard_join, quality_rules, secret_scan
from hilvan.llm.catalog import vocabulary
from hilvan.llm.groups import BATCH_BYTES, SMALL_BATCH, stored


def modest(spark: SparkSession) -> None:
    """Small batches for Python from here on, as a stage's rows are made when the caller writes them.

    All stages share their workers. A session with a limit of its own keeps it.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, SMALL_BATCH)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a quality rule rejects."""
    return quality_rules.keep_good(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group linked by shingle similarity."""
    return jaccard_join.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark window."""
    modest(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets, and counts the characters anew."""
    modest(spark)
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    modest(spark)
    return bpe.encode_column(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", good_quality),
    ("near copies", no_near_copies),
    ("decontamination", no_benchmark),
    ("secrets", no_secrets),
    ("encoding", encoded),
]

#: The search over words, the nested decoding and the encoding aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs)
    return docs
