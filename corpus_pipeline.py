"""Documents to training sequences: five stages, each over all that the one before kept."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from pathkin.llm import jaccard, packing, quality, secret_scan, toxicity
from pathkin.llm.queries import BYTE_BPE, table
from pathkin.session import stage_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.good_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id."""
    return jaccard.one_of_each(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", hide_secrets),
    ("packing", pack),
]

#: SQL can express no stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents in ``sf_dir``; each stage is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{stage_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
