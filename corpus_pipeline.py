"""The corpus pipeline: quality rules, near-duplicate removal, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet to the shared folder and
read again as the next stage's docs. The first three return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm import jaccard_join, packing, quality_rules, secret_scan
from cardsentry.llm.common import saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (of least id) of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by their kind in brackets; n_chars follows the text."""
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 1024 tokens, and their token ids."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", deduplicate), ("secret scans", secrets), ("best-fit packing", pack)]

#: SQL cannot express the shingle join, the worklist or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
