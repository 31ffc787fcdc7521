"""The training-data pipeline: each stage works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardwatch.llm import langid, packing, quality, simhash
from wardwatch.llm.common import table
from wardwatch.session import scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.keep_identified(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be of good quality."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, length=1024)


STAGES = [("language_id", language_id), ("quality_classifier", quality_classifier),
          ("simhash_near_dedup", simhash_near_dedup), ("packing", packed)]

#: Trained models and tokenizers have no SQL form; tests/llm holds the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one's rows written and reread."""
    docs = table(spark, sf_dir, "documents")
    root = scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
