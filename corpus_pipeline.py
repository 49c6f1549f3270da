"""From raw documents to a training mix, in five stages.

Each stage works on all documents that the one before kept: quality rules drop what they reject, one document of each
near-duplicate group stays, documents with benchmark items go, secrets are replaced in the texts, and the mix repeats
documents so that sources come to their target weights. Between stages the documents are a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import decontamination, mixing, ngram_join, quality_rules, secrets
from tallymark.llm.common import documents, kept


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.distinct_documents(docs, n=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality rules", good_quality),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", without_benchmark),
    ("secret scan", without_secrets),
    ("mixing to target weights", mixed),
]

#: The latent search of the third stage has no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix; `copy` counts the repeats of a document from 0."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = kept(docs, f"stage-{i}")
    return docs
