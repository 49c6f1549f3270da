"""The registered queries of the operators, over whole tables, and their oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import (
    byte_bpe,
    decontamination,
    fixity,
    lexical_search,
    licences,
    manifest_tree,
    mixing,
    ngram_join,
    oracles,
    quality_model,
    quality_rules,
    secrets,
    suffix_dedup,
    toxicity,
)
from tallymark.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return fixity.audit(pages, fixity.decayed(pages))


ORACLES["op1_fixity"] = """
WITH sized AS (
  SELECT *, page_id // 4096 AS archive, page_id % 4096 AS slot,
    strlen('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id
      || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: ' || strlen(html))
      + 8 + strlen(html) AS length
  FROM pages),
placed AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY archive ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized),
faults AS (SELECT *, page_id % 211 = 7 AS lost, page_id % 97 = 5 AS changed, page_id % 499 = 11 AS twice FROM placed)
SELECT archive::BIGINT AS archive, slot::INT AS slot, page_id, CASE WHEN lost THEN 'missing' ELSE 'damaged' END AS status,
  1::BIGINT AS n_primary, CASE WHEN lost THEN 0 WHEN twice THEN 2 ELSE 1 END::BIGINT AS n_copy, start::BIGINT AS start, length::BIGINT AS bytes
FROM faults WHERE lost OR changed OR twice
"""


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, sf_dir)))


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(documents(spark, sf_dir), n=3, percent=90)


def _predicted(rows: DataFrame, least: float) -> DataFrame:
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))


@query
def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _predicted(quality_model.scored(documents(spark, sf_dir), labels), 0.7)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _predicted(toxicity.scored(documents(spark, sf_dir), labels), 0.5)


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.copies(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(licences.with_paths(documents(spark, sf_dir)))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(documents(spark, sf_dir)).drop("kept")


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(lexical_search.build(documents(spark, sf_dir)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_tree.audited(documents(spark, sf_dir))


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


ORACLES["op2_secrets"] = oracles.secrets_sql()
ORACLES["op6_mixing"] = oracles.mixing_sql()
ORACLES["op8_quality_rules"] = oracles.quality_rules_sql()
ORACLES["op11_lexical_search"] = oracles.lexical_search_sql()
ORACLES["op12_manifest"] = oracles.manifest_sql()
