"""The job manifest: one row per pair of tables to compare."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.sqltext import quoted
from tallymark.sources.catalog import resolve_base_table

FIELDS = [
    "connection",
    "table",
    "source",
    "target",
    "source_query",
    "target_query",
    "source_condition",
    "target_condition",
    "keys",
    "split_column",
    "splits",
]

# Header names of existing manifest files and the fields they fill.
HEADER_NAMES = {
    "connection_name": "connection",
    "table_name": "source",
    "iceberg_table": "target",
    "iceberg_database": "target_database",
    "query_td": "source_query",
    "query_iceberg": "target_query",
    "condition_td": "source_condition",
    "condition_ib": "target_condition",
}


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV (with header) or JSON manifest as text columns ``FIELDS``; ``keys`` are joined by ``|``.

    ``split_column`` and ``splits`` say how a JDBC source's table is read: by ranges of a column, and in how many.
    """
    if path.rstrip("/").lower().endswith((".json", ".jsonl")):
        first = spark.read.text(path).first()
        per_line = first is not None and re.fullmatch(r"\s*\{.*\}\s*", first[0]) is not None
        raw = spark.read.option("primitivesAsString", True).option("multiLine", not per_line).json(path)
    else:
        raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return normalise_manifest(raw)


def normalise_manifest(raw: DataFrame) -> DataFrame:
    """Known header names to ``FIELDS``; blank and ``nan`` cells to null; absent fields to null."""
    named = {HEADER_NAMES.get(c.strip().lower(), c.strip().lower()): c for c in raw.columns}

    def cell(name: str):
        if name not in named:
            return F.lit(None).cast("string")
        value = F.col(quoted(named[name]))
        if dict(raw.dtypes)[named[name]].startswith("array"):
            value = F.array_join(value, "|")
        text = F.trim(value.cast("string"))
        return F.when(~F.lower(text).isin("", "nan"), text)

    target = cell("target")
    if "target_database" in named:
        target = F.concat_ws(".", cell("target_database"), target)
    cells = {name: cell(name) for name in FIELDS} | {"target": target}
    cells["table"] = F.coalesce(cell("table"), cell("source"))
    return raw.select(*[cells[name].alias(name) for name in FIELDS])


def with_base_tables(manifest: DataFrame) -> DataFrame:
    """Add ``base_table``, the table whose metadata stands behind the source name."""
    return manifest.withColumn("base_table", resolve_base_table(F.col("source")))


def connections(manifest: DataFrame) -> DataFrame:
    """The distinct connections a manifest names."""
    return manifest.select("connection").where(F.col("connection").isNotNull()).distinct()
