"""Profiles of growing tables: partial aggregates per input file, stored and merged.

The store holds one row per file: its path, time and size, and each metric of its rows. A new profile reads only files
that are new or changed since, adds their rows to the store, and merges the rows of the files that are there now. Counts,
nulls and sums add up, extremes merge, so the result is that of reading everything.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.types import lower_names
from tallymark.operators.profile import Metric, long_form, metrics

_FILE = ["file", "modified", "length"]


def files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, path, modified, length)`` of the files of a table. Their content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select(F.col("_metadata.file_path").alias("file"), "path", F.col("modificationTime").alias("modified"), "length")


def profile_incremental(spark: SparkSession, path: str, store: str, fmt: str = "parquet") -> DataFrame:
    """``profile`` of the files under ``path``, of which only those that ``store`` doesn't know are read.

    A file counts as known under its path, time and size, and as long as the table's columns and types stay the same.
    Files that are gone drop out of the result. The store is appended to, never rewritten.
    """
    table = lower_names(spark.read.format(fmt).load(path))
    found = metrics(table.schema)
    # The kept rows are those of the same metrics: another schema is another part of the store.
    kept = f"{store.rstrip('/')}/{_label(table)}"
    now = files(spark, path)
    known = _stored(spark, kept)
    fresh = now if known is None else now.join(known.select(*_FILE), _FILE, "left_anti")
    new = [r["path"] for r in fresh.collect()]  # Spark lists a table's files on the driver anyway.
    if new:
        _partials(spark, new, fmt, found).join(fresh.drop("path"), "file").write.mode("append").parquet(kept)
    partials = _stored(spark, kept)
    if partials is None:
        return spark.createDataFrame([], "check string, column string, metric string, value string, ok boolean")
    # Two runs at a time may both have stored a file.
    return merged(partials.dropDuplicates(_FILE).join(now, _FILE, "left_semi"), found)


def _label(table: DataFrame) -> str:
    names = [f"{f.name} {f.dataType.simpleString()} {f.metadata}" for f in table.schema.fields]
    return "profile-" + hashlib.md5("|".join(names).encode()).hexdigest()


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _partials(spark: SparkSession, paths: list[str], fmt: str, found: list[Metric]) -> DataFrame:
    """One row per file: ``file`` and each metric's value ``v0``, ``v1``, … and whether it is complete, ``k0``, …"""
    read = spark.read.format(fmt).load(paths)
    read = read.select(F.col("_metadata.file_path").alias("file path"), *read.columns)
    return lower_names(read).groupBy(F.col("file path").alias("file")).agg(
        *[F.expr(f"{m.value} as v{i}") for i, m in enumerate(found)],
        *[F.expr(f"{m.ok} as k{i}") for i, m in enumerate(found) if m.ok != "true"],
    )


def merged(partials: DataFrame, found: list[Metric]) -> DataFrame:
    """The long profile of all files from the rows of each."""
    values, complete = [], []
    for i, m in enumerate(found):
        if m.check in ("Count", "Null", "Sum"):
            value = f"try_sum(v{i})"
        else:
            value = f"{m.name[:3].lower()}(v{i})"
        ok = "true"
        if m.ok != "true":
            # A part that did not fit, or a total that does not, makes the metric incomplete.
            ok = f"(coalesce(bool_and(k{i}), true) and ({value} is not null or count(v{i}) = 0))"
            value = f"if({ok}, {value}, null)"
        elif m.check == "Count":
            value = f"coalesce({value}, 0)"
        values.append(f"cast({value} as string) as v{i}")
        complete.append(f"{ok} as k{i}")
    row = partials.selectExpr(*values, *complete)
    return row.selectExpr(long_form(found, [f"k{i}" for i in range(len(found))]))
