"""Schema drift between two sides: missing columns, types outside the family, lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.types import (
    INTEGRAL_FAMILY,
    NUMBER_FAMILY,
    STRING_FAMILY,
    STRING_TARGETS,
    TIMESTAMP_FAMILY,
)
from tallymark.sources.catalog import describe_columns

MISSING_IN_TARGET, MISSING_IN_SOURCE = "missing_in_target", "missing_in_source"


def metadata_diff(source: DataFrame, target: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(by…, column, issue, source_type, target_type, source_length, target_length)`` from two metadata frames.

    ``issue`` is ``missing_in_target``, ``missing_in_source``, ``data_type`` or ``length``. Types agree within
    the source type's family; a source type of no family accepts any target type. ``by`` names columns that
    tell several pairs of tables apart.
    """

    def side(metadata: DataFrame, name: str) -> DataFrame:
        return metadata.select(
            *by,
            F.upper("column").alias("key"),
            F.col("column").alias(f"{name}_column"),
            F.col("data_type").alias(f"{name}_type"),
            F.col("length").alias(f"{name}_length"),
        )

    joined = side(source, "source").join(side(target, "target"), [*by, "key"], "full_outer")
    s, t = F.col("source_type"), F.col("target_type")
    resized = F.when(F.col("source_length") != F.col("target_length"), "length")
    issue = (
        F.when(t.isNull(), MISSING_IN_TARGET)
        .when(s.isNull(), MISSING_IN_SOURCE)
        .when(s.isin(STRING_FAMILY) & (t == "VARCHAR"), resized)
        .when(s.isin(STRING_FAMILY), F.when(~t.isin(STRING_TARGETS), "data_type"))
        .when(s.isin(NUMBER_FAMILY) & (t == "DECIMAL"), resized)
        .when(s.isin(NUMBER_FAMILY), F.when(~t.isin(NUMBER_FAMILY), "data_type"))
        .when(s.isin(INTEGRAL_FAMILY), F.when(~t.isin(INTEGRAL_FAMILY), "data_type"))
        .when(s.isin(TIMESTAMP_FAMILY), F.when(~t.isin(TIMESTAMP_FAMILY), "data_type"))
    )
    return joined.select(
        *by,
        F.lower(F.coalesce("source_column", "target_column")).alias("column"),
        issue.alias("issue"),
        "source_type",
        "target_type",
        "source_length",
        "target_length",
    ).where(F.col("issue").isNotNull())


def schema_diff(source: DataFrame, target: DataFrame, observe: bool = False) -> DataFrame:
    """Schema drift of two frames; ``observe`` uses the longest text seen where no length is declared."""
    return metadata_diff(describe_columns(source, observe), describe_columns(target, observe))


def missing_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """``(column, missing_in, data_type, n_values)``: columns of one side only and the values they hold."""

    def only(here: DataFrame, there: DataFrame, missing_in: str) -> DataFrame:
        other = {c.upper() for c in there.columns}
        lost = [c for c in here.columns if c.upper() not in other]
        measured = describe_columns(here.select(*[f"`{c}`" for c in lost]), observe=True) if lost else None
        if measured is None:
            measured = describe_columns(here).withColumn("n_values", F.lit(0).cast("bigint")).limit(0)
        return measured.select(F.lower("column").alias("column"), F.lit(missing_in).alias("missing_in"), "data_type", "n_values")

    return only(source, target, "target").unionByName(only(target, source, "source"))
