"""Column metadata as frames: from a schema, from a catalog view with type codes, or from type text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.sqltext import chunks, inline, literal, quoted
from tallymark.functions.types import TYPE_CODES, UNKNOWN_TYPE, is_text, type_length, type_name

METADATA = "ordinal int, column string, data_type string, length string, nullable boolean"


def describe_columns(df: DataFrame, observe: bool = False, columns_per_pass: int | None = None) -> DataFrame:
    """``(ordinal, column, data_type, length, nullable)`` of every named, typed column.

    With ``observe`` one pass over the data, or one for every ``columns_per_pass`` columns, adds ``n_values``, ``n_null`` and ``max_length`` (text columns),
    and a text column without a declared length takes the longest one seen.
    """
    if not observe:
        return df.sparkSession.createDataFrame(column_rows(df.schema), METADATA)
    parts = chunks(_described_fields(df.schema), columns_per_pass)
    return reduce(DataFrame.unionAll, [_observed(df, part) for part in parts])


def _described_fields(schema: T.StructType) -> list[tuple[int, T.StructField]]:
    return list(enumerate(f for f in schema.fields if f.name.strip() and not isinstance(f.dataType, T.NullType)))


def column_rows(schema: T.StructType) -> list[tuple]:
    """The declared metadata of a schema as plain rows."""
    return [(i, f.name.strip(), type_name(f), type_length(f), f.nullable) for i, f in _described_fields(schema)]


def _observed(df: DataFrame, fields: list[tuple[int, T.StructField]]) -> DataFrame:
    """Declared and observed metadata of the given columns, from one pass over them."""
    measures, rows = ["count(1) as n_rows"], []
    for i, f in fields:
        measures.append(f"count({quoted(f.name)}) as n{i}")
        longest = "cast(null as bigint)"
        if is_text(f.dataType):
            measures.append(f"max(cast(length({quoted(f.name)}) as bigint)) as l{i}")
            longest = f"l{i}"
        rows.append(
            [
                str(i),
                literal(f.name.strip()),
                literal(type_name(f)),
                f"coalesce({literal(type_length(f))}, cast({longest} as string))",
                str(f.nullable).lower(),
                f"n{i}",
                f"n_rows - n{i}",
                longest,
            ]
        )
    names = ["ordinal", "column", "data_type", "length", "nullable", "n_values", "n_null", "max_length"]
    return df.selectExpr(*measures).selectExpr(inline(names, rows))


def describe_table(spark: SparkSession, table: str, observe: bool = False) -> DataFrame:
    return describe_columns(spark.table(table), observe)


def decode_type_code(code: Column) -> Column:
    """Type name of a catalog type code; ``UNKNOWN`` for a code that is not listed."""
    names = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in TYPE_CODES.items())
    return F.coalesce(F.try_element_at(F.expr(f"map({names})"), F.trim(code)), F.lit(UNKNOWN_TYPE))


def decode_catalog(view: DataFrame) -> DataFrame:
    """``(column, data_type, length, nullable)`` from a columns view with type codes.

    The view holds ``ColumnName, ColumnType, Nullable`` and, for decimals, ``DecimalTotalDigits`` and
    ``DecimalFractionalDigits``, wherever they stand. All other columns are kept.
    """
    used = ["columnname", "columntype", "nullable", "decimaltotaldigits", "decimalfractionaldigits"]
    kept = [F.col(quoted(c)) for c in view.columns if c.lower() not in used]
    decoded = view.select(
        *kept,
        F.rtrim("ColumnName").alias("column"),
        decode_type_code(F.col("ColumnType")).alias("data_type"),
        F.concat_ws(",", F.col("DecimalTotalDigits").cast("int"), F.col("DecimalFractionalDigits").cast("int")).alias(
            "length"
        ),
        (F.upper(F.trim("Nullable")) == "Y").alias("nullable"),
    )
    return named_and_typed(
        decoded.withColumn("length", F.when(F.col("data_type") == "DECIMAL", F.col("length")))
    )


def split_type_text(described: DataFrame, name: str, text: str) -> DataFrame:
    """``(column, data_type, length)`` from type text such as ``varchar(10)`` or ``decimal(10, 2)``."""
    upper = F.upper(F.trim(F.col(quoted(text))))
    inner = F.regexp_extract(upper, r"^[^(<]*\((\d+(?:\s*,\s*\d+)?)\)", 1)
    return named_and_typed(
        described.select(
            F.upper(F.trim(F.col(quoted(name)))).alias("column"),
            F.trim(F.regexp_extract(upper, r"^[^(<]*", 0)).alias("data_type"),
            F.when(inner != "", F.regexp_replace(inner, r"\s", "")).alias("length"),
        )
    )


def named_and_typed(metadata: DataFrame) -> DataFrame:
    """Drop rows without a name and rows of the void type."""
    return metadata.where((F.length(F.trim("column")) > 0) & (F.col("data_type") != "VOID"))


def resolve_base_table(name: Column) -> Column:
    """The base table behind a view name: database ``…_V.`` becomes ``…_T.``, a closing ``_V`` goes.

    Names outside a view database stay as they are.
    """
    base = F.regexp_replace(F.regexp_replace(F.upper(name), r"_V\.", "_T."), r"_V$", "")
    return F.when(F.lower(name).contains("v."), base).otherwise(name)
