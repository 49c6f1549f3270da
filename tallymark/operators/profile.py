"""Checks derived from column types, computed in one pass per side."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymark.functions.sqltext import chunks, inline, literal, quoted, sql_name
from tallymark.functions.types import declared_text_type, is_floating, is_temporal, is_text, lower_names

# The names of the checks.
CHECKS = ["Count", "Null", "Sum", "Max", "Length", "RLength"]


@dataclass(frozen=True)
class Metric:
    """One aggregate as SQL text; ``ok`` is the condition under which its value is complete."""

    check: str
    column: str
    name: str
    value: str
    ok: str = "true"


def metrics(schema: T.StructType) -> list[Metric]:
    """The metrics every column gets by its type; a check without columns is not listed."""
    out = [Metric("Count", "*", "Total_count", "count(1)")]
    for field in schema.fields:
        name, column = field.name, quoted(field.name)
        nulls = f"sum(cast({column} is null as bigint))"
        out.append(Metric("Null", name, f"Number_of_Null_Values_{name}", nulls))
        if isinstance(field.dataType, T.NumericType):
            out.append(Metric("Sum", name, f"sum_{name}", *_total(column, field.dataType)))
        elif is_temporal(field.dataType):
            out.append(Metric("Max", name, f"MAX_{name}", f"max({column})"))
            out.append(Metric("Max", name, f"MIN_{name}", f"min({column})"))
        elif is_text(field.dataType):
            trimmed = f"rtrim({column})" if declared_text_type(field)[0] == "CHAR" else column
            for check, text in (("Length", column), ("RLength", trimmed)):
                for side in ("max", "min"):
                    out.append(Metric(check, name, f"{side}_len_{name}", f"{side}(cast(length({text}) as bigint))"))
    return out


def _total(column: str, dtype: T.DataType) -> tuple[str, str]:
    """A sum that stays exact at any row count, and whether every value entered it.

    Whole numbers and (truncated) floating values sum as ``decimal(38,0)``: a 64-bit sum of keys
    overflows at a few billion rows. Decimals sum as ``decimal(38,12)``.
    """
    if isinstance(dtype, T.DecimalType):
        value, present = f"try_cast({column} as decimal(38,12))", column
    elif is_floating(dtype):
        present = f"nullif({column}, {dtype.simpleString()}('NaN'))"
        value = f"cast(try_cast({present} as bigint) as decimal(38,0))"
    else:
        return f"sum(cast({column} as decimal(38,0)))", "true"
    total = f"try_sum({value})"
    complete = f"(count({present}) = count({value}) and ({total} is not null or count({value}) = 0))"
    return f"if({complete}, {total}, null)", complete


def single_check(df: DataFrame, check: str) -> DataFrame:
    """One check as one wide row, one column per metric."""
    df = lower_names(df)
    found = [m for m in metrics(df.schema) if m.check == check]
    if not found:
        raise ValueError(f"no column takes the check {check}")
    return df.selectExpr(*[f"{m.value} as {quoted(m.name)}" for m in found])


def profile(df: DataFrame, checks: list[str] | None = None, columns_per_pass: int | None = None) -> DataFrame:
    """All checks in long form: ``(check, column, metric, value, ok)``, values as text.

    ``ok`` is false where a value did not fit its metric; the value is then null. All columns are measured in one
    pass. Beyond 100 aggregation buffers Spark leaves generated code; for wide columnar files that are cheap to
    read again, ``columns_per_pass`` takes a pass for every few columns, which share no column.
    """
    df = lower_names(df)
    found = [m for m in metrics(df.schema) if checks is None or m.check in checks]
    parts = [
        [m for m in found if m.column in chunk] for chunk in map(set, chunks(df.columns + ["*"], columns_per_pass))
    ]
    return reduce(DataFrame.unionAll, [_profile_pass(df, part) for part in parts if part])


def _profile_pass(df: DataFrame, part: list[Metric]) -> DataFrame:
    row = df.selectExpr(
        *[f"cast({m.value} as string) as v{i}" for i, m in enumerate(part)],
        *[f"{m.ok} as k{i}" for i, m in enumerate(part) if m.ok != "true"],
    )
    return row.selectExpr(long_form(part, ["true" if m.ok == "true" else f"k{i}" for i, m in enumerate(part)]))


def long_form(part: list[Metric], ok: list[str]) -> str:
    """SQL that turns the wide row ``v0, v1, …`` into the long profile."""
    return inline(
        ["check", "column", "metric", "value", "ok"],
        [
            [literal(m.check), literal(m.column), literal(m.name), f"cast(v{i} as string)", ok[i]]
            for i, m in enumerate(part)
        ],
    )


#: The largest double.
LARGEST = "1.7976931348623157E308"


def remote_metrics(schema: T.StructType, quote: str = '"') -> list[Metric]:
    """The same metrics in plain SQL for another engine, which takes ``quote`` around names.

    Sums of floating columns truncate each value to BIGINT. NaN counts as null, as it does here: engines either hold that
    NaN differs from itself, or that it is above all numbers, and so is its negative.
    """
    out = []
    for m in metrics(schema):
        if m.check == "Count":
            out.append(replace(m, value="count(*)"))
            continue
        field = schema[m.column]
        column = sql_name(m.column, quote)
        if is_floating(field.dataType):
            nan = f"{column} <> {column} or ({column} > {LARGEST} and -{column} > {LARGEST})"
            column = f"(case when {nan} then null else {column} end)"
        if m.check == "Null":
            value = f"sum(case when {column} is null then 1 else 0 end)"
        elif m.check == "Sum":
            decimal = isinstance(field.dataType, T.DecimalType)
            # Truncated before the cast, as some engines round.
            cut = f"case when {column} < 0 then ceil({column}) else floor({column}) end"
            whole = f"cast({cut} as bigint)" if is_floating(field.dataType) else column
            value = f"sum(cast({column if decimal else whole} as decimal({'38,12' if decimal else '38,0'})))"
        elif m.check == "Max":
            value = f"{m.name[:3].lower()}({column})"
        else:
            trimmed = m.check == "RLength" and declared_text_type(field)[0] == "CHAR"
            value = f"{m.name[:3]}(length({f'rtrim({column})' if trimmed else column}))"
        out.append(replace(m, value=value, ok="true"))
    return out


def check_queries(schema: T.StructType, table: str, where: str = "", quote: str = '"') -> dict[str, str]:
    """One SQL text per check over ``table``; ``where`` is a condition, with or without the word."""
    found = remote_metrics(schema, quote)
    return {
        check: _query([f"{m.value} as {sql_name(m.name, quote)}" for m in found if m.check == check], table, where)
        for check in CHECKS
        if any(m.check == check for m in found)
    }


def remote_profile_query(schema: T.StructType, table: str, where: str = "", quote: str = '"') -> str:
    """All metrics as one SQL text that returns a single row ``v0, v1, …``."""
    return _query([f"{m.value} as v{i}" for i, m in enumerate(remote_metrics(schema, quote))], table, where)


def remote_profile(row: DataFrame, schema: T.StructType) -> DataFrame:
    """The long profile from the row that ``remote_profile_query`` returned."""
    found = remote_metrics(schema)
    return row.selectExpr(long_form(found, ["true"] * len(found)))


def _query(values: list[str], table: str, where: str) -> str:
    where = where.strip()
    if where and not where.lower().startswith("where"):
        where = f"where {where}"
    return f"select {', '.join(values)} from {table} {where}".strip()
