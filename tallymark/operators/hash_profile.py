"""Hashed averages: one number per column that stands for all its values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.sqltext import chunks, inline, literal, quoted
from tallymark.functions.types import canonical, is_floating
from tallymark.operators.align import with_common_types
from tallymark.operators.checks import COUNT_MATCH, COUNT_MISMATCH, DATA_MATCH, DATA_MISMATCH

ALGORITHMS = ("murmur", "md5", "xxhash64")


def _hashed(column: str, dtype: T.DataType, algorithm: str) -> str:
    """Murmur gives its seed for null, so nulls weigh in; the others skip nulls."""
    if algorithm == "murmur":
        return f"hash({column})"
    if algorithm == "xxhash64":
        return f"if({column} is null, null, xxhash64({column}))"
    data = column if isinstance(dtype, T.BinaryType) else f"cast({column} as string)"
    return f"conv(substr(md5({data}), 1, 8), 16, 10)"


def _average(column: str, dtype: T.DataType, algorithm: str) -> str:
    """The mean as double, divided last from an exact sum: summing doubles would depend on row order."""
    if is_floating(dtype) or isinstance(dtype, T.DecimalType):
        value = f"try_cast({column} as decimal(38,12))"
        exact = f"cast(if(count({value}) = count({column}), try_sum({value}), null) as double) / count({column})"
        return f"if(count({column}) = 0, null, coalesce({exact}, avg(cast({column} as double))))"
    value = column if isinstance(dtype, T.NumericType) else _hashed(column, dtype, algorithm)
    return f"if(count({value}) = 0, null, cast(sum(cast({value} as decimal(38,0))) as double) / count({value}))"


def _exact(column: str, dtype: T.DataType, algorithm: str) -> str:
    """The sum behind the mean as text, or null where it does not fit: sums compare exactly, means do not."""
    if is_floating(dtype) or isinstance(dtype, T.DecimalType):
        value = f"try_cast({column} as decimal(38,12))"
        return f"cast(if(count({value}) = count({column}), try_sum({value}), null) as string)"
    value = column if isinstance(dtype, T.NumericType) else _hashed(column, dtype, algorithm)
    return f"cast(try_sum(cast({value} as decimal(38,0))) as string)"


def hash_profile(df: DataFrame, algorithm: str = "murmur") -> DataFrame:
    """One row: ``avg<column>`` of numbers as they are and of the hashes of everything else."""
    return _profile_row(canonical(df), algorithm)


def _profile_row(df: DataFrame, algorithm: str, *more: str) -> DataFrame:
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm}, choose from {', '.join(ALGORITHMS)}")
    return df.selectExpr(
        *[f"{_average(quoted(f.name), f.dataType, algorithm)} as {quoted(f'avg{f.name}')}" for f in df.schema.fields],
        *more,
    )


def hash_profile_long(df: DataFrame, algorithm: str = "murmur") -> DataFrame:
    """``(metric, n_values, value)``: the averages in long form with the number of values behind each."""
    return _long(canonical(df), algorithm).select("metric", "n_values", "value")


def _long(df: DataFrame, algorithm: str, columns_per_pass: int | None = None) -> DataFrame:
    """``(n_rows, metric, n_values, value, exact)``, from one pass or one for every few columns."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def one_pass(names: list[str]) -> DataFrame:
        counts = [f"count({quoted(c)}) as _n{i}" for i, c in enumerate(names)]
        sums = [f"{_exact(quoted(c), kinds[c], algorithm)} as _s{i}" for i, c in enumerate(names)]
        row = _profile_row(df.select(*[quoted(c) for c in names]), algorithm, "count(1) as n_rows", *counts, *sums)
        rows = [[literal(f"avg{c}"), f"_n{i}", quoted(f"avg{c}"), f"_s{i}"] for i, c in enumerate(names)]
        return row.selectExpr("n_rows", inline(["metric", "n_values", "value", "exact"], rows))

    return reduce(DataFrame.unionAll, [one_pass(part) for part in chunks(df.columns, columns_per_pass)])


def hash_profile_compare(
    source: DataFrame, target: DataFrame, algorithm: str = "murmur", columns_per_pass: int | None = None
) -> DataFrame:
    """``(key, Status, Remarks)`` with the rows ``Count`` and ``Data``, from one scan per side.

    Columns agree where the numbers of values and the exact sums do; only where a sum does not fit 38 digits on
    both sides the averages decide.
    """
    source, target = with_common_types(source, target)

    pairs = (
        _long(source, algorithm, columns_per_pass)
        .withColumn("from_source", F.lit(True))
        .unionAll(_long(target, algorithm, columns_per_pass).withColumn("from_source", F.lit(False)))
        .groupBy("metric")
        .agg(
            F.expr("max(value) filter (where from_source) as s"),
            F.expr("max(value) filter (where not from_source) as t"),
            F.expr("max(struct(n_values, exact)) filter (where from_source) as exact_s"),
            F.expr("max(struct(n_values, exact)) filter (where not from_source) as exact_t"),
            F.expr("max(from_source) as has_s"),
            F.expr("max(not from_source) as has_t"),
            F.expr("max(n_rows) filter (where from_source) as n_s"),
            F.expr("max(n_rows) filter (where not from_source) as n_t"),
        )
    )
    remark = """CASE WHEN NOT has_t THEN concat('Column ', metric, ' not in Target')
                     WHEN NOT has_s THEN concat('Column ', metric, ' not in Source')
                     WHEN NOT exact_s <=> exact_t OR NOT s <=> t THEN metric END"""
    return pairs.selectExpr(
        "max(n_s) as n_s", "max(n_t) as n_t", f"array_join(sort_array(collect_list({remark})), ', ') as remarks"
    ).selectExpr(manual_summary("n_s", "n_t", "remarks"))


def manual_summary(count_source: str, count_target: str, remarks: str) -> str:
    """SQL for the rows ``Count`` and ``Data`` of ``(key, Status, Remarks)``; no remarks mean matching data."""
    return inline(
        ["key", "Status", "Remarks"],
        [
            [
                "'Count'",
                f"if({count_source} = {count_target}, '{COUNT_MATCH}', '{COUNT_MISMATCH}')",
                f"concat({count_source}, ' vs ', {count_target})",
            ],
            [
                "'Data'",
                f"if({remarks} = '', '{DATA_MATCH}', '{DATA_MISMATCH}')",
                f"if({remarks} = '', '-', {remarks})",
            ],
        ],
    )
