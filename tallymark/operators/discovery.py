"""What a comparison needs to know before it starts: renamed columns and columns that make a key."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.sqltext import literal, quoted
from tallymark.functions.types import canonical, common_type
from tallymark.operators.align import align

#: Nominal entries of a value sketch, as a power of two: at most 64 KB a column.
ENTRIES = 12
#: Spread of the distinct counts by which column sets are ruled out.
SPREAD = 0.02


def _sketches(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with a sketch of each column's values, ``s0``, ``s1``, …; nulls and copies don't count."""
    return df.agg(*[F.theta_sketch_agg(F.col(quoted(c)), ENTRIES).alias(f"s{i}") for i, c in enumerate(columns)])


def renamed_columns(source: DataFrame, target: DataFrame, least: float = 0.5) -> DataFrame:
    """``(source_column, target_column, overlap)``: columns lost in the target that came back under another name.

    Each lost column is set beside each gained one of a type that compares. ``overlap`` is the share of their
    different values that both hold, estimated from sketches of the smallest hashes, which one pass per side builds and
    which merge map-side. A pair is told if neither column has a better partner, from ``least`` on.
    """
    pair = align(source, target)
    lost, gained = pair.missing_in_target, pair.missing_in_source
    sides = canonical(source), canonical(target)
    kinds = [{f.name: f.dataType for f in df.schema.fields} for df in sides]
    pairs = [(a, b) for a in lost for b in gained if common_type(kinds[0][a], kinds[1][b]) is not None]
    if not pairs:
        return source.sparkSession.createDataFrame([], "source_column string, target_column string, overlap double")
    shown = [df.select(*[_as_text(df.schema[c]) for c in names]) for df, names in zip(sides, (lost, gained))]
    left = _sketches(shown[0], lost)
    right = _sketches(shown[1], gained).withColumnsRenamed({f"s{i}": f"t{i}" for i in range(len(gained))})
    # Two rows, one per side, become one row per pair of columns.
    both = left.withColumn("one", F.lit(1)).join(right.withColumn("one", F.lit(1)), "one")
    found = F.array(
        *[
            F.struct(
                F.expr(literal(a)).alias("source_column"),
                F.expr(literal(b)).alias("target_column"),
                (
                    F.theta_sketch_estimate(F.theta_intersection(f"s{lost.index(a)}", f"t{gained.index(b)}"))
                    / F.greatest(F.theta_sketch_estimate(F.theta_union(f"s{lost.index(a)}", f"t{gained.index(b)}", ENTRIES)), F.lit(1))
                ).alias("overlap"),
            )
            for a, b in pairs
        ]
    )
    rows = both.select(F.explode(found).alias("p")).select("p.*").where(F.col("overlap") >= least)
    best = [rows.groupBy(c).agg(F.max(F.struct("overlap", other)).alias("best")).select(c, f"best.{other}") for c, other in (("source_column", "target_column"), ("target_column", "source_column"))]
    return rows.join(best[0], ["source_column", "target_column"]).join(best[1], ["source_column", "target_column"])


def _as_text(field: T.StructField) -> Column:
    """A column as text that equal values of comparable types share: 1 and 1.0, a date and its midnight."""
    name, kind = quoted(field.name), field.dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        shown = f"if({name} = floor({name}) AND abs({name}) < 1e15, cast(cast({name} as bigint) as string), cast(cast({name} as double) as string))"
    elif isinstance(kind, T.DecimalType):
        shown = f"regexp_replace(cast({name} as string), '[.]0+$|([.][0-9]*[1-9])0+$', '$1')"
    elif isinstance(kind, T.DateType):
        shown = f"cast(cast({name} as timestamp_ntz) as string)"
    else:
        shown = f"cast({name} as string)"
    return F.expr(shown).alias(field.name)


def candidate_keys(df: DataFrame, most: int = 2) -> DataFrame:
    """``(key, n_columns)``: the smallest sets of at most ``most`` columns that are unique and without nulls.

    Level by level, as in a lattice: a set is looked at only if no part of it is a key already. One pass per level estimates how many
    different values each set has, which rules out most; what may be a key is then checked exactly. Names in ``key`` are
    joined by ``, ``, in the order of the table.
    """
    df = canonical(df)
    columns = df.columns
    spark = df.sparkSession
    nulls = df.select(F.count("*").alias("n"), *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    total, full = nulls["n"], [c for i, c in enumerate(columns) if nulls[f"c{i}"] == nulls["n"]]
    found: list[tuple[str, ...]] = []
    distinct: dict[tuple[str, ...], int] = {}
    for size in range(1, most + 1):
        sets = [s for s in combinations(full, size) if not any(set(k) <= set(s) for k in found)]
        # A set has at most as many values as its columns allow together.
        sets = [s for s in sets if math.prod(distinct[(c,)] * (1 + 3 * SPREAD) for c in s) >= total] if size > 1 else sets
        if not sets:
            continue
        counts = df.select(*[F.approx_count_distinct(F.xxhash64(*[F.col(quoted(c)) for c in s]), SPREAD).alias(f"d{i}") for i, s in enumerate(sets)]).first()
        distinct |= {s: counts[f"d{i}"] for i, s in enumerate(sets)}
        for s in sets:
            if distinct[s] >= (1 - 4 * SPREAD) * total and _unique(df, s):
                found.append(s)
    return spark.createDataFrame([(", ".join(k), len(k)) for k in found], "key string, n_columns int")


def _unique(df: DataFrame, columns: tuple[str, ...]) -> bool:
    repeated = df.groupBy(*[F.col(quoted(c)) for c in columns]).agg(F.count("*").alias("n copies")).where("`n copies` > 1")
    return repeated.isEmpty()
