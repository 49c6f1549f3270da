"""Tables as multisets: which rows differ, and how often, in one shuffle without a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from tallymark.functions.sqltext import literal, quoted, sql_type
from tallymark.functions.types import canonical
from tallymark.operators.align import Aligned, align, free_names
from tallymark.operators.checks import DATA_MATCH, DATA_MISMATCH

N_SOURCE, N_TARGET = "n_source", "n_target"


def paired_counts(pair: Aligned) -> DataFrame:
    """Distinct rows of both sides, under names by place, with their number of copies per side.

    A tagged union grouped by all columns: copies merge before the shuffle, so a row or key that fills much
    of a table spreads over tasks, and GROUP BY treats nulls as equal.
    """
    if not pair.columns:
        raise ValueError("the two sides share no comparable column")
    source, target = pair.coded()
    tagged = source.selectExpr("*", f"1L as {N_SOURCE}", f"0L as {N_TARGET}").unionAll(
        target.selectExpr("*", f"0L as {N_SOURCE}", f"1L as {N_TARGET}")
    )
    return tagged.groupBy(*pair.codes).agg(
        F.expr(f"sum({N_SOURCE}) as {N_SOURCE}"), F.expr(f"sum({N_TARGET}) as {N_TARGET}")
    )


def unmatched(pair: Aligned, seen: Observation | None = None) -> DataFrame:
    """Rows left after identical rows cancel out, under names by place, with the surplus copies of each side.

    ``seen`` observes the rows of both sides, ``n_source`` and ``n_target``, on the way. It stands behind the shuffle, in
    the tasks of the result, which count once however often a lost executor's work is done again.
    """
    counts = paired_counts(pair)
    if seen is not None:
        counts = counts.observe(seen, *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in (N_SOURCE, N_TARGET)])
    return (
        counts.where(f"{N_SOURCE} <> {N_TARGET}")
        .selectExpr(
            *pair.codes,
            f"greatest({N_SOURCE} - {N_TARGET}, 0L) as {N_SOURCE}",
            f"greatest({N_TARGET} - {N_SOURCE}, 0L) as {N_TARGET}",
        )
    )


def surplus(pair: Aligned, rows: DataFrame) -> DataFrame:
    """The report of ``unmatched`` rows: the user's columns, ``source_extra``, ``target_extra``, and ``remarks`` where
    columns are lost, gained or retyped, with a row of its own that says so."""
    names = [*pair.columns, *free_names(["source_extra", "target_extra", "remarks"], pair.columns)]
    rows = rows.selectExpr(*pair.codes, N_SOURCE, N_TARGET)
    if pair.same_shape:
        return rows.toDF(*names[:-1])
    note = rows.sparkSession.range(1).selectExpr(
        *[f"cast(null as {sql_type(rows.schema[c].dataType)}) as {c}" for c in pair.codes],
        f"0L as {N_SOURCE}",
        f"0L as {N_TARGET}",
        f"{literal(', '.join(pair.remarks))} as remarks",
    )
    return rows.selectExpr("*", "cast(null as string) as remarks").unionAll(note).toDF(*names)


def bag_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """The shared columns of every differing row, with ``source_extra`` and ``target_extra`` copies.

    Where columns are lost, gained or retyped, a column ``remarks`` and a row of its own, without values, say so. Where
    a table has a column of such a name, the report's own gets an underscore at its end.
    """
    pair = align(source, target)
    return surplus(pair, unmatched(pair))


def table_equality(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: counts, surplus rows of each side, column remarks, and ``Data Match`` or ``Data Mismatch``."""
    pair = align(source, target)
    totals = paired_counts(pair).selectExpr(
        f"coalesce(sum({N_SOURCE}), 0L) as count_source",
        f"coalesce(sum({N_TARGET}), 0L) as count_target",
        f"coalesce(sum(greatest({N_SOURCE} - {N_TARGET}, 0L)), 0L) as source_extra",
        f"coalesce(sum(greatest({N_TARGET} - {N_SOURCE}, 0L)), 0L) as target_extra",
    )
    same_shape = str(pair.same_shape).lower()
    return totals.selectExpr(
        "*",
        f"if(source_extra = 0 and target_extra = 0 and {same_shape}, '{DATA_MATCH}', '{DATA_MISMATCH}') as status",
        f"{literal(', '.join(pair.remarks) or '-')} as remarks",
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """``(n_rows, hash_sum)`` from one scan and no row shuffle.

    Different fingerprints prove different data; equal ones are strong evidence only.
    """
    df = canonical(df)
    columns = [quoted(c) for c in df.columns]
    # A hash skips nulls, so where they stand is hashed as well.
    hashed = f"xxhash64({', '.join(columns + [f'{c} is null' for c in columns])})"
    return df.selectExpr(
        "count(1) as n_rows",
        f"coalesce(sum(cast({hashed} as decimal(38,0))), cast(0 as decimal(38,0))) as hash_sum",
    )


def fingerprints(pair: Aligned) -> tuple[Row, Row]:
    """The fingerprints of source and target, from one job over both."""
    sides = [
        fingerprint(df).selectExpr(f"{i} as side", "n_rows", "hash_sum")
        for i, df in enumerate((pair.source, pair.target))
    ]
    source, target = sorted(sides[0].unionAll(sides[1]).collect())
    return source, target


def is_equal(source: DataFrame, target: DataFrame, fast: bool = False) -> bool:
    """Whether both tables hold the same rows. ``fast`` accepts equal fingerprints as proof."""
    pair = align(source, target)
    return pair.same_shape and same_rows(pair, fingerprints(pair), fast)


def same_rows(pair: Aligned, prints: tuple[Row, Row], fast: bool = False) -> bool:
    """Whether the shared columns hold the same rows: the full pairing runs only if fingerprints agree."""
    if prints[0][1:] != prints[1][1:]:
        return False
    return fast or unmatched(pair).isEmpty()
