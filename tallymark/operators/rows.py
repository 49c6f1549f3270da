"""Row and cell differences, aligned by key or by sorted position.

Both alignments start from the multiset pairing, so identical rows never travel further than one shuffle.
What is left is numbered by running sums over sorted parts, so that many tasks share a key that holds much of the
data. Inside, columns go by their place, so that keys and values may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from tallymark.functions.sqltext import inline, literal, quoted, sql_type
from tallymark.functions.types import render
from tallymark.operators.align import Aligned, align, free_names
from tallymark.operators.multiset import N_SOURCE, N_TARGET, fingerprints, paired_counts, same_rows, unmatched
from tallymark.operators.sorting import sort_key, sorted_parts
from tallymark.session import written

MISMATCH, SOURCE_ONLY, TARGET_ONLY = "mismatch", "source_only", "target_only"

# Status whose count is that of the columns which are not compared: lost, gained or retyped.
UNALIGNED = "unaligned_columns"

# Positions per task group when runs of equal rows are laid out position by position.
BUCKET = 4096

# Types of the arrays that become rows; an array without elements has none of its own.
_CELLS = "array<struct<column: string, source_value: string, target_value: string>>"
_COLUMNS = "array<struct<column: string, n_mismatch: bigint>>"


@dataclass
class RowDiff:
    """Differing rows of two tables in pairs.

    ``pairs`` holds the keys under names by place, ``place``, ``status``, and the structs ``source`` and ``target`` of
    the value columns by place, of which one is null where only the other side has the row. ``rows`` is the same under
    the user's names. A report's own column whose name a key has gets an underscore at its end.
    """

    pair: Aligned
    pairs: DataFrame
    keys: list[str]
    place: str
    values: list[str]

    @property
    def by(self) -> list[str]:
        """The names of the alignment columns."""
        return [*self.keys, *free_names([self.place], self.keys)]

    @property
    def rows(self) -> DataFrame:
        kinds = {f.name: f.dataType for f in self.pair.source.schema.fields}
        row = ", ".join(f"{quoted(c)}: {sql_type(kinds[c])}" for c in self.values) or "none: int"
        named = [f"cast({side} as struct<{row}>) as {side}" for side in ("source", "target")]
        names = free_names(["status", "source", "target"], self.by)
        return self.pairs.selectExpr(*self.pair.code(self.keys), "place", "status", *named).toDF(*self.by, *names)

    def cells(self) -> DataFrame:
        """``(by…, column, source_value, target_value, diff)`` for every differing cell of mismatched rows."""
        kinds = {f.name: f.dataType for f in self.pair.source.schema.fields}
        cells = ", ".join(
            f"""if({differs}, named_struct('column', {literal(c)},
                'source_value', {render(f"source.{code}", kinds[c])},
                'target_value', {render(f"target.{code}", kinds[c])}), null)"""
            for c, code, differs in zip(self.values, self.pair.code(self.values), self.differing())
        )
        names = free_names(["column", "source_value", "target_value", "diff"], self.by)
        return (
            self.pairs.where(f"status = '{MISMATCH}'")
            .selectExpr(*self.pair.code(self.keys), "place", f"inline(cast(array_compact(array({cells})) as {_CELLS}))")
            .selectExpr("*", "concat(source_value, ' vs ', target_value) as diff")
            .toDF(*self.by, *names)
        )

    def columns(self) -> DataFrame:
        """``(column, n_mismatch)`` for every column in which mismatched rows differ; null for columns not compared."""
        counts = self.pairs.selectExpr("count(1) as n", *self.mismatches())
        columns = ", ".join(
            f"named_struct('column', {literal(c)}, 'n_mismatch', m{i})" for i, c in enumerate(self.values)
        )
        found = counts.selectExpr(f"inline(cast(array({columns}) as {_COLUMNS}))").where("n_mismatch > 0")
        lost = [(c, None) for c in self.pair.unaligned]
        return found.unionAll(found.sparkSession.createDataFrame(lost, found.schema)) if lost else found

    def differing(self) -> list[str]:
        """One condition on ``pairs`` per value column."""
        return [f"NOT source.{c} <=> target.{c}" for c in self.pair.code(self.values)]

    def mismatches(self) -> list[str]:
        """One count of mismatched rows per value column, ``m0``, ``m1``, …"""
        return [f"count_if(status = '{MISMATCH}' AND {d}) as m{i}" for i, d in enumerate(self.differing())]

    def statuses(self) -> DataFrame:
        """``(status, n_rows)`` of the differing rows, and the number of columns not compared, if any."""
        return _with_unaligned(self.pairs.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows")), self.pair)


def _with_unaligned(statuses: DataFrame, pair: Aligned) -> DataFrame:
    if not pair.unaligned:
        return statuses
    return statuses.unionAll(statuses.sparkSession.createDataFrame([(UNALIGNED, len(pair.unaligned))], statuses.schema))


_STATUS = f"""CASE WHEN source IS NULL THEN '{TARGET_ONLY}' WHEN target IS NULL THEN '{SOURCE_ONLY}'
                   ELSE '{MISMATCH}' END AS status"""


def _keys(pair: Aligned, keys: list[str]) -> tuple[list[str], list[str]]:
    keys = [k.lower() for k in keys]
    absent = [k for k in keys if k not in pair.columns]
    if absent or not keys:
        raise ValueError(f"key columns missing on a side or of another type: {absent or 'none given'}")
    return keys, [c for c in pair.columns if c not in keys]


def row_status_counts(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """``(status, n_rows)`` over match, mismatch, source_only and target_only, and where columns are lost, gained or
    retyped, their number under the status ``unaligned_columns``.

    Needs no pairing of single rows: per key, the surplus rows of both sides pair up to a mismatch as far as
    they go, and the rest exists on one side only.
    """
    pair = align(source, target)
    keys, _ = _keys(pair, keys)
    codes = pair.code(keys)
    # Rows without surplus only add to the matches: under one blank key they melt to a row per task.
    differs = f"{N_SOURCE} <> {N_TARGET}"
    blanked = paired_counts(pair).selectExpr(
        *[f"if({differs}, {k}, null) as {k}" for k in codes],
        f"{differs} as differs",
        f"least({N_SOURCE}, {N_TARGET}) as matched",
        f"greatest({N_SOURCE} - {N_TARGET}, 0L) as s",
        f"greatest({N_TARGET} - {N_SOURCE}, 0L) as t",
    )
    per_key = blanked.groupBy(*codes, "differs").agg(
        F.expr("sum(matched) as matched"), F.expr("sum(s) as s"), F.expr("sum(t) as t")
    )
    totals = per_key.selectExpr(
        "coalesce(sum(matched), 0L) as matched",
        "coalesce(sum(least(s, t)), 0L) as paired",
        "coalesce(sum(greatest(s - t, 0L)), 0L) as s",
        "coalesce(sum(greatest(t - s, 0L)), 0L) as t",
    )
    statuses = {"match": "matched", MISMATCH: "paired", SOURCE_ONLY: "s", TARGET_ONLY: "t"}
    counts = totals.selectExpr(inline(["status", "n_rows"], [[literal(k), v] for k, v in statuses.items()]))
    return _with_unaligned(counts, pair)


def duplicate_keys(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys…, count_source, count_target)`` for keys that hold several rows on a side."""
    pair = align(source, target)
    keys, _ = _keys(pair, keys)
    codes = pair.code(keys)
    left, right = pair.coded()
    sides = left.selectExpr(*codes, "1L as s", "0L as t").unionAll(right.selectExpr(*codes, "0L as s", "1L as t"))
    counts = sides.groupBy(*codes).agg(F.expr("sum(s) as s"), F.expr("sum(t) as t"))
    return counts.where("s > 1 or t > 1").toDF(*keys, *free_names(["count_source", "count_target"], keys))


def keyed_diff(source: DataFrame, target: DataFrame, keys: list[str], unique: bool = False) -> RowDiff:
    """Differing rows aligned by ``keys``, whatever the keys are called.

    Within a key identical rows cancel out first. The surplus rows of both sides then pair by their order
    over the other columns, nulls last; ``occurrence`` counts those pairs from 0.

    With ``unique`` the keys are checked to be unique and not null, and the sides are joined on them. Tables
    bucketed by the key are then compared without any shuffle.
    """
    return keyed_pairs(align(source, target), keys, unique)


def keyed_pairs(pair: Aligned, keys: list[str], unique: bool = False, seen: Observation | None = None) -> RowDiff:
    keys, values = _keys(pair, keys)
    codes, value_codes = pair.code(keys), pair.code(values)
    if unique:
        rows = _joined(pair, keys, codes, value_codes)
    else:
        rows = _pair_positions(numbered(unmatched(pair, seen), codes, value_codes), codes, value_codes)
    return RowDiff(pair, rows.selectExpr("*", _STATUS), keys, "occurrence", values)


def _joined(pair: Aligned, keys: list[str], codes: list[str], values: list[str]) -> DataFrame:
    source, target = pair.coded()
    for name, df in (("source", source), ("target", target)):
        counts = df.groupBy(*codes).agg(F.expr("count(1) as copies"))
        if not counts.where(" or ".join(["copies > 1"] + [f"{c} is null" for c in codes])).isEmpty():
            raise ValueError(f"the key {', '.join(keys)} is not unique in the {name}, or holds nulls")
    row = _row(values)
    both = source.selectExpr(*codes, f"{row} as source").join(target.selectExpr(*codes, f"{row} as target"), codes, "full_outer")
    return both.where("not source <=> target").selectExpr(*codes, "0L as place", "source", "target")


def positional_diff(source: DataFrame, target: DataFrame) -> RowDiff:
    """Differing rows aligned by position after both sides are sorted by all columns, nulls last.

    ``row_index`` counts from 0. Rows past the end of the shorter side are ``source_only`` or ``target_only``.
    """
    return positional_pairs(align(source, target))


def positional_pairs(pair: Aligned, prints: tuple[Row, Row] | None = None) -> RowDiff:
    if same_rows(pair, prints or fingerprints(pair)):
        row = _row(pair.codes)
        rows = pair.coded()[0].limit(0).selectExpr("0L as place", f"{row} as source", f"{row} as target")
    else:
        rows = _pair_positions(numbered(paired_counts(pair), [], pair.codes), [], pair.codes)
    return RowDiff(pair, rows.selectExpr("*", _STATUS), [], "row_index", pair.columns)


def _row(values: list[str]) -> str:
    """A struct of the value columns; with a key of all columns it has a placeholder field."""
    fields = [f"'{c}', {c}" for c in values] or ["'none', 0"]
    return f"named_struct({', '.join(fields)})"


def numbered(runs: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``source_at`` and ``target_at``: the copies of each side that sort before a run in its group.

    Sorted parts split even the largest group. Each sums its own runs; then the totals of a group's earlier parts are
    added. Written out in between, so that both steps see the same parts.
    """
    parts, n_parts = sorted_parts(written(runs, "runs"), group + order)
    ordering = ", ".join(f"{c} ASC NULLS LAST" for c in order) or "part"
    before = f"""(PARTITION BY {", ".join(["part"] + group)} ORDER BY {ordering}
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    local = parts.selectExpr(
        "*",
        f"coalesce(sum({N_SOURCE}) OVER {before}, 0L) as source_at",
        f"coalesce(sum({N_TARGET}) OVER {before}, 0L) as target_at",
    )
    if n_parts == 1:
        return local.drop("part")
    local = written(local, "parts")
    # Only a part's first and last group can have rows in another part, so the totals are at most two rows per part.
    # That bound makes the broadcasts safe.
    key = sort_key(group)
    shared = local
    if group:
        edges = local.groupBy("part").agg(F.expr(f"min({key}) as lowest"), F.expr(f"max({key}) as highest"))
        edges = edges.withColumnRenamed("part", "edge_part")
        shared = local.join(F.broadcast(edges), F.expr(f"part = edge_part AND ({key} <=> lowest OR {key} <=> highest)"))
    totals = shared.groupBy("part", *group).agg(F.expr(f"sum({N_SOURCE}) as s"), F.expr(f"sum({N_TARGET}) as t"))
    partition = f"PARTITION BY {', '.join(group)}" if group else ""
    earlier = f"({partition} ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = totals.selectExpr(
        "part as offset_part",
        *[f"{c} as offset_{c}" for c in group],
        f"coalesce(sum(s) OVER {earlier}, 0L) as source_offset",
        f"coalesce(sum(t) OVER {earlier}, 0L) as target_offset",
    ).where("source_offset > 0 or target_offset > 0")
    same = " AND ".join(["part = offset_part"] + [f"{c} <=> offset_{c}" for c in group])
    return local.join(F.broadcast(offsets), F.expr(same), "left").selectExpr(
        *runs.columns,
        "source_at + coalesce(source_offset, 0L) as source_at",
        "target_at + coalesce(target_offset, 0L) as target_at",
    )


def _pair_positions(runs: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """Pair the sides position by position: ``(group…, place, source, target)``, positions of equal rows left out.

    A run covers an interval of positions on each side. Where a run's two intervals overlap, both sides hold
    the same row, so only what sticks out is laid out: one row per position that really differs.
    """
    ends = runs.selectExpr(
        *group,
        f"{_row(values)} as row",
        "source_at as s_lo",
        f"source_at + {N_SOURCE} as s_hi",
        "target_at as t_lo",
        f"target_at + {N_TARGET} as t_hi",
    ).selectExpr("*", "greatest(s_lo, t_lo) as lo", "least(s_hi, t_hi) as hi")
    pieces = ", ".join(
        f"named_struct('from_source', {is_source}, 'lo', {start}, 'hi', {end})"
        for is_source, side in (("true", "s"), ("false", "t"))
        for start, end in (
            (f"{side}_lo", f"if(hi > lo, lo, {side}_hi)"),
            (f"if(hi > lo, hi, {side}_hi)", f"{side}_hi"),
        )
    )
    laid = ends.selectExpr(*group, "row", f"inline(filter(array({pieces}), piece -> piece.hi > piece.lo))")
    # Cut long intervals in two steps, so that no generated array grows with the length of a run.
    for width in (BUCKET * BUCKET, BUCKET):
        laid = laid.selectExpr(
            *group, "row", "from_source", "lo", "hi",
            f"explode(sequence(lo div {width}, (hi - 1) div {width})) as bucket",
        ).selectExpr(
            *group, "row", "from_source", "bucket",
            f"greatest(lo, bucket * {width}) as lo", f"least(hi, (bucket + 1) * {width}) as hi",
        )
    # One shuffle spreads the pieces; the grouping below keeps its partitioning.
    at = "explode(sequence(lo, hi - 1)) as place"
    laid = laid.repartition(*group, "bucket").selectExpr(*group, "row", "from_source", "bucket", at)
    pairs = laid.groupBy(*group, "bucket", "place").agg(
        F.expr("first(row) filter (where from_source) as source"),
        F.expr("first(row) filter (where not from_source) as target"),
    )
    return pairs.select(*group, "place", "source", "target")
