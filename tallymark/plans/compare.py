"""Data-to-data comparison of two frames with a chosen or derived alignment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation

from tallymark.functions.sqltext import literal
from tallymark.operators.align import Aligned, align
from tallymark.operators.hash_profile import manual_summary
from tallymark.operators.multiset import N_SOURCE, N_TARGET, fingerprints, surplus, unmatched
from tallymark.operators.sinks import write_result
from tallymark.operators.rows import SOURCE_ONLY, TARGET_ONLY, RowDiff, keyed_pairs, positional_pairs
from tallymark.session import written

MODES = ("auto", "keyed", "positional", "bag")


@dataclass
class Comparison:
    """The outcome of one comparison: ``rows`` for keyed and positional mode, ``bag`` for bag mode."""

    mode: str
    pair: Aligned
    count_source: int
    count_target: int
    rows: RowDiff | None = None
    extra: DataFrame | None = None

    @property
    def bag(self) -> DataFrame | None:
        """The differing rows with their surplus copies per side."""
        return None if self.extra is None else surplus(self.pair, self.extra)

    def cells(self) -> DataFrame:
        if self.rows is None:
            raise ValueError("a bag comparison has no cells; give keys")
        return self.rows.cells()

    def write(self, folder: str, fmt: str = "parquet") -> None:
        """Write the summary and all differences: cells and statuses, or in bag mode the differing rows."""
        write_result(self.summary(), f"{folder}/summary", fmt)
        if self.rows is None:
            write_result(self.bag, f"{folder}/rows", fmt)
        else:
            write_result(self.rows.statuses(), f"{folder}/statuses", fmt)
            write_result(self.cells(), f"{folder}/cells", fmt)

    def summary(self) -> DataFrame:
        """``(key, Status, Remarks)`` with the rows ``Count`` and ``Data``."""
        if self.rows is not None:
            totals = self.rows.pairs.selectExpr(
                *self.rows.mismatches(),
                f"count_if(status = '{SOURCE_ONLY}') as s",
                f"count_if(status = '{TARGET_ONLY}') as t",
            )
            notes = [f"if(m{i} > 0, {literal(c)}, null)" for i, c in enumerate(self.rows.values)]
        else:
            totals = self.extra.selectExpr(f"coalesce(sum({N_SOURCE}), 0L) as s", f"coalesce(sum({N_TARGET}), 0L) as t")
            notes = []
        notes = (
            [literal(r) for r in self.pair.remarks]
            + notes
            + [f"if({side} > 0, concat({side}, ' rows only in {name}'), null)" for side, name in (("s", "Source"), ("t", "Target"))]
        )
        remarks = totals.selectExpr(f"concat_ws(', ', {', '.join(notes)}) as remarks")
        return remarks.selectExpr(manual_summary(str(self.count_source), str(self.count_target), "remarks"))


def compare(source: DataFrame, target: DataFrame, keys: list[str] | None = None, mode: str = "auto") -> Comparison:
    """Compare the rows of two frames.

    ``auto`` aligns by key where keys are given and by sorted position otherwise; ``bag`` compares the sides as
    multisets. Rows are counted on the way: by position with the fingerprints, else by the pass that pairs the rows.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}, choose from {', '.join(MODES)}")
    pair = align(source, target)
    if mode == "auto":
        mode = "keyed" if keys else "positional"
    if mode == "positional":
        prints = fingerprints(pair)
        return Comparison(mode, pair, *(p["n_rows"] for p in prints), rows=positional_pairs(pair, prints))
    seen = Observation()
    if mode == "keyed":
        rows, extra = keyed_pairs(pair, keys or [], seen=seen), None
    else:
        rows, extra = None, written(unmatched(pair, seen), "bag")
    return Comparison(mode, pair, seen.get[N_SOURCE], seen.get[N_TARGET], rows, extra)
