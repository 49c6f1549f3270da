"""Keyed diff by set reconciliation: what is shuffled grows with the differences, not with the rows.

Each side's row hashes go into an invertible lookup table: every hash is added to one cell in each of three parts of the
table, a cell being the number of its hashes and their sums, plus for the source, minus for the target. Rows that both
sides hold cancel out. A cell that is left with one hash gives it away; taking it from its other cells leaves others with
one, until the table is empty and all differing hashes are known. If the peeling gets stuck the table was too small, and
a larger one is filled. The rows of the hashes are then fetched by a semi join and aligned by key.

Hashes have 64 bits. Two different rows of one hash would cancel, so cells also sum a second, independent hash of the row:
the table doesn't come out empty then, and after the largest table the sides are compared whole.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import replace

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallymark.operators.align import Aligned, align
from tallymark.operators.buckets import row_hash
from tallymark.operators.rows import RowDiff, keyed_pairs

#: Bits of the cell number in a part of the first table and of the largest; the driver peels at most 3 << 17 cells.
FIRST, MOST = 10, 17
PARTS = (0, 20, 40)
_SUMS = ("n", "low", "high", "crc", "other")


def lookup_table(pair: Aligned, bits: int) -> DataFrame:
    """The cells that don't cancel out: ``cell`` and the sums of its hashes. One aggregation, merged map-side."""
    sides = []
    for df, sign in zip(pair.coded(), (1, -1)):
        hashed = df.selectExpr(f"{row_hash(pair.codes, 3)} as h", f"{row_hash(pair.codes, 4)} as o")
        cells = ", ".join(f"{i << bits}L + (shiftrightunsigned(h, {by}) & {(1 << bits) - 1}L)" for i, by in enumerate(PARTS))
        sides.append(
            hashed.selectExpr(
                f"{sign}L as n",
                f"{sign} * (h & 4294967295L) as low",
                f"{sign} * shiftrightunsigned(h, 32) as high",
                f"{sign} * crc32(cast(cast(h as string) as binary)) as crc",
                f"{sign} * shiftrightunsigned(o, 32) as other",
                f"explode(array({cells})) as cell",
            )
        )
    sums = sides[0].unionAll(sides[1]).groupBy("cell").agg(*[F.expr(f"sum({s}) as {s}") for s in _SUMS])
    return sums.where(" or ".join(f"{s} <> 0" for s in _SUMS))


def _only(cell: int, sums: list[int], bits: int) -> int | None:
    """The hash of a cell that holds copies of one only."""
    n, low, high, crc, other = sums
    if not n or any(s % n for s in sums):
        return None
    low, high = low // n, high // n
    if not (0 <= low < 1 << 32 and 0 <= high < 1 << 32) or other // n >> 32:
        return None
    unsigned = high << 32 | low
    part = cell >> bits
    signed = unsigned - (1 << 64) if unsigned >> 63 else unsigned
    if (unsigned >> PARTS[part]) & ((1 << bits) - 1) != cell & ((1 << bits) - 1):
        return None
    return signed if zlib.crc32(str(signed).encode()) == crc // n else None


def peeled(cells: list[Row], bits: int) -> list[int] | None:
    """The hashes in the cells, or None where the peeling gets stuck."""
    table = {r["cell"]: [r[s] for s in _SUMS] for r in cells}
    found, waiting = [], list(table)
    while waiting:
        cell = waiting.pop()
        sums = table.get(cell)
        h = None if sums is None else _only(cell, sums, bits)
        if h is None:
            continue
        found.append(h)
        taken = list(sums)
        for i, by in enumerate(PARTS):
            other = (i << bits) + (((h & ((1 << 64) - 1)) >> by) & ((1 << bits) - 1))
            left = [a - b for a, b in zip(table.get(other, [0] * len(taken)), taken)]
            if any(left):
                table[other] = left
                waiting.append(other)
            else:
                table.pop(other, None)
    return None if table else found


def differing_hashes(pair: Aligned, first: int = FIRST, most: int = MOST) -> list[int] | None:
    """The hashes of rows whose copies differ between the sides, or None where the largest table doesn't tell them."""
    bits = first
    while bits <= most:
        cells = lookup_table(pair, bits).collect()
        found = peeled(cells, bits)
        if found is not None:
            return found
        # From the share of cells in use follows how many hashes there are; three cells hold two of them safely.
        free = 1 - len(cells) / (3 << bits)
        wanted = -math.log(free) * (1 << bits) / 1.8 if free > 0.001 else 16 << bits
        bits = max(bits + 1, math.ceil(math.log2(wanted)))
    return None


def keyed_diff_small(source: DataFrame, target: DataFrame, keys: list[str]) -> RowDiff:
    """``keyed_diff`` for tables that are expected to be nearly equal, by two scans and shuffles of what differs."""
    pair = align(source, target)
    hashes = differing_hashes(pair)
    if hashes is None:
        return keyed_pairs(pair, keys)
    chosen = source.sparkSession.createDataFrame([(h,) for h in hashes], "hash bigint")
    match = F.expr(f"{row_hash(pair.codes, 3)} = hash")
    # At most two hashes for three cells of the largest table, so the broadcast is bounded.
    sides = [df.join(F.broadcast(chosen), match, "left_semi").toDF(*pair.columns) for df in pair.coded()]
    return keyed_pairs(replace(pair, source=sides[0], target=sides[1]), keys)
