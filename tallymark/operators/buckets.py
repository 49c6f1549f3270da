"""Compare tables as multisets without moving their rows: sums of row hashes per key bucket, in a tree.

A node of the tree holds the number of its rows and the sums of two independent 64-bit hashes of them. Sums don't depend on
the order of the rows and count copies, and a node is the sum of its children. Two trees are compared from the root: equal
roots end the comparison, else only the children of differing nodes are looked at, down to single buckets. Only the rows
of differing buckets are then read again and paired.

A tree is one aggregation, merged map-side, so what is shuffled doesn't grow with the rows: at most one row per task and
bucket. It can be stored with its table and compared with another system's later. Equal sums are strong evidence, not
proof: different data go unseen only where two independent 64-bit sums both collide.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.sqltext import quoted
from tallymark.operators.align import Aligned, align
from tallymark.operators.multiset import surplus, unmatched
from tallymark.session import written

#: Bits of a bucket's number per level of the tree: the root, 256 nodes, 65536 buckets.
LEVELS = (0, 8, 16)
#: The sums of a node: both hashes in halves of 32 bits, so that 64-bit sums of 2 ** 31 rows of a bucket stay exact.
SUMS = ("n_rows", "a_low", "a_high", "b_low", "b_high")
_NODE = "level int, node bigint, n_rows decimal(38,0), a_low decimal(38,0), a_high decimal(38,0), b_low decimal(38,0), b_high decimal(38,0)"


def row_hash(columns: list[str], salt: int) -> str:
    """A 64-bit hash of a row. A hash skips nulls, so where they stand is hashed as well."""
    names = [quoted(c) for c in columns]
    return f"xxhash64({', '.join([f'{salt}L', *names, *[f'{c} is null' for c in names]])})"


def bucket(columns: list[str]) -> str:
    return f"pmod({row_hash(columns, 0)}, {1 << LEVELS[-1]}L)"


def digest_tree(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``(level, node, n_rows, …)``: the tree of a table whose rows are dealt to buckets by the columns ``by``.

    Both tables of a comparison need the same columns and types, as ``align`` gives them.
    """
    a, b = row_hash(df.columns, 1), row_hash(df.columns, 2)
    hashed = df.selectExpr(f"{bucket(by or df.columns)} as node", f"{a} as a", f"{b} as b")
    low, high = "sum({0} & 4294967295L)", "sum(shiftrightunsigned({0}, 32))"
    leaves = hashed.groupBy("node").agg(
        F.expr("count(1) as n_rows"),
        *[F.expr(f"{part.format(h)} as {h}_{name}") for h in "ab" for part, name in ((low, "low"), (high, "high"))],
    )
    top = LEVELS[-1]
    levels = ", ".join(f"struct({i} as level, shiftright(node, {top - bits}) as up)" for i, bits in enumerate(LEVELS))
    # At most 65536 leaves go on to the levels above.
    nodes = leaves.selectExpr(f"inline(array({levels}))", *SUMS).groupBy("level", F.col("up").alias("node"))
    return nodes.agg(*[F.expr(f"sum(cast({s} as decimal(38,0))) as {s}") for s in SUMS])


def differing_buckets(source: DataFrame, target: DataFrame) -> list[int]:
    """The buckets in which two trees differ, found from the root down."""
    found, above = [0], None
    for level, bits in enumerate(LEVELS):
        sides = [df.where(f"level = {level}").selectExpr("node", *[f"{sign}{s} as {s}" for s in SUMS]) for df, sign in ((source, ""), (target, "-"))]
        nodes = sides[0].unionAll(sides[1])
        if above is not None:
            # At most the nodes of one level: 65536 numbers.
            parents = nodes.sparkSession.createDataFrame([(n,) for n in found], "parent bigint")
            nodes = nodes.join(F.broadcast(parents), F.expr(f"shiftright(node, {bits - above}) = parent"), "left_semi")
        sums = nodes.groupBy("node").agg(*[F.expr(f"sum({s}) as {s}") for s in SUMS])
        found = sorted(r["node"] for r in sums.where(" or ".join(f"{s} <> 0" for s in SUMS)).select("node").collect())
        if not found:
            break
        above = bits
    return found


def in_buckets(df: DataFrame, by: list[str], buckets: list[int]) -> DataFrame:
    """The rows of the given buckets, of which there are at most 65536."""
    chosen = df.sparkSession.createDataFrame([(b,) for b in buckets], "bucket bigint")
    return df.join(F.broadcast(chosen), F.expr(f"{bucket(by)} = bucket"), "left_semi")


def narrowed(pair: Aligned, keys: list[str] | None = None) -> Aligned:
    """The same pair with the rows of differing buckets only; no rows where the trees agree."""
    source, target = pair.coded()
    by = pair.code([k.lower() for k in keys]) if keys else pair.codes
    trees = [written(digest_tree(df, by), "digests") for df in (source, target)]
    buckets = differing_buckets(*trees)
    sides = [in_buckets(df, by, buckets) if buckets else df.limit(0) for df in (source, target)]
    return replace(pair, source=sides[0].toDF(*pair.columns), target=sides[1].toDF(*pair.columns))


def bag_diff_by_buckets(source: DataFrame, target: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``bag_diff`` for tables that are expected to be nearly equal: two scans, and a shuffle of differing buckets only.

    With ``keys`` a changed row stays in the bucket of its key, so it costs one bucket instead of two.
    """
    pair = narrowed(align(source, target), keys)
    return surplus(pair, unmatched(pair))
