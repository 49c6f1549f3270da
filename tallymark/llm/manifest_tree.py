"""A Merkle manifest of a dataset, with an inclusion proof per row, from fixed-offset windows.

Each row is a leaf. Per group (the source), leaves ascend by id; every `FAN` consecutive nodes, the last run with fewer,
become one node until one is left, the group's subroot. The subroots, by group, become the root in the same way.

Levels are built in storeys of `STOREY` levels. A storey deals nodes to blocks of `BLOCK` consecutive slots, so that no
run of any of its levels crosses a block: one shuffle and one sort serve all its levels, and no window holds more rows
than a block whatever a group's size. On level l the nodes stand on the rows whose slot is a multiple of FAN ** l; `lag`
and `lead` by FAN ** l and its multiples, masked by the node's place in its run and the run's length, supply the siblings,
and the row of the first child hashes the parent. A running `last` takes the siblings down to the leaves. What is left of
a block goes to the next storey, whose siblings come back by a join on the block.

Slots come from a range partitioning by group and id: each partition numbers its rows, and the counts of a group's earlier
partitions are added, from a table of one row per partition and group. A group that fills a third of the table is spread
like any other. Only digests travel; texts are hashed where they are read.

A level of a proof is the text of the run's digests with `*` for the node itself, so folding replaces the `*` and hashes.

Cases: a null id comes first in its group, equal ids are ordered by their leaves, so the tree doesn't depend on how the
rows lie; repeated rows are leaves of their own. A null group comes first. Null, empty and very long texts are hashed as
they are. An empty table has no rows and no root. A group of one row is its own subroot; with one group its subroot is
the root. Columns other than a leaf's are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import kept

FAN = 3
#: Levels that are built in one shuffle, and the slots of such a block.
STOREY = 7
BLOCK = FAN**STOREY
#: Columns of a leaf, in order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "*"


def hashed(*parts: Column) -> Column:
    """The digest of the parts, one after the other, as lowercase hex text."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _sized(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row; `changed` holds other expressions for some of its columns."""
    return hashed(*[_sized(changed.get(name, F.col(name))) for name in LEAF])


def _shared(count: Column, size: int) -> Column:
    """How many runs of `size` hold `count` nodes."""
    return F.floor((count + F.lit(size - 1)) / F.lit(size)).cast("long")


def _index(slot: Column, size: int) -> Column:
    return F.floor(slot / F.lit(size)).cast("long")


def _storey(rows: DataFrame) -> DataFrame:
    """Rows (tree, slot, n, digest, …) with `up`, their proof on this storey, and `top`, the block's node on its first row."""
    given = [c for c in rows.columns if c != "digest"]
    by = Window.partitionBy("tree", "block").orderBy("slot")
    rows = rows.select(*given, _index(F.col("slot"), BLOCK).alias("block"), F.col("digest").alias("node"))
    given.append("block")
    for level in range(STOREY):
        step, count = FAN**level, _shared(F.col("n"), FAN**level)
        index = _index(F.col("slot"), step)
        place = index % FAN
        run = F.least(F.lit(FAN).cast("long"), count - (index - place))
        before = {d: F.lag("node", d * step).over(by).alias(f"lag{d}") for d in range(1, FAN)}
        after = {d: F.lead("node", d * step).over(by).alias(f"lead{d}") for d in range(1, FAN)}
        rows = rows.select("*", *before.values(), *after.values())
        left = [F.when(place >= d, F.col(f"lag{d}")).otherwise("") for d in reversed(before)]
        right = [F.when(place + d < run, F.col(f"lead{d}")).otherwise("") for d in after]
        node, here = F.col("node"), (F.col("slot") % step == 0) & (count > 1)
        rows = rows.select(
            *given,
            *[f"up{k}" for k in range(level)],
            F.when(here, F.concat(*left, F.lit(NODE), *right)).alias(f"up{level}"),
            F.when(count <= 1, node).when(here & (place == 0), hashed(node, *right)).alias("node"),
        )
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    filled = F.array(*[F.last(f"up{level}", ignorenulls=True).over(so_far) for level in range(STOREY)])
    return rows.select(*given, F.col("node").alias("top"), filled.alias("up")).withColumn("up", F.filter("up", lambda u: u.isNotNull()))


def _paths(rows: DataFrame, most: int, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows (tree, slot, n, digest, …) with `up`, their whole proof, and what `finish` gives per tree.

    `slot` numbers a tree's rows from 0 to n - 1, `most` is the largest n. `finish` takes (tree, subroot) and returns at
    least `tree` and `higher`, the proof of the subroot.
    """
    here = kept(_storey(rows), "manifest-storey")
    if most <= BLOCK:
        key, above = ["tree"], finish(here.where("slot = 0").select("tree", F.col("top").alias("subroot")))
    else:
        tops = here.where("top IS NOT NULL")
        tops = tops.select("tree", F.col("block").alias("slot"), _shared(F.col("n"), BLOCK).alias("n"), F.col("top").alias("digest"))
        key, above = ["tree", "block"], _paths(tops, -(-most // BLOCK), finish).drop("n").withColumnsRenamed({"slot": "block", "up": "higher"})
    return here.join(above, key).withColumn("up", F.concat("up", "higher")).drop("block", "top", "higher")


def _lined(rows: DataFrame, keys: list[Column], name: str) -> tuple[DataFrame, Column]:
    """The rows in range partitions, written, with `line`, which ascends by the keys; and the partition that it names."""
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return kept(placed.withColumn("line", F.monotonically_increasing_id()), name), F.shiftright("line", 33)


def _ahead(by) -> Column:
    return F.coalesce(F.sum("held").over(by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with `tree`, `slot` and `n`: their group's number, their place in it, its size; and the groups (tree, n)."""
    placed, part = _lined(rows, [F.col(c).asc_nulls_first() for c in (group, *order)], "manifest-order")
    counts = placed.groupBy(F.col(group).alias("name"), part.alias("part")).agg(F.min("line").alias("least"), F.count("*").alias("held"))
    counts = kept(counts, "manifest-counts")
    names, names_part = _lined(counts.groupBy("name").agg(F.sum("held").alias("n")), [F.col("name").asc_nulls_first()], "manifest-names")
    shares = names.groupBy(names_part.alias("part")).agg(F.min("line").alias("first"), F.count("*").alias("held"))
    shares = shares.select("part", "first", _ahead(Window.partitionBy()).alias("before"))
    trees = names.withColumn("part", names_part).join(shares, "part")
    trees = kept(trees.select("name", (F.col("line") - F.col("first") + F.col("before")).alias("tree"), "n"), "manifest-trees")
    counts = counts.withColumn("before", _ahead(Window.partitionBy("name"))).withColumnRenamed("name", "of")
    counts = counts.join(trees, F.col("of").eqNullSafe(F.col("name"))).drop("name")
    met = F.col(group).eqNullSafe(F.col("of")) & (part == F.col("part"))
    slot = (F.col("line") - F.col("least") + F.col("before")).alias("slot")
    return placed.join(counts, met).select(*rows.columns, "tree", slot, "n"), trees.select("tree", "n")


def proven(leaves: DataFrame, group: str, order: list[str], digest: str) -> DataFrame:
    """The rows of `leaves` as struct `row`, with `up`, the proof of their digest, `subroot` and `root`."""
    rows, trees = numbered(leaves, group, order)
    rows = rows.select("tree", "slot", "n", F.col(digest).alias("digest"), F.struct(*leaves.columns).alias("row"))
    n_trees, most = trees.agg(F.count("*"), F.max("n")).first()

    def root(tops: DataFrame) -> DataFrame:
        return tops.select("tree", F.array().cast("array<string>").alias("higher"), F.col("subroot").alias("root"))

    def over(subroots: DataFrame) -> DataFrame:
        nodes = subroots.select(
            F.lit(0).cast("long").alias("tree"), F.col("tree").alias("slot"), F.lit(n_trees).cast("long").alias("n"), F.col("subroot").alias("digest"), "subroot"
        )
        return _paths(nodes, n_trees, root).select(F.col("slot").alias("tree"), "subroot", F.col("up").alias("higher"), "root")

    return _paths(rows, most or 0, over).select("row", "up", "subroot", "root")


def folded(digest: Column, up: Column) -> Column:
    """The root that a proof leads to from a leaf's digest."""
    return F.aggregate(up, digest, lambda node, level: F.sha2(F.replace(level, F.lit(NODE), node).cast("binary"), 256))


def proof_digest(up: Column) -> Column:
    return F.sha2(F.replace(F.array_join(up, ""), F.lit(NODE), F.lit("")).cast("binary"), 256)


def audited(docs: DataFrame) -> DataFrame:
    """Each document's proof against the manifest, after the newlines of half of the documents were lost."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    lost = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = kept(docs.select("doc_id", "source", leaf_digest().alias("leaf"), leaf_digest(text=lost).alias("found")), "manifest-digests")
    rows = proven(leaves, "source", ["doc_id", "leaf"], "leaf")
    rows = rows.select("row.doc_id", "row.leaf", "subroot", "root", proof_digest(F.col("up")).alias("proof_sha256"), folded(F.col("row.found"), F.col("up")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
