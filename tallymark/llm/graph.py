"""Connected components of an edge table, by joins and minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import forget, kept


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of the edges `a`, `b` can reach.

    Each round labels a node with its smallest neighbour and then with that one's label, and contracts the edges to the
    labels: edges within a label are gone, the others are few. A node with many neighbours is one group of a minimum,
    which is merged before the shuffle, and one key of a join, which adaptive execution splits. All that a round
    hands on is a written table; those of the round before are deleted.
    """

    def ordered(x: DataFrame) -> DataFrame:
        return x.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    edges = kept(ordered(edges), "edges")
    found = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("low")), "labels")
        far = low.select(F.col("node").alias("low"), F.col("low").alias("root"))
        old = [edges, low]
        labels = kept(low.join(far, "low").select("node", F.least("low", "root").alias("root")), "labels")
        # A label that is itself relabelled stays linked to its own label.
        of_roots = labels.select("root").distinct().join(labels.select(F.col("node").alias("root"), F.col("root").alias("b")), "root")
        moved = of_roots.where("root <> b").select(F.col("root").alias("a"), "b")
        ends = [labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b")]
        across = edges.join(ends[0], "a").join(ends[1], "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        edges = kept(ordered(across.unionAll(moved)), "edges")
        if found is None:
            found = kept(labels, "components")
        else:
            old.append(found)
            new = labels.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
            found = kept(found.join(new, "root", "left").select("node", F.coalesce("new_root", "root").alias("root")), "components")
        forget(labels, *old)
        if edges.isEmpty():
            forget(edges)
            return found
