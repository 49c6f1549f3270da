"""Bounded samples of labelled documents, the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, per_class: int) -> list[tuple[str, int]]:
    """(text, label) of at most `per_class` rows of each label outside the held-out part, those of the smallest hashes.

    The rows are chosen by id first, so that only their texts are read into the join.
    """
    good = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    good = good.where(~held_out(parts, part)).join(docs.select("doc_id").distinct(), "doc_id", "left_semi").distinct()
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = None
    for y in (0, 1):
        some = good.where(F.col("y") == y).orderBy(*order).limit(per_class)
        chosen = some if chosen is None else chosen.unionAll(some)
    found = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    return [(r["text"], r["y"]) for r in found.orderBy(*order, "y").limit(2 * per_class).toLocalIterator()]
