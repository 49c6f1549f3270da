"""Mixing sources to target weights: repetition rates per source, whole copies per document.

Sizes are word counts. Every source has a weight; targets share the total size by weight and stop at `ceiling` times
the size of their source, the excess being shared again by weight. The rate of a source is target / size, and a document
is taken floor(rate) times, and once more with a probability of the rest, drawn from a hash of its id and text.

Built-in functions only. One row per document (id, source, size, hash) and one per source is all that is shuffled.
The source table has a row per distinct source: ranking it takes one task, as ranks are global by definition.

Cases: null or empty text has size 0; its copies add no words. A null `source` is one source,
ranked last. Rows repeated in the input draw the same number. Sources of size 0 get target 0. An empty table gives an
empty result. Extra columns are handed through by `mixed_documents` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import WORDS_SQL, kept

#: Draws have 52 bits: 13 hex digits.
_DRAW = float(1 << 52)


def sized(docs: DataFrame) -> DataFrame:
    """The documents with `mix_size` (words) and `mix_draw` in [0, 1)."""
    size = F.expr(f"coalesce(size({WORDS_SQL}), 0)").cast("long")
    key = F.concat_ws(":", F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(_DRAW)
    return docs.withColumn("mix_size", size).withColumn("mix_draw", draw)


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ceiling: int = 3) -> DataFrame:
    """source, source_size, target, rate. Sources in order of their bytes (code points), null last, weigh `weights` in turn.

    Targets at the ceiling are those of the sources with the smallest size per weight. With the sources in that order
    the level (target per weight of the others) is (total - capped) / (weight - capped weight) for each possible cut, and
    the first cut whose level stays under the next source's ceiling is the one that repeated resharing ends at.
    """
    per = sizes.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("top", F.col("source_size") * F.lit(float(ceiling)))
    order = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("top").over(before), F.lit(0.0))
    weighs = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / weighs)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("top"), F.col("level"))
    per = per.withColumn("level", F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("top"), F.col("weight") * F.coalesce("level", F.lit(0.0)))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return per.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def copies(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ceiling: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, a row per document row."""
    rows = kept(sized(docs).select("doc_id", "source", "mix_size", "mix_draw"), "mix-sizes")
    per = kept(targets(rows, weights, ceiling), "mix-targets")
    df = rows.join(per.withColumnRenamed("source", "mix_source"), F.col("source").eqNullSafe(F.col("mix_source")), "left")
    return df.select("doc_id", "source", F.col("mix_size").alias("size"), "source_size", "target", _copies().alias("copies"))


def _copies():
    whole = F.floor("rate")
    return (whole + (F.col("mix_draw") < F.col("rate") - whole).cast("long")).cast("long")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ceiling: int = 3) -> DataFrame:
    """Each document as often as the mix takes it; `copy` counts from 0 and replaces a column of that name.

    The row travels as one struct, so its columns may have any name.
    """
    names = [c for c in docs.columns if c != "copy"]
    rows = sized(docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")))
    per = kept(targets(kept(rows.select("source", "mix_size"), "mix-sizes"), weights, ceiling), "mix-targets")
    per = per.select(F.col("source").alias("mix_source"), "rate")
    df = rows.join(per, F.col("source").eqNullSafe(F.col("mix_source")), "left").withColumn("mix_copies", _copies())
    copy = F.explode(F.expr("sequence(0, cast(mix_copies as int) - 1)")).alias("copy")
    return df.where("mix_copies > 0").select("row.*", copy)
