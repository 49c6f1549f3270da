"""Fixity audit of two copies of an archive by Merkle trees.

Records are written as WARC response records, an archive per `SLOTS` consecutive page ids. A record's place in its
archive is its id's slot, so a lost record shifts no other; its offset is the length of the records before it. The leaf
of a slot hashes the records in it, as a multiset; the node above hashes `FANOUT` slots in order with the bytes they
span, and so on to one root per archive. The roots of two copies are compared first, and only below differing nodes are
children compared, down to the slots and records that differ.

Cases: rows without an id share archive -1, in slots by the hash of url and content. Null url and null content are empty.
Repeated rows are counted in their leaf, so that a copy that holds one too few or too many differs. Empty tables
give an empty result; a copy that lacks an archive differs in all its slots. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import kept

SLOTS, FANOUT, LEVELS = 4096, 16, 3


def records(pages: DataFrame) -> DataFrame:
    """archive, slot, page_id, length, digest: one row per record, from the record's bytes."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
    )
    record = F.concat(head, html, F.lit("\r\n\r\n"))
    page = F.col("page_id").cast("long")
    return pages.select(
        F.coalesce(F.floor(page / SLOTS), F.lit(-1)).cast("long").alias("archive"),
        F.coalesce(F.pmod(page, F.lit(SLOTS)), F.pmod(F.xxhash64(url, html), F.lit(SLOTS))).cast("int").alias("slot"),
        page.alias("page_id"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("digest"),
    )


def leaves(rows: DataFrame) -> DataFrame:
    """archive, node (slot), bytes, hash. The sums of parts of the digests are the same in any order of the records."""
    parts = [F.sum(F.conv(F.substring("digest", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).cast("string") for i in range(4)]
    grouped = rows.groupBy("archive", F.col("slot").alias("node"))
    return grouped.agg(F.sum("length").alias("bytes"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), *parts), 256).alias("hash"))


def above(nodes: DataFrame) -> DataFrame:
    """The level over `nodes`: each hash covers at most FANOUT children, their places and the bytes of the range."""
    children = F.array_sort(F.collect_list(F.struct("node", "hash")))
    joined = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["node"].cast("string"), c["hash"])), ",")
    grouped = nodes.groupBy("archive", F.expr(f"cast(node div {FANOUT} as int)").alias("node"))
    return grouped.agg(F.sum("bytes").alias("bytes"), F.sha2(F.concat_ws("|", F.sum("bytes").cast("string"), joined), 256).alias("hash"))


def tree(rows: DataFrame) -> list[DataFrame]:
    """Levels from the leaves to the roots, each a written table."""
    levels = [kept(leaves(rows), "leaves")]
    for _ in range(LEVELS):
        levels.append(kept(above(levels[-1]), "nodes"))
    return levels


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    a, b = (x.select("archive", "node", F.struct("bytes", "hash").alias(name)) for x, name in ((left, "a"), (right, "b")))
    return a.join(b, ["archive", "node"], "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("archive", "node")


def damaged_slots(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """archive, node of the slots whose leaves differ, found from the roots down."""
    found = kept(_differing(left[-1], right[-1]), "differing")
    for a, b in zip(left[-2::-1], right[-2::-1], strict=True):
        parents = found.select("archive", F.col("node").alias("parent"))
        under = [
            x.withColumn("parent", F.expr(f"cast(node div {FANOUT} as int)")).join(parents, ["archive", "parent"], "left_semi") for x in (a, b)
        ]
        found = kept(_differing(*under), "differing")
    return found


def audit(primary: DataFrame, copy: DataFrame) -> DataFrame:
    """archive, slot, page_id, status, n_primary, n_copy, start, bytes: the records that differ, by content.

    `status` is `missing`, `extra` or `damaged` (the slot's ids stand in both, with other content). `start` and `bytes`
    are the slot's offset and length in the primary (null where it has none).
    """
    rows = [kept(records(x), "records") for x in (primary, copy)]
    trees = [tree(x) for x in rows]
    slots = kept(damaged_slots(*trees).withColumnRenamed("node", "slot"), "damaged-slots")
    counted = [
        x.join(slots, ["archive", "slot"], "left_semi").groupBy("archive", "slot", "page_id", "digest").agg(F.count("*").alias(name))
        for x, name in zip(rows, ("n_primary", "n_copy"), strict=True)
    ]
    same = ["archive", "slot", "digest"]
    a = counted[0].withColumnRenamed("page_id", "id_a")
    b = counted[1].withColumnRenamed("page_id", "id_b")
    apart = a.join(b, same, "full").withColumn("page_id", F.coalesce("id_a", "id_b")).drop("id_a", "id_b").fillna(0, ["n_primary", "n_copy"])
    apart = apart.where("n_primary <> n_copy").groupBy("archive", "slot", "page_id")
    apart = apart.agg(F.sum("n_primary").alias("n_primary"), F.sum("n_copy").alias("n_copy"))
    status = F.expr("CASE WHEN n_copy = 0 THEN 'missing' WHEN n_primary = 0 THEN 'extra' ELSE 'damaged' END")
    # Offsets only in archives with damage: the lengths of the slots before, at most SLOTS rows an archive.
    own = trees[0][0].join(slots.select("archive").distinct(), "archive", "left_semi")
    before = F.coalesce(F.expr("sum(bytes) OVER (PARTITION BY archive ORDER BY node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0))
    ranges = own.select("archive", F.col("node").alias("slot"), before.alias("start"), "bytes")
    out = apart.join(ranges, ["archive", "slot"], "left")
    return out.select("archive", "slot", "page_id", status.alias("status"), "n_primary", "n_copy", "start", "bytes")


def decayed(pages: DataFrame) -> DataFrame:
    """A copy with faults at fixed ids: changed content, lost records and records written twice."""
    html = F.when(F.pmod("page_id", F.lit(97)) == 5, F.concat(F.coalesce("html", F.lit("")), F.lit("\0"))).otherwise(F.col("html"))
    copy = pages.select("page_id", "url", html.alias("html")).where("page_id IS NULL OR pmod(page_id, 211) <> 7")
    twice = F.explode(F.when(F.pmod("page_id", F.lit(499)) == 11, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("time")
    return copy.select("page_id", "url", "html", twice).drop("time")
