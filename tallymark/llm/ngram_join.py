"""N-gram Jaccard self-join by shared elements and parity sketches.

A document is the set of hashes of its word n-grams. Equal sets are one node. All sets are put in one order of elements,
rarest first, and a set's keys are the first elements of it: as many as leave too few behind for the overlap that a
similarity of p percent asks for, so that the first element which two similar sets share is a key of both. The order needs
no exact counts, only the same ones for all sets: part of the elements are counted, and filters tell those of one text,
which come first and need not be sent, and those of many texts, which come last. A set that has enough elements of its own
has no keys. Layouts belong to bands of sizes: a node has keys in its own band and in those its larger partners may lie in.

Nodes that share keys of a band are families, so their sizes are alike, and a node has one family per band at most. A
family is compared in tiles of bounded size, by whole sketches; what these can't tell apart are closer families, which
are compared in tiles by the sets themselves. A whole sketch toggles one bit per element, so two sketches differ in at
most as many bits as the sets differ in elements. A tile hands on a spanning forest of its links, never all pairs. Links of
all tiles join to components.

Cases: null or word-less texts have an empty set, link with nothing and are components of their own. Texts of fewer
words than n are one element. Rows without an id bring no
links of their own; they get the component of an equal set that has an id, or null. Repeated
rows each get a row. An empty table gives an empty result. Other columns are ignored, and handed through by `distinct_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Piece, kept, lower_ascii, mixed, pieces, prefix_hash, small_batches, span_hash, texts, word_spans
from tallymark.llm.graph import components
from tallymark.llm.shared_hashes import SENT, filters, lot, passing

#: Ratio of a band's largest to its smallest size.
BAND = 1.2
#: Nodes per side of a tile of sets, and of sketches, which take about a twentieth of the bytes. A family's nodes are
#: copied once per side, so larger sides shuffle less.
TILE, SKETCH_TILE = 512, 8192
#: Text bytes that a task works on at once.
BYTES = 1 << 18
#: Numbers (keys and their nodes, or counted elements) that a task gathers before it hands them on.
FLUSH = 1 << 20
#: Lots of keys that a task sorts one by one, and pairs of nodes that it joins at once.
SLOTS, PAIRS = 16, 1 << 14
#: Elements that are counted, in sixteenths: a lone set's must outnumber the elements that similar sets may differ in.
COUNTED = 40

_ODD = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(piece: Piece, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    data = lower_ascii(piece.data)
    starts, ends, first = word_spans(data, piece.bounds)
    words = span_hash(prefix_hash(data), starts, ends)
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for j in range(n):
        grams += words[j : j + len(grams)] * _ODD[j]
    grams = mixed(grams)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            values = np.sort(grams[a : b - n + 1])
            yield values[np.concatenate([[True], values[1:] != values[:-1]])]
        elif b > a:
            yield mixed(np.sum(words[a:b] * _ODD[: b - a], keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def set_node(values: np.ndarray) -> np.int64:
    """A hash of the whole set."""
    return mixed(np.sum(mixed(values + np.uint64(len(values))), keepdims=True)).astype(np.int64)[0]


@cache
def _bands() -> np.ndarray:
    """Smallest size of each band."""
    lows = [1]
    while lows[-1] < 1 << 40:
        lows.append(max(lows[-1] + 1, int(lows[-1] * BAND)))
    return np.array(lows)


def sketch(values: np.ndarray, blocks: int, layout: int) -> np.ndarray:
    """`blocks` words of 64 parity bits."""
    spread = mixed(values + np.uint64(layout))
    bit = (spread % np.uint64(blocks * 64)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=blocks * 64).astype(np.uint8) & 1, bitorder="little").view(np.uint64)


def in_band(nodes, band: int):
    """What a node is called among the nodes of a band: a family holds nodes of one band only."""
    return nodes ^ mixed(np.array([band], np.uint64) + np.uint64(1)).view(np.int64)[0]


def counted(values: np.ndarray, percent: int) -> np.ndarray:
    """Which elements are counted."""
    return values & np.uint64(15) < np.uint64(min(16, -(-COUNTED * (100 - percent) // 100)))


def ranked(values: np.ndarray, percent: int, sieves: tuple[bytes, bytes] | None, deal: int) -> np.ndarray:
    """The place of each element in the order of all: 0 if only one text has it, then 1; 2 not counted; 3 in many texts."""
    ranks = np.full(len(values), 2, np.uint8)
    if sieves is not None:
        those = np.flatnonzero(counted(values, percent))
        shared, frequent = (passing(values[those], x, deal) for x in sieves)
        ranks[those] = np.where(shared, np.where(frequent, 3, 1), 0)
    return ranks


def banded_keys(values: np.ndarray, percent: int, ranks: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Per band, keys of which two sets of the similarity have at least one in common in the larger one's band, unless
    they are equal. `values` are sorted."""
    lows = _bands()
    n, own, ordered = len(values), 0, values
    if ranks is not None:
        own = int((ranks == 0).sum())
        ordered = np.concatenate([values[ranks == r] for r in (1, 2, 3)])
    first = int(np.searchsorted(lows, n, "right")) - 1
    for band in range(first, int(np.searchsorted(lows, n * 100 // percent, "right"))):
        if band == first:
            least = -(-percent * n // 100)
        else:
            least = -(-percent * (n + int(lows[band])) // (100 + percent))
        found = ordered[: max(0, n - least + 1 - own)]
        if len(found):
            yield band, mixed(found + mixed(np.array([band], np.uint64) + np.uint64(1)))


def keys(values: np.ndarray, percent: int) -> np.ndarray:
    """The keys of all bands."""
    return np.concatenate([np.zeros(0, np.uint64), *[k for _, k in banded_keys(values, percent)]])


def whole_sketch(values: np.ndarray) -> np.ndarray:
    """A sketch of four to eight bits per element, a power of two of words. Its halves XORed are that of half the size."""
    return sketch(values, 1 << max(0, (4 * len(values) - 1).bit_length() - 6), 0)


def _nodes(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=BYTES):
            rows = [(len(v), set_node(v), whole_sketch(v).tobytes()) for v in shingle_sets(piece, n)]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], ["doc_id", "n_shingles", "node", "elements"])

    return run


def _counted_rows(n: int, percent: int, deal: int):
    """Lots of the counted elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for piece in pieces(batches, limit=BYTES):
            v = np.concatenate([np.zeros(0, np.uint64), *shingle_sets(piece, n)])
            found.append(v[counted(v, percent)])
            held += len(found[-1])
            if held >= FLUSH:
                yield lot(np.concatenate(found), None, deal)
                found, held = [], 0
        if held:
            yield lot(np.concatenate(found), None, deal)

    return run


PACKED = ("keys", "nodes", "counts")


def _key_rows(n: int, percent: int, deal: int, sieves=None):
    """Rows (part, keys, nodes, counts): the keys of a part, 48 bits each besides those that the part tells, and each
    node once with the number of its keys there. `sieves` is the broadcast of both filters."""

    def flush(key_list: list[np.ndarray], node_list: list[np.int64]) -> pa.RecordBatch:
        v = np.repeat(np.array(node_list, np.int64), [len(x) for x in key_list])
        k = np.concatenate(key_list)
        key_list.clear()
        part = (k % np.uint64(deal)).astype(np.uint16 if deal <= 1 << 16 else np.int64)
        order = np.argsort(part, kind="stable")
        k, v, part = k[order] // np.uint64(deal), v[order], part[order]
        del order
        short = k.view(np.uint8).reshape(-1, 8)[:, :6]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        arrays: list[list[bytes]] = [[], [], []]
        for a, b in zip(cuts, np.append(cuts[1:], len(k)), strict=True):
            runs = a + np.flatnonzero(np.concatenate([[True], v[a + 1 : b] != v[a : b - 1]]))
            arrays[0].append(short[a:b].tobytes())
            arrays[1].append(v[runs].tobytes())
            arrays[2].append(np.diff(np.append(runs, b)).astype(np.uint32).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(part[cuts], pa.int64()), *[pa.array(x, pa.binary()) for x in arrays]], ["part", *PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_list, node_list, held = [], [], 0
        for piece in pieces(batches, limit=BYTES):
            sets = list(shingle_sets(piece, n))
            whole = np.concatenate([np.zeros(0, np.uint64), *sets])
            ends = np.cumsum([len(values) for values in sets])
            ranks = np.split(ranked(whole, percent, sieves and sieves.value, deal), ends[:-1])
            for values, places in zip(sets, ranks, strict=True):
                for band, found in banded_keys(values, percent, places) if len(values) else ():
                    key_list.append(found)
                    node_list.append(in_band(set_node(values), band))
                    held += 2 * len(found)
            if held >= FLUSH:
                yield flush(key_list, node_list)
                key_list, node_list, held = [], [], 0
        if held:
            yield flush(key_list, node_list)

    return run


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The keys of packed rows and their nodes."""
    short, nodes, counts = (batch.column(c).to_pylist() for c in PACKED)
    sizes = [len(raw) // 6 for raw in short]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(short), np.uint8).reshape(-1, 6)
    part = (batch.column("part").to_numpy().astype(np.uint64) & np.uint64(0xFFFF)) << np.uint64(48)
    k = wide.view(np.uint64).ravel() | np.repeat(part, sizes)
    return k, np.repeat(np.frombuffer(b"".join(nodes), np.int64), np.frombuffer(b"".join(counts), np.uint32))


def _led(k: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a node and the smallest one that it shares a key with."""
    order = np.argsort(k)
    k, v = k[order], v[order]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    leader = np.minimum.reduceat(v, np.flatnonzero(new))[np.cumsum(new) - 1]
    other = v != leader
    a, b = v[other], leader[other]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node that shares keys here with the smallest node that it is joined with by them, without the keys."""
    slots: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(SLOTS)]
    for batch in batches:
        k, v = _unpacked(batch)
        slot = (k % np.uint64(SLOTS)).astype(np.uint8)
        order = np.argsort(slot, kind="stable")
        cuts = np.searchsorted(slot[order], np.arange(SLOTS + 1))
        k, v = k[order], v[order]
        for held, low, high in zip(slots, cuts[:-1], cuts[1:], strict=True):
            if low < high:
                held.append((k[low:high].copy(), v[low:high].copy()))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while slots:
        if held := slots.pop():
            found.append(_led(*(np.concatenate(x) for x in zip(*held, strict=True))))
    if not found:
        return
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    del found
    if len(a):
        # A node's leaders may have each other's nodes: each goes to the smallest node it is joined with here.
        nodes = np.unique(np.concatenate([np.unique(a), np.unique(b)]))
        pairs = np.searchsorted(nodes, a) * len(nodes)
        pairs += np.searchsorted(nodes, b)
        del a, b
        pairs = np.unique(pairs)
        forest = _Forest(len(nodes))
        for at in range(0, len(pairs), PAIRS):
            i, j = np.divmod(pairs[at : at + PAIRS], len(nodes))
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                forest.join(x, y)
        roots = np.array([forest.find(i) for i in range(len(nodes))])
        other = roots != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[roots[other]])], ["a", "b"])


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def tile_links(nodes: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between nodes of different sides (of all pairs, if there is one side)."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    blocks = max(1, int(sizes.max()) // 16)
    sketches = np.stack([sketch(s, blocks, 0) for s in sets])
    forest, links = _Forest(len(sets)), []
    one_side = len(np.unique(sides)) == 1
    for at, i in enumerate(order):
        top = np.searchsorted(sizes[order], sizes[i] * 100 // percent, "right")
        rest = order[at + 1 : top]
        if not one_side:
            rest = rest[sides[rest] != sides[i]]
        if not len(rest):
            continue
        apart = np.bitwise_count(sketches[rest] ^ sketches[i]).sum(1, dtype=np.int64)
        rest = rest[(100 + percent) * apart <= (100 - percent) * (sizes[rest] + sizes[i])]
        for j in rest:
            if forest.find(i) == forest.find(j):
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                forest.join(i, j)
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def sketch_links(nodes: np.ndarray, sketches: list[np.ndarray], sizes: np.ndarray, sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that sketches and sizes can't rule out."""
    order = np.argsort(sizes, kind="stable")
    words = np.array([len(s) for s in sketches])
    # Partners have as many words or twice as many; only these have rows beside a node's width.
    folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for width in np.unique(words):
        those = np.flatnonzero((words == width) | (words == 2 * width))
        rows, place = np.zeros((len(those), width), np.uint64), np.zeros(len(nodes), np.int64)
        place[those] = np.arange(len(those))
        for row, i in zip(rows, those, strict=True):
            row[:] = sketches[i] if words[i] == width else sketches[i][:width] ^ sketches[i][width:]
        folded[width] = place, rows
    forest, links = _Forest(len(nodes)), []
    one_side = len(np.unique(sides)) == 1
    ranked = sizes[order]
    for at, i in enumerate(order):
        rest = order[at + 1 : np.searchsorted(ranked, sizes[i] * 100 // percent, "right")]
        if not one_side:
            rest = rest[sides[rest] != sides[i]]
        if len(rest):
            place, rows = folded[words[i]]
            apart = np.bitwise_count(rows[place[rest]] ^ rows[place[i]]).sum(1, dtype=np.int64)
            for j in rest[(100 + percent) * apart <= (100 - percent) * (sizes[rest] + sizes[i])]:
                if forest.join(i, j):
                    links.append((int(nodes[i]), int(nodes[j])))
    return links


def _banded(percent: int):
    """Rows (node, id) for the names of a node in its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = _bands()
        for batch in batches:
            node, n = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("node", "n_shingles"))
            first, last = np.searchsorted(lows, n, "right") - 1, np.searchsorted(lows, n * 100 // percent, "right")
            for step in range(int((last - first).max(initial=0))):
                those = first + step < last
                names = node[those] ^ mixed((first[those] + step).astype(np.uint64) + np.uint64(1)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node[those]), pa.array(names)], ["node", "id"])

    return run


def _tiles(percent: int, whole: bool):
    """Links of each tile, from sets or (with their sizes) from whole sketches."""

    def done(nodes, sets, sides, sizes) -> Iterator[tuple[int, int]]:
        unique = np.unique(np.array(nodes, np.int64), return_index=True)[1]
        if len(unique) > 1:
            parts = np.array(nodes)[unique], [sets[i] for i in unique], np.array(sides)[unique]
            if whole:
                yield from tile_links(*parts, percent)
            else:
                yield from sketch_links(*parts[:2], np.array(sizes)[unique], parts[2], percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, nodes, sets, sides, sizes, links = None, [], [], [], [], []
        for batch in batches:
            tile, node, side, size, blob = (batch.column(batch.schema.get_field_index(c)) for c in ("tile", "node", "side", "n_shingles", "elements"))
            for t, v, s, k, raw in zip(tile.to_pylist(), node.to_pylist(), side.to_pylist(), size.to_pylist(), blob, strict=True):
                if t != current:
                    links += done(nodes, sets, sides, sizes)
                    current, nodes, sets, sides, sizes = t, [], [], [], []
                nodes.append(v)
                sides.append(s)
                sizes.append(k)
                sets.append(np.frombuffer(raw.as_buffer(), np.uint64))
        links += done(nodes, sets, sides, sizes)
        if links:
            a, b = zip(*links, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _elements(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=BYTES):
            # An id may stand for several texts: only the node's own text counts.
            wanted = piece.column("node").to_pylist()
            own = [(i, v.tobytes()) for i, v in enumerate(shingle_sets(piece, n)) if len(v) and set_node(v) == wanted[i]]
            batch = piece.batch.take(pa.array([i for i, _ in own], pa.int64()))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("node", "family", "parts")]
            sizes = pa.array([len(b) // 8 for _, b in own], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, sizes, pa.array([b for _, b in own], pa.binary())], ["node", "family", "parts", "n_shingles", "elements"]
            )

    return run


def _members(pairs: DataFrame, tile: int) -> DataFrame:
    """node, family, parts: the families of some pairs and the number of sides their tiles have."""
    families = components(pairs)
    large = kept(families.groupBy("root").agg(F.ceil(F.count("*") / tile).alias("parts")).where("parts > 1"), "large-families")
    return families.join(large, "root", "left").select("node", F.col("root").alias("family"), F.coalesce("parts", F.lit(1)).alias("parts"))


def _linked(rows: DataFrame, percent: int, whole: bool, deal: int) -> DataFrame:
    """Links of rows (node, family, parts, n_shingles, elements), compared side by side in tiles."""
    side = F.pmod(F.xxhash64("node"), F.col("parts"))
    tiles = rows.withColumn("side", side).withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
    tile = F.xxhash64("family", F.least("side", "other"), F.greatest("side", "other"))
    tiles = tiles.select(tile.alias("tile"), "node", "side", "n_shingles", "elements").repartition(deal, "tile").sortWithinPartitions("tile")
    return kept(tiles.mapInArrow(_tiles(percent, whole), "a long, b long"), "links")


def near_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, a row per document row."""
    with small_batches(docs.sparkSession):
        return _near_components(docs, n, percent)


def _near_components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    deal = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = texts(docs)
    rows = kept(source.mapInArrow(_nodes(n), "doc_id long, n_shingles long, node long, elements binary"), "shingle-nodes")
    classes = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    sieves = spark.sparkContext.broadcast(tuple(filters(source.mapInArrow(_counted_rows(n, percent, deal), SENT), deal, frequent=True)))
    packed = source.mapInArrow(_key_rows(n, percent, deal, sieves), "part long, keys binary, nodes binary, counts binary")
    stars = packed.repartition(deal, "part").mapInArrow(_stars, "a long, b long")
    # Joins of one kind at every size, so that what is shuffled grows with the input and not by steps.
    nonempty = rows.where("n_shingles > 0")
    names = nonempty.select("node", "n_shingles").distinct().mapInArrow(_banded(percent), "node long, id long")
    members = names.join(_members(stars, SKETCH_TILE).withColumnRenamed("node", "id").hint("merge"), "id").drop("id")
    sketches = nonempty.select("node", "n_shingles", "elements").join(members.hint("merge"), "node").dropDuplicates(["node", "family"])
    closer = _linked(sketches, percent, False, deal)
    # One text per node of a closer family, by the node's first id.
    ids = kept(classes.join(_members(closer, TILE), "node").where("first_id is not null"), "family-nodes")
    sets = source.join(ids.hint("merge"), source["doc_id"] == ids["first_id"]).select("text", "node", "family", "parts")
    sets = sets.mapInArrow(_elements(n), "node long, family long, parts long, n_shingles long, elements binary")
    roots = components(_linked(sets, percent, True, deal))
    groups = classes.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    groups = kept(groups, "near-classes")
    least = groups.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = kept(groups.join(least, "root").select("node", "component_id"), "near-components")
    # Rows without a set have a key of their own, so that they don't meet in one task.
    key = F.when(F.col("n_shingles") > 0, F.col("node")).otherwise(F.xxhash64("doc_id"))
    out = rows.withColumn("node", key).join(found, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def distinct_documents(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that of the smallest id, with all columns; rows without an id stay."""
    found = kept(near_components(docs, n, percent), "near-found")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    repeated = kept(found.groupBy("doc_id").count().where("count > 1 AND doc_id is not null").select("doc_id"), "repeated-ids")
    left = docs.join(kept(gone, "near-gone"), "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return left
    once = left.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    return once.unionAll(left.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"]))
