"""Removal of repeated byte strings across documents, by suffix arrays over partitioned contexts.

A byte goes where a string of `LENGTH` bytes that covers it also starts in a document of a smaller id. Each such string
(window) has one anchor, the k-mer of the least hash in it, so equal windows have equal anchors. The windows of a
document that have one anchor are a run, and the bytes they cover are the run's context.

1. Of equal texts only those of the smallest id go on; the others are repeated as a whole.
2. A window has its anchor and at least SIDE bytes before it, or that many and one more behind it. Hashes of these halves
   tell which runs, or parts of them, may stand in two documents: those of two texts are kept as a filter, which lets a few
   others through and loses none. What is left of their contexts is dealt by anchor. Equal contexts are one: what does not
   stand in the smallest of their documents is repeated as a whole. Documents of a task are compared before anything is sent.
3. Different contexts of an anchor are cut to the windows whose hashes stand in contexts of two documents, and laid end to
   end. Their suffix array, built in linear time by grouping, brings equal windows together; windows that also stand in a
   smaller document are repeated. What the cut leaves out equals no window of another document.
4. The repeated runs of each text are joined to it and cut out.

Cases: null and empty texts have no bytes. A null id counts as larger than all others. Rows of one id don't remove
anything from each other. Repeated rows each get a row, with equal results. An empty table gives an empty result. Other
columns are ignored. Contexts of one anchor meet in one task, after equal ones are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Piece, kept, mixed, pieces, prefix_hash, span_hash
from tallymark.llm.shared_hashes import SENT, blobs, filters, lot, passing
from tallymark.llm.suffix_array import suffix_array

LENGTH, KMER = 50, 16
#: Windows per k-mer position in a window.
WIDE = LENGTH - KMER + 1
#: Bytes of a window besides its anchor that are not more than those before it and those behind it together.
SIDE = (LENGTH - KMER) // 2
#: The least bits of the filter of shared halves.
FILTER_BITS = 1 << 24
#: Hashes of halves that a task gathers before it sends them.
LOT = 1 << 21
#: Symbols of contexts in one suffix array; the contexts of an anchor are not parted.
STRING = 1 << 13
#: Context bytes that a task gathers before it compares and sends them, and whose windows are hashed at once.
GATHER, HASHED = 6 << 20, 1 << 18
#: Text bytes whose runs are found at once: eight bytes for each of them stay near the processor.
RUNS = 1 << 18

_LOW = np.uint64((1 << 26) - 1)
_LAST = (1 << 63) - 1


def runs(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, anchor position) of each run; positions in the piece's bytes."""
    data, n = piece.data, len(piece.data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none
    sums = prefix_hash(data)
    at = np.arange(n - KMER + 1)
    low = (span_hash(sums, at, at + KMER) & ~_LOW) | (at.astype(np.uint64) & _LOW)
    width = 1
    while 2 * width <= WIDE:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (WIDE - width)], low[WIDE - width :])
    window = np.arange(len(low))
    anchor = window + ((low & _LOW).astype(np.int64) - window) % (int(_LOW) + 1)
    sizes = np.diff(piece.bounds)
    owner = np.repeat(np.arange(len(piece)), sizes)[: len(low)]
    whole = window + LENGTH <= np.repeat(piece.bounds[1:], sizes)[: len(low)]
    new = np.ones(len(low), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(low)))
    good = whole[first]
    first, count = first[good], count[good]
    return owner[first], first, count, anchor[first]


def _anchor_hash(sums: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    return mixed(span_hash(sums, anchors, anchors + KMER) + np.uint64(1))


def _halves(sums: np.ndarray, first: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(runs, hashes) of the anchor with SIDE bytes before it, for runs with windows that begin there or before, and of the
    anchor with the bytes behind it that all windows that begin later have."""
    before = np.flatnonzero(first <= anchor - SIDE)
    behind = np.flatnonzero(first + count > anchor - SIDE + 1)
    end = anchor[behind] - SIDE + 1 + LENGTH
    return [
        (before, mixed(span_hash(sums, anchor[before] - SIDE, anchor[before] + KMER) + np.uint64(2))),
        (behind, mixed(span_hash(sums, anchor[behind], end) + np.uint64(3))),
    ]


def _without(batches: Iterator[pa.RecordBatch], copies) -> Iterator[pa.RecordBatch]:
    """The rows whose keys are not among the sorted ones that were broadcast."""
    for batch in batches:
        if copies is not None and len(copies.value) and batch.num_rows:
            keys = batch.column(batch.schema.get_field_index("key")).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(copies.value, keys), len(copies.value) - 1)
            batch = batch.filter(pa.array(copies.value[at] != keys))
        yield batch


def _shared(deal: int, copies):
    """Lots of the halves' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, owners, held, base = [], [], 0, 0
        for piece in pieces(_without(batches, copies), limit=RUNS):
            owner, first, count, anchor = runs(piece)
            if len(first):
                for those, hashes in _halves(prefix_hash(piece.data), first, count, anchor):
                    found.append(hashes)
                    owners.append((owner[those] + base).astype(np.int32))
                    held += len(those)
            base += len(piece)
            if held >= LOT:
                yield lot(np.concatenate(found), np.concatenate(owners), deal)
                found, owners, held = [], [], 0
        if held:
            yield lot(np.concatenate(found), np.concatenate(owners), deal)

    return run


def _contexts(deal: int, sieve, copies=None):
    """Rows of contexts by part, and of runs that a smaller document of the same task repeats whole."""

    def flush(held: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        c = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
        order = np.lexsort((c["doc"], c["context"], c["anchor"]))
        c = {k: v[order] for k, v in c.items() if k != "bytes"} | {"bytes": c["bytes"], "from": (np.cumsum(c["length"], dtype=np.int64) - c["length"])[order]}
        same = np.concatenate([[False], (c["anchor"][1:] == c["anchor"][:-1]) & (c["context"][1:] == c["context"][:-1])])
        cuts = np.flatnonzero(~same)
        lowest = np.repeat(c["doc"][cuts], np.diff(np.append(cuts, len(same))))
        repeated = c["doc"] > lowest
        # Rows of the same text are one.
        again = same.copy()
        again[1:] &= (c["key"][1:] == c["key"][:-1]) & (c["start"][1:] == c["start"][:-1])
        names = ["part", "anchor", "doc", "key", "start", "shift", "length", "bytes"]
        if repeated.any():
            at = np.flatnonzero(repeated & ~again)
            key, start, count = c["key"][at], c["start"][at], c["length"][at].astype(np.int64) - LENGTH + 1
            order = np.lexsort((start, key))
            key, start, count = key[order], start[order], count[order]
            # Runs that touch are one.
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (start[1:] != start[:-1] + count[:-1])])
            cuts = np.flatnonzero(new)
            ranges = (start[cuts].astype(np.int64) << 32) | np.add.reduceat(count, cuts)
            batch = blobs(key[cuts].astype(np.uint64) % np.uint64(deal), {"key": key[cuts], "start": ranges})
            columns = [batch.column(0)] + [
                batch.column(batch.schema.get_field_index(n)) if n in ("key", "start") else pa.array([b""] * batch.num_rows, pa.binary())
                for n in names[1:]
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
        at = np.flatnonzero(~repeated & ~again)
        part = (c["anchor"][at] % np.uint64(deal)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        at, part = at[order], part[order]
        length = c["length"][at].astype(np.int64)
        place = np.repeat(c["from"][at] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        laid = c["bytes"][place]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(cuts[1:], len(part))
        byte_ends = np.concatenate([[0], np.cumsum(length)])
        arrays = [pa.array(part[cuts])]
        for name, kind in (("anchor", np.uint64), ("doc", np.int64), ("key", np.int64), ("start", np.int32), ("shift", np.uint8), ("length", np.uint8)):
            v = c[name][at].astype(kind)
            arrays.append(pa.array([v[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()))
        arrays.append(pa.array([laid[byte_ends[a] : byte_ends[b]].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()))
        yield pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(_without(batches, copies), limit=RUNS):
            owner, first, count, anchor = runs(piece)
            if not len(first):
                continue
            sums = prefix_hash(piece.data)
            shared = np.zeros((2, len(first)), bool)
            for side, (those, hashes) in zip(shared, _halves(sums, first, count, anchor), strict=True):
                side[those] = passing(hashes, sieve.value, deal)
            end = np.where(shared[1], first + count, np.minimum(first + count, anchor - SIDE + 1))
            first = np.where(shared[0], first, np.maximum(first, anchor - SIDE + 1))
            good = np.flatnonzero(shared.any(0))
            if not len(good):
                continue
            owner, first, count, anchor = owner[good], first[good], (end - first)[good], anchor[good]
            h = _anchor_hash(sums, anchor)
            length = count + LENGTH - 1
            place = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
            doc = piece.column("doc_id").to_numpy(zero_copy_only=False)[owner]
            held.append(
                {
                    "anchor": h & ~np.uint64(1),
                    "context": mixed(span_hash(sums, first, first + length) + (anchor - first).astype(np.uint64)),
                    "doc": doc,
                    "key": piece.column("key").to_numpy(zero_copy_only=False)[owner],
                    "start": (first - piece.bounds[owner]).astype(np.int32),
                    "shift": (anchor - first).astype(np.uint8),
                    "length": length.astype(np.uint8),
                    "bytes": piece.data[place],
                }
            )
            size += len(place)
            if size >= GATHER:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return run


def shared_windows(data: np.ndarray, lengths: np.ndarray, anchors: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For all windows of contexts that lie end to end, whether the window's hash stands in contexts of one anchor and
    two documents. Equal windows have equal hashes, so none that stands in two documents is missed."""
    owner = np.repeat(np.arange(len(lengths)), lengths - LENGTH + 1)
    at = np.arange(len(owner)) + owner * (LENGTH - 1)
    hashes = mixed(span_hash(prefix_hash(data), at, at + LENGTH) + mixed(anchors.astype(np.uint64))[owner])
    order = np.argsort(hashes)
    hashes, docs = hashes[order], docs[owner[order]]
    cuts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    two = np.minimum.reduceat(docs, cuts) < np.maximum.reduceat(docs, cuts)
    found = np.zeros(len(order), bool)
    found[order] = np.repeat(two, np.diff(np.append(cuts, len(order))))
    return found


def repeated_windows(contexts: list[np.ndarray], shifts: list[int], anchors: list[int], docs: np.ndarray) -> list[np.ndarray]:
    """For each context, which of its windows also stand in a context of a smaller document.

    `shifts` is where the anchor stands in each context, `anchors` its number. As every window holds the anchor, the
    anchor's bytes are one symbol of their own, and a window is WIDE symbols long.
    """
    starts = np.cumsum([0, *[len(c) - KMER + 2 for c in contexts]])[:-1]
    text = np.ones(int(starts[-1]) + len(contexts[-1]) - KMER + 2, np.int32)
    which = np.zeros(len(text), np.int64)
    room = np.zeros(len(text), np.int64)
    for i, (s, c, x) in enumerate(zip(starts, contexts, shifts, strict=True)):
        n = len(c) - KMER + 1
        text[s : s + x] = c[:x].astype(np.int32) + 2
        text[s + x + 1 : s + n] = c[x + KMER :].astype(np.int32) + 2
        text[s + x] = 300 + anchors[i]
        which[s : s + n] = i
        room[s : s + n] = n - np.arange(n)
    order = np.array(suffix_array(text.tolist()), np.int64)
    order = order[room[order] >= WIDE]
    rows = text[order[:, None] + np.arange(WIDE)]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])
    cuts = np.flatnonzero(new)
    lowest = np.minimum.reduceat(docs[which[order]], cuts)
    found = docs[which[order]] > np.repeat(lowest, np.diff(np.append(cuts, len(order))))
    flags = [np.zeros(len(c) - LENGTH + 1, bool) for c in contexts]
    for p in order[found]:
        flags[which[p]][p - starts[which[p]]] = True
    return flags


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2] - edges[::2]


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, range): runs of repeated windows, start and count in one number."""
    names = {"anchor": np.uint64, "doc": np.int64, "key": np.int64, "start": np.int32, "shift": np.uint8, "length": np.uint8, "bytes": np.uint8}
    held: dict[str, list[bytes]] = {k: [] for k in names}
    for batch in batches:
        rows = {k: batch.column(batch.schema.get_field_index(k)).to_pylist() for k in names}
        for i in range(batch.num_rows):
            if not rows["anchor"][i]:
                keys, ranges = (np.frombuffer(rows[k][i], np.int64) for k in ("key", "start"))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ranges)], ["key", "range"])
                continue
            for k in names:
                held[k].append(rows[k][i])
    if not held["anchor"]:
        return
    c = {k: np.frombuffer(b"".join(held.pop(k)), kind) for k, kind in names.items()}
    begin = np.cumsum(c["length"], dtype=np.int64) - c["length"]
    context = np.zeros(len(begin), np.uint64)
    for a in range(0, len(begin), 8192):
        some = slice(a, a + 8192)
        at = begin[some] - begin[a]
        sums = prefix_hash(c["bytes"][begin[a] : begin[a] + int(c["length"][some].sum(dtype=np.int64))])
        context[some] = span_hash(sums, at, at + c["length"][some])
    context = mixed(context + c["shift"].astype(np.uint64))
    order = np.lexsort((c["doc"], context, c["anchor"]))
    anchor, context, doc = c["anchor"][order], context[order], c["doc"][order]
    new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    new = new_anchor | np.concatenate([[True], context[1:] != context[:-1]])
    cuts = np.flatnonzero(new)
    one = np.cumsum(new) - 1
    lowest = doc[cuts]
    count = c["length"][order].astype(np.int64) - LENGTH + 1
    whole = doc > lowest[one]
    keys, ranges = [c["key"][order[whole]]], [(c["start"][order[whole]].astype(np.int64) << 32) | count[whole]]
    # Anchors with several contexts, a few at a time.
    members = np.flatnonzero(~whole)
    group = np.cumsum(new_anchor)[cuts]
    first_of = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    last_of = np.append(first_of[1:], len(group))
    owners_at = np.searchsorted(one[members], np.arange(len(cuts) + 1))
    at, size, shift = begin[order[cuts]], c["length"][order[cuts]].astype(np.int64), c["shift"][order[cuts]].astype(np.int64)

    def settle(block: list[tuple[int, int, int]]) -> None:
        texts = [c["bytes"][at[x] + a : at[x] + b + LENGTH] for x, a, b in block]
        those = np.array([x for x, _, _ in block])
        shifts = [int(shift[x]) - a for x, a, _ in block]
        numbers = (group[those] - group[those[0]]).tolist()
        for (x, a, _), flags in zip(block, repeated_windows(texts, shifts, numbers, lowest[those]), strict=True):
            starts, counts = _ranges(flags)
            if len(starts):
                for m in members[owners_at[x] : owners_at[x + 1]]:
                    keys.append(np.full(len(starts), c["key"][order[m]]))
                    ranges.append((starts + a + int(c["start"][order[m]])) << 32 | counts)

    several = np.minimum.reduceat(lowest, first_of) < np.maximum.reduceat(lowest, first_of)
    first_of, last_of, total = first_of[several], last_of[several], np.add.reduceat(size, first_of)[several]
    batch = (np.cumsum(total) - total) // HASHED
    for some in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(batch)) + 1) if len(batch) else []:
        those = np.concatenate([np.arange(first_of[g], last_of[g]) for g in some])
        lengths, windows = size[those], size[those] - LENGTH + 1
        place = np.repeat(at[those] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        shared = np.flatnonzero(shared_windows(c["bytes"][place], lengths, group[those], lowest[those]))
        ends = np.cumsum(windows)
        low, high = np.searchsorted(shared, ends - windows), np.searchsorted(shared, ends)
        block, symbols, current = [], 0, -1
        for i in np.flatnonzero(low < high).tolist():
            if group[those[i]] != current and symbols >= STRING:
                settle(block)
                block, symbols = [], 0
            current = group[those[i]]
            before = int(ends[i] - windows[i])
            block.append((int(those[i]), int(shared[low[i]]) - before, int(shared[high[i] - 1]) - before))
            symbols += block[-1][2] - block[-1][1] + WIDE
        if block:
            settle(block)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ranges))], ["key", "range"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        ranges = piece.column("ranges").to_pylist()
        rows = []
        for i, found in enumerate(ranges):
            data = np.frombuffer(piece.text(i), np.uint8)
            if found:
                r = np.array(found, np.int64)
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, r >> 32, 1)
                np.add.at(change, (r >> 32) + (r & 0xFFFFFFFF) + LENGTH - 1, -1)
                gone = np.cumsum(change)[:-1] > 0
                spans = len(_ranges(gone)[0])
                left = data[~gone].tobytes()
                rows.append((len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), left))
            else:
                rows.append((len(data), 0, 0, hashlib.sha256(data.tobytes()).hexdigest(), data.tobytes()))
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), *[pa.array(v, k) for v, k in zip(columns, kinds, strict=True)]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def equal_texts(rows: DataFrame) -> DataFrame:
    """(key, range): the texts of at least one window that also stand in a document of a smaller id, with all their windows."""
    n = F.octet_length("text").cast("long").alias("n")
    each = rows.where(F.octet_length("text") >= LENGTH).select("key", "doc_id", n, F.xxhash64("text").alias("one"), F.xxhash64(F.lit(1), "text").alias("two"))
    each = kept(each.distinct(), "texts")
    least = each.groupBy("one", "two", "n").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most")
    again = each.join(least, ["one", "two", "n"]).where("doc_id > least")
    return kept(again.select("key", (F.col("n") - (LENGTH - 1)).alias("range")), "equal-texts")


def shared_filter(rows: DataFrame, deal: int, copies=None) -> bytes:
    """The filter of the halves that two texts have; `copies` is the broadcast of the keys that are left out."""
    sent = rows.select("doc_id", "text", "key").mapInArrow(_shared(deal, copies), SENT)
    return filters(sent, deal, least=FILTER_BITS)[0]


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes), a row per document row."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    equal = equal_texts(rows)
    copies = spark.sparkContext.broadcast(np.sort(equal.select("key").toArrow().column(0).to_numpy()))
    sieve = spark.sparkContext.broadcast(shared_filter(rows, 4 * n, copies))
    kinds = ", ".join(f"{k} binary" for k in ("anchor", "doc", "key", "start", "shift", "length", "bytes"))
    sent = rows.mapInArrow(_contexts(4 * n, sieve, copies), f"part long, {kinds}").repartition(4 * n, "part")
    found = kept(sent.mapInArrow(_repeats, "key long, range long").unionAll(equal), "repeats")
    per = found.groupBy("key").agg(F.collect_list("range").alias("ranges"))
    joined = rows.join(per, "key", "left").select("doc_id", "text", "ranges")
    out = joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") < _LAST, F.col("doc_id")))
