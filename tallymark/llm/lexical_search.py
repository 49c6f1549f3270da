"""Ranked lexical search: best-first over document intervals, bounded by range-maximum tables of posting lists.

`build` writes an inverted index. Documents are dealt to shards of `SHARD` bytes of text; a shard numbers its documents by
id and holds one row per term, with the numbers of the documents that hold it and its occurrences there, and one row with
the ids and lengths. All documents and all their terms are in it.

`search` takes from the index the posting lists of the asked terms. A task that searches a shard puts the lists one after
the other, turns occurrences into impacts (a term's share of a document's score), and lays sparse tables over them: entry
i of level k is the largest impact among the 2 ** k postings from i on, so two entries answer any range. An interval of
documents is a range in each of an item's lists, and the sum of the ranges' maxima bounds every score in it. The intervals
with the highest bounds go first: the document with the largest impact of the range is scored, and splits the interval
into what lies before and behind it, each with its own, lower bound. Intervals of at most `LEAF` postings are scored whole.
What can't beat the item's k-th best is dropped. That k-th best is kept from shard to shard of a task, so later shards
prune more. Equal impacts are told apart by a random permutation, so copies split an interval in halves, not one by one.

Items go in blocks of `ITEMS`, dealt with the shards by key; nothing is broadcast or collected but the two sums of the
collection. A term of all documents is one row per shard, so no key holds more than a shard. Scores are exact integers.

Cases: null and empty texts and those without a term have no terms, and count neither as documents nor as results; an
item without terms has no results. Equal scores rank by id, a null id last; repeated rows are documents of their own.
Item rows with one id are one item. Very long texts are cut at term borders while terms are counted, so that memory is
that of a piece and the terms found. Empty tables give an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import LETTERS, PIECE, Piece, kept, lower_ascii, pieces, prefix_hash, span_hash, texts, word_spans

#: Text bytes of a shard, postings of an interval that is scored whole, intervals split at once, items of a block.
SHARD, LEAF, BEST, ITEMS = 16 << 20, 96, 32, 4096
#: Bits of a table entry below the impact: the posting's number in a random permutation.
PLACE = 28
INDEX = "shard long, term string, docs array<long>, counts array<int>"
HITS = "item_id long, doc_id long, score long"
ROWS = 1 << 15


# ------------------------------------------------------------------ index


def _slices(piece: Piece) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, bounds): the piece, or one very long text in parts that end between terms."""
    if len(piece.data) <= 4 * PIECE:
        yield 0, piece.data, piece.bounds
        return
    for i in range(len(piece)):
        start, end = int(piece.bounds[i]), int(piece.bounds[i + 1])
        while start < end:
            stop = min(end, start + PIECE)
            while stop < end and LETTERS[piece.data[stop]]:
                stop += 1
            yield i, piece.data[start:stop], np.array([0, stop - start])
            start = stop


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans, one after the other."""
    return data[np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)]


class _Shard:
    """Terms counted so far, and the rows they come to."""

    def __init__(self):
        self.size, self.ids, self.counts, self.spelled = 0, [], [], []
        self.lengths: list[np.ndarray] = []

    def add(self, piece: Piece) -> None:
        base, lengths = len(self.ids), np.zeros(len(piece), np.int64)
        self.ids.extend(piece.column("doc_id").to_pylist())
        self.size += len(piece.data)
        for first, data, bounds in _slices(piece):
            data = lower_ascii(data)
            starts, ends, at = word_spans(data, bounds, LETTERS)
            found = np.diff(at)
            lengths[first : first + len(found)] += found
            hashes, docs = span_hash(prefix_hash(data), starts, ends), np.repeat(np.arange(len(found)) + (base + first), found)
            order = np.lexsort((docs, hashes))
            h, d = hashes[order], docs[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            cuts = np.flatnonzero(new)
            self.counts.append((h[cuts], d[cuts].astype(np.int32), np.diff(cuts, append=len(h)).astype(np.int32)))
            new[1:] = h[1:] != h[:-1]
            one = order[np.flatnonzero(new)]
            size = ends[one] - starts[one]
            self.spelled.append((hashes[one], size, _gather(data, starts[one], size)))
        self.lengths.append(lengths)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        absent = np.array([i is None for i in self.ids], bool)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        order = np.lexsort((ids, absent))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        ids, lengths = pa.array(ids[order], mask=absent[order]), np.concatenate(self.lengths)[order]
        yield _index_batch(shard, pa.array([""]), np.array([0, len(order)]), ids, lengths)
        hashes, docs, counts = (np.concatenate(x) for x in zip(*self.counts, strict=True))
        docs = place[docs]
        order = np.lexsort((docs, hashes))
        hashes, docs, counts = hashes[order], docs[order], counts[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
        cuts = np.flatnonzero(new)
        counts = np.add.reduceat(counts, cuts) if len(cuts) else counts
        hashes, docs = hashes[cuts], docs[cuts]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        firsts = np.append(np.flatnonzero(new), len(hashes))
        spelled, sizes, data = (np.concatenate(x) for x in zip(*self.spelled, strict=True))
        one = np.unique(spelled, return_index=True)[1]
        begins = np.cumsum(sizes) - sizes
        for a in range(0, len(one), ROWS):
            b = min(a + ROWS, len(one))
            size, span = sizes[one[a:b]], slice(firsts[a], firsts[b])
            offsets = np.zeros(b - a + 1, np.int32)
            np.cumsum(size, out=offsets[1:])
            terms = pa.StringArray.from_buffers(b - a, pa.py_buffer(offsets), pa.py_buffer(_gather(data, begins[one[a:b]], size).tobytes()))
            yield _index_batch(shard, terms, firsts[a : b + 1] - firsts[a], pa.array(docs[span].astype(np.int64)), counts[span])


def _index_batch(shard: int, terms: pa.Array, bounds: np.ndarray, docs: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    bounds = pa.array(bounds.astype(np.int32))
    lists = pa.ListArray.from_arrays(bounds, docs), pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), shard, np.int64)), terms, *lists], ["shard", "term", "docs", "counts"])


def build(docs: DataFrame) -> DataFrame:
    """The index of all documents: per shard a row per term, and one with the empty term for ids and lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 33, _Shard()
        for piece in pieces(batches):
            shard.add(piece)
            if shard.size >= SHARD:
                yield from shard.rows(number)
                number, shard = number + 1, _Shard()
        if shard.ids:
            yield from shard.rows(number)

    return kept(texts(docs).mapInArrow(run, INDEX), "lexical-index")


# ------------------------------------------------------------------ search


class _Lists:
    """The posting lists of a shard with their tables."""

    def __init__(self, bounds: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        if len(docs) >= 1 << PLACE or len(impacts) and int(impacts.max()) >= 1 << (62 - PLACE):
            raise ValueError("a shard's posting lists or impacts are too large")
        self.bounds, self.docs, self.impacts, self.n_docs = bounds, docs, impacts, n_docs
        self.owners = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) << 32 | docs
        self.at = np.random.default_rng(len(docs)).permutation(len(docs))
        drawn = np.empty(len(docs), np.int64)
        drawn[self.at] = np.arange(len(docs))
        level = impacts << PLACE | drawn
        longest = int(np.diff(bounds).max(initial=1))
        self.table = np.zeros((max(1, longest.bit_length()), len(docs) + 1), np.int64)
        self.table[0, :-1] = level
        for k in range(1, len(self.table)):
            half = 1 << (k - 1)
            self.table[k] = self.table[k - 1]
            np.maximum(self.table[k, :-half], self.table[k - 1, half:], out=self.table[k, :-half])

    def largest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The largest entry of each range, 0 where it is empty."""
        size = high - low
        k = np.maximum(np.frexp(size)[1] - 1, 0)
        found = np.maximum(self.table[k, low], self.table[k, np.maximum(high - (1 << k), low)])
        return np.where(size > 0, found, 0)


class _Best:
    """An item's best documents so far, over the shards of a task."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def offer(self, scores: np.ndarray, docs: np.ndarray, ids: list) -> None:
        if len(self.rows) == self.k:
            good = scores >= -self.rows[-1][0]
            scores, docs = scores[good], docs[good]
        more = [(-s, ids[d] is None, ids[d] or 0) for s, d in zip(scores.tolist(), docs.tolist(), strict=True) if s > 0]
        if more:
            self.rows = sorted(self.rows + more)[: self.k]

    def open(self, bounds: np.ndarray, firsts: np.ndarray, ids: list) -> np.ndarray:
        """Which intervals may hold a document that belongs here; `firsts` are their first documents."""
        if len(self.rows) < self.k:
            return bounds > 0
        least, *last = self.rows[-1]
        good = bounds > -least
        for i in np.flatnonzero(bounds == -least):
            d = ids[firsts[i]]
            good[i] = [d is None, d or 0] < last
        return good


def _first_docs(lists: _Lists, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    docs = lists.docs[np.minimum(low, len(lists.docs) - 1)]
    return np.where(low < high, docs, lists.n_docs).min(axis=1)


def _search(lists: _Lists, terms: np.ndarray, best: _Best, ids: list) -> None:
    """Offer the documents of a shard that may be among the item's best."""
    low, high = lists.bounds[terms][None, :], lists.bounds[terms + 1][None, :]
    top = lists.largest(low, high)
    owner = terms.astype(np.int64) << 32
    while True:
        bounds = (top >> PLACE).sum(axis=1)
        alive = np.flatnonzero(best.open(bounds, _first_docs(lists, low, high), ids))
        if not len(alive):
            return
        if len(alive) > BEST:
            alive = alive[np.argsort(-bounds[alive], kind="stable")]
        now, later = alive[:BEST], alive[BEST:]
        small = (high[now] - low[now]).sum(axis=1) <= LEAF
        leaf = now[small]
        if len(leaf):
            starts, sizes = low[leaf].ravel(), (high[leaf] - low[leaf]).ravel()
            at = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
            docs, place = np.unique(lists.docs[at], return_inverse=True)
            scores = np.zeros(len(docs), np.int64)
            np.add.at(scores, place, lists.impacts[at])
            best.offer(scores, docs, ids)
        parted = now[~small]
        a, b, t = low[parted], high[parted], top[parted]
        chosen = lists.docs[lists.at[t.max(axis=1) & ((1 << PLACE) - 1)]]
        cut = np.clip(np.searchsorted(lists.owners, owner[None, :] | chosen[:, None]), a, b)
        held = (cut < b) & (lists.docs[np.minimum(cut, len(lists.docs) - 1)] == chosen[:, None])
        best.offer(np.where(held, lists.impacts[np.minimum(cut, len(lists.docs) - 1)], 0).sum(axis=1), chosen, ids)
        low, high = np.concatenate([low[later], a, cut + held]), np.concatenate([high[later], cut, b])
        top = np.concatenate([top[later], lists.largest(a, cut), lists.largest(cut + held, b)])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[pa.RecordBatch]]]:
    """Runs of rows of one block and shard."""
    key, held = None, []
    for batch in batches:
        blocks, shards = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (shards[1:] != shards[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
            if a < b:
                if (blocks[a], shards[a]) != key:
                    if held:
                        yield key, held
                    key, held = (blocks[a], shards[a]), []
                held.append(batch.slice(a, b - a))
    if held:
        yield key, held


def _best_of_shards(n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int | None, _Best] = {}
        block = None
        for (number, _), rows in _grouped(batches):
            if number != block:
                yield from out(best)
                block, best = number, {}
            table = pa.Table.from_batches(rows).combine_chunks()
            terms = table.column("term").to_pylist()
            home = terms.index("")
            about = table.slice(home, 1)
            ids = about.column("docs")[0].as_py()
            m = 10 + 90 * np.array(about.column("counts")[0].as_py(), np.int64) * n_docs // n_terms
            table = pa.concat_tables([table.slice(0, home), table.slice(home + 1)]).combine_chunks()
            if not len(table):
                continue
            docs, counts = table.column("docs").combine_chunks(), table.column("counts").combine_chunks()
            docs, counts = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (docs, counts))
            bounds = np.concatenate([[0], np.cumsum(docs.value_lengths().to_numpy())]).astype(np.int64)
            docs, counts = docs.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
            weights = np.repeat(table.column("weight").to_numpy(), np.diff(bounds))
            lists = _Lists(bounds, docs, weights * (10**9 * counts // (1000 * counts + 8 * m[docs])), len(ids))
            asked: dict[int | None, list[int]] = {}
            for i, items in enumerate(table.column("items").to_pylist()):
                for item in items:
                    asked.setdefault(item, []).append(i)
            for item, those in asked.items():
                _search(lists, np.array(those), best.setdefault(item, _Best(k)), ids)
        yield from out(best)

    def out(best: dict[int | None, _Best]) -> Iterator[pa.RecordBatch]:
        rows = [(item, None if absent else doc, -score) for item, found in best.items() for score, absent, doc in found.rows]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["item_id", "doc_id", "score"])

    return run


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """For each of `items` (item_id, text) its k best documents: item_id, rank, doc_id, score."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    term = F.explode(F.array_distinct(F.regexp_extract_all(lower, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))))
    asked = kept(items.select(F.col("item_id").cast("long"), term.alias("term")).distinct(), "lexical-asked")
    blocks = -(-asked.select("item_id").distinct().count() // ITEMS)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks)))
    asked = kept(asked.groupBy(block.alias("block"), "term").agg(F.collect_list(F.struct("item_id")).alias("items")), "lexical-blocks")
    about = index.where("term = ''").select(
        F.sum(F.size(F.filter("counts", lambda n: n > 0))), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n))
    )
    n_docs, n_terms = about.first()
    if not n_docs:
        return index.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    hits = kept(index.where("term <> ''").join(asked.select("term").distinct(), "term"), "lexical-hits")
    df = hits.groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(F.lit(1000) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    asked = asked.join(df, "term").select("block", "term", weight.alias("weight"), F.col("items.item_id").alias("items"))
    lists = hits.join(asked, "term").select("block", "shard", "term", "weight", "items", "docs", "counts")
    all_blocks = F.sequence(F.lit(0).cast("long"), F.lit(max(1, blocks) - 1).cast("long"))
    ids = index.where("term = ''").select(F.explode(all_blocks).alias("block"), "shard", "term", "docs", "counts")
    rows = lists.unionByName(ids, allowMissingColumns=True).repartition("block", "shard").sortWithinPartitions("block", "shard")
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = rows.mapInArrow(_best_of_shards(n_docs, n_terms, k), HITS).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")
