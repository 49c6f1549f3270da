"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into overlapping windows of words. Terms are the words of the benchmark; their weights are
sqrt(frequency in the window) * inverse window frequency over all documents; other words count in the length of a
window's vector only. All terms are searched, however common they are. What is left out before is only what can't be
reported: windows whose known terms can't reach the cosine limit, and stretches of a text whose words, all taken
together, hold too little of every item for the last check. A randomised singular value decomposition of the other windows
(and of the benchmark items) gives the latent space: sketch A'A Omega by tasks, orthonormal basis, then the small
matrix in that basis, again by tasks. Items are searched by latent cosine against these windows, and candidates are
verified by the weight of the longest common subsequence of words in the window's surroundings, and of the item's last
sentence, its answer.

Items are searched by parts. Up to 4 half windows an item is one part, longer ones are overlapping parts of 3, each of
which holds a whole window wherever it stands. A part whose copy would not reach the limit among other words even with
all its terms, as a short one, is searched in smaller windows, down to single words. What is verified is always the whole item.

The benchmark is the query set: it is read in lots of `ITEMS` items or `WORDS` words, and searched in blocks of `ITEMS`
parts of one window size; these bound the terms and the rank that tasks share.

Cases: null texts are empty and match nothing, as do items without a word. A null doc_id is reported as null. Repeated
rows and items report once. Empty tables give an empty result. Other columns are ignored by `leaks` and handed
through by `clean_documents`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import LETTERS, Piece, kept, lower_ascii, pieces, prefix_hash, small_batches, span_hash, texts, word_spans

ITEMS = 256
WORDS = 1 << 15
#: Words of half a window, where that does; windows begin at each multiple of it. 0 stands for windows of one word.
HALF = 16
#: Words of a stretch at least; of stretch and term pairs that a task works on at once.
STRETCH, PAIRS = 16 * HALF, 1 << 13
#: Text bytes that a task works on at once.
BYTES = 1 << 18
#: What a copy at the worst place has to reach, as a share of the limit: the latent space loses some of a cosine.
SPARE = 1.05
#: Further columns of the random sketch.
OVER = 16
#: Windows that a task works on at once, and their entries of which it holds latent vectors.
ROWS, ENTRIES = 4096, 1 << 13


@dataclass(frozen=True)
class Limits:
    cosine: float = 0.45
    #: Share of an item's weight in the common subsequence, alone, or with that share of the answer.
    common: float = 0.5
    common_with_answer: float = 0.4
    answer: float = 0.8


def _words(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    data = lower_ascii(piece.data)
    starts, ends, first = word_spans(data, piece.bounds, LETTERS)
    return span_hash(prefix_hash(data), starts, ends), first


def _hashes(text: str) -> np.ndarray:
    batch = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])
    return _words(Piece(batch))[0]


class Terms:
    """The terms of some items, and the items as sequences of terms."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        hashed = [_hashes(t) for _, t in items]
        self.hashes = np.unique(np.concatenate(hashed))
        self.items = [np.searchsorted(self.hashes, h) for h in hashed]
        answers = [re.split(r"(?<=[.?!])\s+(?=\S)", t.strip())[-1] for _, t in items]
        self.answers = [np.searchsorted(self.hashes, _hashes(a)) for a in answers]
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def of(self, words: np.ndarray) -> np.ndarray:
        """Term numbers; -1 for other words."""
        out = np.full(len(words), -1, np.int64)
        at = np.flatnonzero(self.sieve[(words & np.uint64(0xFFFFF)).astype(np.int64)])
        place = np.searchsorted(self.hashes, words[at])
        place[place == len(self.hashes)] = 0
        same = self.hashes[place] == words[at]
        out[at[same]] = place[same]
        return out


def _size(half: int) -> int:
    """Words of a window."""
    return max(1, 2 * half)


def _halves(first: np.ndarray, half: int = HALF) -> tuple[np.ndarray, np.ndarray]:
    """First word of each half window, and the text it belongs to."""
    counts = -(-np.diff(first) // half)
    owner = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[owner] + within * half, owner


def _frequencies(terms: Terms):
    """(term, windows) per task; term -1 counts all windows. Windows here don't overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(len(terms), np.int64), 0
        for piece in pieces(batches, limit=BYTES):
            words, first = _words(piece)
            starts, _ = _halves(first)
            term = terms.of(words)
            half = np.searchsorted(starts, np.arange(len(words)), "right") - 1
            known = term >= 0
            pairs = np.unique(half[known] * len(terms) + term[known])
            found += np.bincount(pairs % len(terms), minlength=len(terms))
            total += len(starts)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(found[at], total))], ["term", "windows"]
        )

    return run


def _shares(terms: Terms, items: np.ndarray, full: np.ndarray) -> np.ndarray:
    """terms x items: the share of the item's weight that its copies of the term have."""
    out = np.zeros((len(terms), len(items)), np.float32)
    for j, i in enumerate(items):
        weight = np.bincount(terms.items[i], full[terms.items[i]], len(terms))
        out[:, j] = weight / max(weight.sum(), 1e-12)
    return out


def held_shares(term: np.ndarray, low: np.ndarray, high: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """The largest share of an item that the terms from each `low` to before `high` hold. No common subsequence has more."""
    known = np.flatnonzero(term >= 0)
    low, high = np.searchsorted(known, low), np.searchsorted(known, high)
    sizes = high - low
    place = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    pair = np.unique(np.repeat(np.arange(len(low)), sizes) * len(shares) + term[known[place]])
    owner, one = pair // len(shares), pair % len(shares)
    cuts = np.searchsorted(owner, np.arange(len(low) + 1))
    out, at = np.zeros(len(low)), 0
    while at < len(low):
        end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + PAIRS, "right")) - 1)
        full = at + np.flatnonzero(cuts[at + 1 : end + 1] > cuts[at:end])
        if len(full):
            held = np.add.reduceat(shares[one[cuts[at] : cuts[end]]], cuts[full] - cuts[at], axis=0)
            out[full] = held.max(1)
        at = end
    return out


def _windows(terms: Terms, full: np.ndarray, weights: np.ndarray, other: float, limits: Limits, half: int, items: np.ndarray):
    """Windows that could reach the limits with some of the items: doc_id, length of the vector, terms inside, terms around."""
    length, rare = np.append(full, other) ** 2, np.append(weights, 0.0) ** 2
    longest = max(len(terms.items[i]) for i in items)
    stretch = max(STRETCH, -(-longest // HALF) * HALF)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = _shares(terms, items, full)

        def reached(term, first, text, begin, size, shares):
            low, high = np.maximum(first[text], begin - longest), np.minimum(first[text + 1], begin + size + longest)
            return held_shares(term, low, high, shares) >= limits.common_with_answer - 1e-4

        for piece in pieces(batches, limit=BYTES):
            words, first = _words(piece)
            if not len(words):
                continue
            starts, owner = _halves(first, max(1, half))
            term = terms.of(words)
            whole = np.add.reduceat(length[term], starts)
            known = np.add.reduceat(rare[term], starts)
            follows = np.append(owner[1:] == owner[:-1], False) & (half > 0)
            whole = whole + np.where(follows, np.append(whole[1:], 0.0), 0.0)
            known = known + np.where(follows, np.append(known[1:], 0.0), 0.0)
            good = np.flatnonzero((known >= limits.cosine**2 * whole) & (known > 0))
            if not len(good):
                continue
            # The surroundings of all windows that begin in a stretch lie in its words and those beside it.
            begin, text = _halves(first, stretch)
            own = np.searchsorted(begin, starts[good], "right") - 1
            some, own = np.unique(own, return_inverse=True)
            good = good[reached(term, first, text[some], begin[some], stretch + _size(half), shares)[own]]
            good = good[reached(term, first, owner[good], starts[good], _size(half), shares)]
            if not len(good):
                continue
            inside, around = [], []
            for h in good:
                low, high = first[owner[h]], first[owner[h] + 1]
                a, b = starts[h], min(starts[h] + _size(half), high)
                span = term[max(low, a - longest) : min(high, b + longest)]
                around.append(span[span >= 0].astype(np.int32).tobytes())
                span = term[a:b]
                inside.append(span[rare[span] > 0].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id").take(pa.array(owner[good])),
                    pa.array(np.sqrt(whole[good])),
                    pa.array(inside, pa.binary()),
                    pa.array(around, pa.binary()),
                ],
                ["doc_id", "length", "inside", "around"],
            )

    return run


def _vectors(inside: list[bytes], lengths: np.ndarray, weights: np.ndarray):
    """Sparse rows: entry's row, term and value, rows divided by their length."""
    parts = [np.frombuffer(b, np.int32) for b in inside]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    pair, count = np.unique(row * len(weights) + np.concatenate(parts), return_counts=True)
    row, term = pair // len(weights), pair % len(weights)
    return row, term, (np.sqrt(count) * weights[term] / lengths[row]).astype(np.float32)


def _times(row, term, value, n: int, matrix: np.ndarray) -> np.ndarray:
    """Sparse rows times a dense matrix. Every row has an entry."""
    return _added_up(np.searchsorted(row, np.arange(n)), term, value, matrix)


def _added_up(cuts: np.ndarray, place: np.ndarray, value: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Sums of rows of a matrix times values, from each cut to the next; entries are taken in lots that end at cuts."""
    out = np.empty((len(cuts), matrix.shape[1]), np.result_type(matrix, value))
    ends = np.append(cuts[1:], len(place))
    at = 0
    while at < len(cuts):
        end = max(at + 1, int(np.searchsorted(ends, cuts[at] + ENTRIES, "right")))
        these = slice(cuts[at], ends[end - 1])
        out[at:end] = np.add.reduceat(matrix[place[these]] * value[these, None], cuts[at:end] - cuts[at], axis=0)
        at = end
    return out


def _sparse(batches: Iterator[pa.RecordBatch], weights: np.ndarray):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            names = part.schema.names
            lengths = part.column(names.index("length")).to_numpy()
            row, term, value = _vectors(part.column(names.index("inside")).to_pylist(), lengths, weights)
            yield part, row, term, value


def _partial(name: str, total: np.ndarray, chunk: int) -> Iterator[pa.RecordBatch]:
    places = list(range(0, len(total), chunk))
    blobs = [np.ascontiguousarray(total[p : p + chunk], np.float32).tobytes() for p in places]
    yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(blobs, pa.binary())], ["place", name])


def _gram(weights: np.ndarray, matrix: np.ndarray, inner: bool):
    """Per task: sum of x (x'M) over its windows, or of (x'M)'(x'M)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = matrix.shape[1]
        total = np.zeros((width if inner else len(weights), width), np.float32)
        for part, row, term, value in _sparse(batches, weights):
            y = _times(row, term, value, part.num_rows, matrix)
            if inner:
                total += y.T @ y
            else:
                order = np.argsort(term, kind="stable")
                t = term[order]
                cuts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
                total[t[cuts]] += _added_up(cuts, row[order], value[order], y)
        yield from _partial("part", total, 512)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for place, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(raw.as_buffer(), np.float32)
            total[place] = total[place] + part if place in total else part.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["place", "part"]
    )


def _summed(windows: DataFrame, weights: np.ndarray, matrix: np.ndarray, inner: bool) -> np.ndarray:
    """The sum over all windows: its size is terms times rank, whatever the table."""
    parts = windows.select("length", "inside").mapInArrow(_gram(weights, matrix, inner), "place long, part binary")
    rows = parts.repartition("place").mapInArrow(_added, "place long, part binary").collect()
    height = matrix.shape[1] if inner else len(weights)
    total = np.zeros((height, matrix.shape[1]), np.float32)
    for place, raw in rows:
        part = np.frombuffer(bytes(raw), np.float32).reshape(-1, matrix.shape[1])
        total[place : place + len(part)] += part
    return total


def latent_basis(windows: DataFrame, items: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """terms x rank: right singular vectors of the windows and the items, by a randomised range finder.

    The items weigh as much in total as the windows: else a few common topics of the corpus would fill the space.
    """
    items = items * np.float32(np.sqrt(max(1, windows.count()) / len(items)))
    rank = min(len(items), len(weights))
    width = min(rank + OVER, len(weights))
    omega = np.random.default_rng(7).standard_normal((len(weights), width)).astype(np.float32)
    sketch = _summed(windows, weights, omega, False) + items.T @ (items @ omega)
    basis = np.linalg.qr(sketch.astype(np.float64))[0].astype(np.float32)
    inner = _summed(windows, weights, basis, True) + (items @ basis).T @ (items @ basis)
    vectors = np.linalg.eigh(inner.astype(np.float64))[1][:, ::-1]
    return basis @ vectors[:, :width].astype(np.float32)


def common_weight(item: np.ndarray, text: np.ndarray, weights: np.ndarray) -> float:
    """Largest weight of a common subsequence of two term sequences, as a share of the first one's weight."""
    best = np.zeros(len(text) + 1)
    for t in item:
        taken = np.append(0.0, best[:-1] + np.where(text == t, weights[t], 0.0))
        best = np.maximum.accumulate(np.maximum(best, taken))
    return float(best[-1] / max(weights[item].sum(), 1e-12))


def _search(terms: Terms, full: np.ndarray, weights: np.ndarray, basis: np.ndarray, queries: np.ndarray, item: np.ndarray, limits: Limits):
    """`queries` are parts in the latent space, `item` says of which item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, row, term, value in _sparse(batches, weights):
            cosine = _times(row, term, value, part.num_rows, basis) @ queries.T
            around = part.column(part.schema.names.index("around"))
            near: dict[tuple[int, int], float] = {}
            for w, q in zip(*np.nonzero(cosine >= limits.cosine), strict=True):
                key = int(w), int(item[q])
                near[key] = max(near.get(key, 0.0), float(cosine[w, q]))
            found = []
            for (w, i), c in near.items():
                text = np.frombuffer(around[w].as_buffer(), np.int32)
                common = common_weight(terms.items[i], text, full)
                if common < limits.common_with_answer:
                    continue
                answer = common_weight(terms.answers[i], text, full)
                if common >= limits.common or answer >= limits.answer:
                    found.append((w, terms.ids[i], c, common, answer))
            if found:
                w, q, c, lcs, ans = (list(x) for x in zip(*found, strict=True))
                ids = part.column(part.schema.names.index("doc_id")).take(pa.array(w))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(q, pa.int64()), pa.array(c), pa.array(lcs), pa.array(ans)], ["doc_id", "item_id", "cosine", "common", "answer"]
                )

    return run


def reach(item: np.ndarray, seen: np.ndarray, full: np.ndarray, other: float, half: int = HALF) -> tuple[np.ndarray, np.ndarray]:
    """The part's terms from the rarest on, and the cosine of its copy with the best window if the first 1, 2, ... of them
    are searched. The copy stands where this is least, and the words around it weigh `other`."""
    one, place, count = np.unique(item, return_inverse=True, return_counts=True)
    order = np.argsort(seen[one], kind="stable")
    size, step = _size(half), max(1, half)
    starts = np.arange(1 - size, len(item))
    sums = np.zeros((len(item) + 1, len(one)))
    np.cumsum(np.eye(len(one))[place], axis=0, out=sums[1:])
    low, high = np.clip(starts, 0, len(item)), np.clip(starts + size, 0, len(item))
    inside = sums[high] - sums[low]
    length = inside @ full[one] ** 2 + (size - (high - low)) * other**2
    shared = np.cumsum((np.sqrt(inside * count) * full[one] ** 2)[:, order], axis=1)
    cosine = shared / np.sqrt(length * (full[item] ** 2).sum())[:, None]
    best = [cosine[r::step].max(0) for r in range(min(step, len(starts)))]
    return one[order], np.min(best, axis=0)


def parted(item: np.ndarray, seen: np.ndarray, full: np.ndarray, other: float, least: float, half: int = HALF) -> Iterator[tuple[int, np.ndarray]]:
    """(half, terms) of the parts to search: the largest windows in which a copy of the part reaches the limit."""
    step = max(1, half)
    if len(item) > (4 * half or 1):
        size = 3 * half or 1
        for at in [*range(0, len(item) - size, 2 * half or 1), len(item) - size]:
            yield from parted(item[at : at + size], seen, full, other, least, half)
    elif not half or reach(item, seen, full, other, half)[1][-1] >= SPARE * least:
        yield half, item
    else:
        yield from parted(item, seen, full, other, least, step // 2)


SCHEMA = "doc_id long, item_id long, cosine double, common double, answer double"


def _lot(docs: DataFrame, items: list[tuple[int, str]], limits: Limits) -> Iterator[DataFrame]:
    terms = Terms(items)
    source = texts(docs)
    counted = source.mapInArrow(_frequencies(terms), "term long, windows long").groupBy("term").agg(F.sum("windows").alias("windows"))
    with small_batches(docs.sparkSession):
        counts = dict(counted.collect())
    total = max(1, counts.pop(-1, 0))
    seen = np.ones(len(terms))
    for t, c in counts.items():
        seen[t] = c
    full = np.log((1.0 + total) / seen)
    # Words outside the benchmark weigh as much as its median term.
    other = float(np.median(full))
    parts: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, item in enumerate(terms.items):
        for half, part in parted(item, seen, full, other, limits.cosine):
            parts.setdefault(half, []).append((i, part))
    for half, those in sorted(parts.items(), reverse=True):
        for at in range(0, len(those), ITEMS):
            block = those[at : at + ITEMS]
            weights = np.zeros(len(terms))
            searched = np.unique(np.concatenate([p for _, p in block]))
            weights[searched] = full[searched]
            yield _block(source, terms, block, half, full, weights, other, limits)


def _block(
    source: DataFrame, terms: Terms, block: list[tuple[int, np.ndarray]], half: int, full: np.ndarray, weights: np.ndarray, other: float, limits: Limits
) -> DataFrame:
    item = np.array([i for i, _ in block])
    found = source.mapInArrow(
        _windows(terms, full, weights, other, limits, half, np.unique(item)), "doc_id long, length double, inside binary, around binary"
    )
    with small_batches(source.sparkSession):
        windows = kept(found, "windows")
    raw = [p.astype(np.int32).tobytes() for _, p in block]
    lengths = np.array([np.sqrt((full[p] ** 2).sum()) for _, p in block])
    dense = np.zeros((len(block), len(terms)), np.float32)
    row, term, value = _vectors(raw, np.maximum(lengths, 1e-12), weights)
    dense[row, term] = value
    basis = latent_basis(windows, dense, weights)
    return windows.mapInArrow(_search(terms, full, weights, basis, dense @ basis, item, limits), SCHEMA)


def leaks(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, item_id, cosine, common, answer (shares), one row per document and item found in it."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null").dropDuplicates()
    lot: list[tuple[int, str]] = []
    parts, words = [], 0
    for item_id, text in rows.orderBy("item_id", "text").toLocalIterator():
        if n := len(_hashes(text)):
            if lot and (len(lot) == ITEMS or words + n > WORDS):
                parts += [kept(p, "leaks") for p in _lot(docs, lot, limits)]
                lot, words = [], 0
            lot.append((item_id, text))
            words += n
    if lot:
        parts += [kept(p, "leaks") for p in _lot(docs, lot, limits)]
    if not parts:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("cosine", "common", "answer")])


def clean_documents(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents without a leak, all columns. An id decides for all its rows."""
    found = kept(leaks(docs, benchmark, limits).select("doc_id").distinct(), "leaking")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti").select(*docs.columns)
