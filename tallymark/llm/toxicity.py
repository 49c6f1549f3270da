"""Toxicity: a support vector machine on a subsequence string kernel, with Nystroem landmarks.

The kernel compares two words by their common subsequences of three letters within a window of `SPAN` letters, each
occurrence weighing `DECAY` to the power of its gaps, so `i-d-i-o-t` is near `idiot`; a word's beginning counts as a letter.
Characters are code points. Those that are neither letters nor digits (signs, marks, zero-width ones) are skipped: they
make a gap, however many, of at most `GAP`. The kernel against the landmarks, which are words of the labelled sentences,
whitened by their own kernel matrix, is the feature vector of a linear machine with hinge loss.

Training is by sentences: a sentence of a toxic text is toxic through its worst word, the one of the highest value; which
words these are is decided and learned in turn. The machine sees single words, so an insult made of ordinary words gives
no evidence beyond theirs. Only a word that stands in significantly more toxic rows than the labels' base rate gives can
make a sentence toxic, and only if the kernel can tell it from the words of clean rows: one because of which the machine
takes clean words for toxic is given up, and the machine trained anew. Toxic rows without such a word
bring no positives, so what is peculiar to them by chance isn't learned. All words of the clean rows are negatives. The
rows are sorted first: their order doesn't matter. A logistic curve over the values of a text's `TOP` worst different
words, fitted on the labelled texts, gives its score. As kernel sums are linear in the subsequences, all landmarks fold
into one number per subsequence, and scoring a word is a sum over its subsequences; a task values each word once.

Words are maximal runs of non-spaces, in small letters; three or more adjacent words of one letter are joined to one
more, and a word with one and the same letter at every second place, or at all but every third, gives the rest of it as one more
(`ixdxixoxt`). Words beyond `WIDTH` letters are covered by overlapping parts. At most `PER_CLASS` labelled rows of each label are
learned from; very long texts are learned from and scored whole.

Cases: null and empty texts, and texts of words under three letters, have the lowest score there is, that of no evidence. A
null id is scored and not held out. Repeated rows each get a row; ties don't matter. Without labelled rows of both labels,
or if no word tells them apart, every score is 0.5. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymark.llm.common import Piece, pieces, prefix_hash, span_hash, texts, word_spans
from tallymark.llm.labelled import held_out, training_rows

SPAN, DECAY, WIDTH = 7, 0.5, 24
#: Skipped characters that count in one gap.
GAP = 3
#: Words are valued in arrays by length.
WIDTHS = ((3, 6), (7, 10), (11, WIDTH))
PER_CLASS = 1000
LANDMARKS = 96
_PAIRS = [(j, k, DECAY ** (k - 2)) for k in range(2, SPAN) for j in range(1, k)]
_STARTS = [(j, k, DECAY ** (k - 2)) for k in range(2, 4) for j in range(1, k)]
#: The symbol of a word's beginning.
START = 63


_ASCII = np.array([c - 96 if 97 <= c <= 122 else c - 64 if 65 <= c <= 90 else 27 + c * 7 % 36 if 48 <= c <= 57 else 0 for c in range(128)], np.uint8)


@lru_cache(1 << 16)
def _symbol(code: int) -> int:
    """Six-bit symbols: 1 to 26 for letters, 27 to 62 for digits and letters beyond ASCII, several to a symbol. 0 is skipped."""
    if code < 128:
        return int(_ASCII[code])
    small = chr(code).lower()[0]
    if ord(small) < 128:
        return int(_ASCII[ord(small)])
    return 27 + ord(small) * 7 % 36 if unicodedata.category(small)[0] in "LN" else 0


def spelled(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The letters of UTF-8 texts, one byte each: its symbol, and above it the gap before it inside its word; start and end
    of each word that has letters, and the first such word of each text."""
    try:
        whole = data.tobytes().decode()
        at = np.append(0, np.cumsum((data & 0xC0) != 0x80))[bounds]
    except UnicodeDecodeError:
        each = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        whole, at = "".join(each), np.append(0, np.cumsum([len(t) for t in each]))
    codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    symbol = _ASCII[np.minimum(codes, 127)]
    wide = np.flatnonzero(codes > 127)
    if len(wide):
        one, back = np.unique(codes[wide], return_inverse=True)
        symbol[wide] = np.array([_symbol(int(c)) for c in one], np.uint8)[back]
    starts, ends, first = word_spans(np.minimum(codes, 255).astype(np.uint8), at)
    place = np.flatnonzero(symbol)
    letters = symbol[place]
    low, high = np.searchsorted(place, starts), np.searchsorted(place, ends)
    gap = np.minimum(np.diff(place, prepend=place[:1]) - (np.arange(len(place)) > 0), GAP)
    some = high > low
    gap[low[some]] = 0
    return letters | (gap.astype(np.uint8) << 6), low[some], high[some], np.append(0, np.cumsum(some))[first]


@lru_cache(1 << 16)
def _spelled(word: str) -> bytes:
    out, gap = bytearray(), 0
    for c in word:
        symbol = _symbol(ord(c))
        if symbol:
            out.append(symbol | (min(gap, GAP) << 6 if out else 0))
        gap = 0 if symbol else gap + 1
    return bytes(out)


def subsequences(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, weights, which are real) per pair of offsets, for rows of letters padded with 0."""
    s = (words & 63).astype(np.int32)
    gaps = np.cumsum(words >> 6, axis=1, dtype=np.int32)
    faded = DECAY ** np.arange(GAP * words.shape[1] + 1, dtype=np.float32) if gaps[:, -1].any() else None
    for j, k, weight in _PAIRS:
        if k < s.shape[1]:
            x, y, z = s[:, :-k], s[:, j : j - k], s[:, k:]
            real = (x > 0) & (y > 0) & (z > 0)
            each = np.float32(weight) if faded is None else np.float32(weight) * faded[gaps[:, k:] - gaps[:, :-k]]
            yield (x << 12) | (y << 6) | z, np.broadcast_to(each, real.shape), real
    # A word's beginning is a letter of its own, as stems tell more than what stands inside; it pairs with the first three.
    for j, k, weight in _STARTS:
        if k <= s.shape[1]:
            y, z = s[:, j - 1 : j], s[:, k - 1 : k]
            real = (y > 0) & (z > 0)
            each = np.float32(weight) if faded is None else np.float32(weight) * faded[gaps[:, k - 1 : k]]
            yield (START << 12) | (y << 6) | z, np.broadcast_to(each, real.shape), real


def _padded(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    out = np.zeros((len(words), width), np.uint8)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w, np.uint8)
    return out


def lengths(words: np.ndarray) -> np.ndarray:
    """Length of each row's vector of subsequences, equal subsequences of a row added up."""
    found = list(subsequences(words))
    codes = np.concatenate([np.where(real, c, -1) for c, _, real in found], axis=1)
    weights = np.concatenate([np.where(real, w, 0.0) for _, w, real in found], axis=1)
    order = np.argsort(codes, axis=1)
    codes, weights = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1)
    square = (weights**2).sum(1)
    for lag in range(1, codes.shape[1]):
        same = (codes[:, lag:] == codes[:, :-lag]) & (codes[:, lag:] >= 0)
        if not same.any():
            break
        square += 2 * (np.where(same, weights[:, lag:], 0.0) * weights[:, :-lag]).sum(1)
    return np.sqrt(np.maximum(square, 1e-12))


def sums(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the table over each row's weighted subsequences."""
    total = np.zeros(len(words))
    for codes, weight, real in subsequences(words):
        total += np.where(real, weight * table[codes], 0).sum(1)
    return total


def values(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    return sums(words, table) / lengths(words)


class Landmarks:
    """Unit vectors of some words, over the subsequences that any of them has."""

    def __init__(self, words: list[bytes]):
        found = [codes[real] for codes, _, real in subsequences(_padded(words))]
        self.codes = np.unique(np.concatenate(found))
        #: Place of a subsequence among those, 0 for all others.
        self.place = np.zeros(1 << 18, np.int32)
        self.place[self.codes] = np.arange(1, len(self.codes) + 1)
        self.maps = np.zeros((len(self.codes) + 1, len(words)), np.float32)
        for codes, weight, real in subsequences(_padded(words)):
            rows = np.broadcast_to(np.arange(len(words))[:, None], codes.shape)[real]
            np.add.at(self.maps, (self.place[codes[real]], rows), weight[real])
        self.maps /= np.maximum(np.linalg.norm(self.maps, axis=0), 1e-6)

    def kernel(self, words: np.ndarray) -> np.ndarray:
        """Kernel of each row of bytes with each landmark."""
        total = np.zeros((len(words), self.maps.shape[1]), np.float32)
        for codes, weight, real in subsequences(words):
            total += (weight[:, :, None] * self.maps[np.where(real, self.place[codes], 0)]).sum(1)
        return total / lengths(words)[:, None].astype(np.float32)

    def folded(self, weights: np.ndarray) -> np.ndarray:
        """The weighted sum of the landmarks as one number per subsequence."""
        out = np.zeros(1 << 18, np.float32)
        out[self.codes] = self.maps[1:] @ weights
        return out


def _parts(word: bytes) -> list[bytes]:
    """The word, or overlapping parts that hold each of its windows of SPAN letters."""
    if len(word) <= WIDTH:
        return [word]
    step = WIDTH - SPAN
    return [word[i : i + WIDTH] for i in range(0, max(1, len(word) - SPAN), step)]


def _joined(words: list[bytes]) -> list[bytes]:
    """Runs of three or more words of one letter, joined."""
    out, run = [], []
    for w in [*words, b"  "]:
        if len(w) == 1:
            run.append(w)
        else:
            if len(run) >= 3:
                out.append(b"".join(run))
            run = []
    return out


def _unfilled(word: bytes) -> list[bytes]:
    """The word without a letter that stands at every second place, or at all places but every third."""
    out = []
    for step in (2, 3):
        rest = word[::step]
        if len(rest) >= 3:
            filler = {b & 63 for i, b in enumerate(word) if i % step}
            if len(filler) == 1 and {b & 63 for b in rest} != filler:
                out.append(bytes(b & 63 for b in rest))
    return out


def _sentences(text: str) -> list[list[bytes]]:
    out = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n", text):
        words = [w for w in map(_spelled, re.split("[\x20\x09-\x0D]+", sentence)) if w]
        words += _joined(words)
        out.append([p for w in words + [u for w in words for u in _unfilled(w)] for p in _parts(w) if len(p) >= 3])
    return [s for s in out if s]


#: Words whose values a task remembers.
WORDS = 1 << 21
#: Features of a text's score: values of that many words, where they are above `FLOOR`.
TOP, FLOOR = 3, -1.0
#: Chance at which any word of the labelled rows counts as telling though it is not.
LEVEL = 0.01
#: Rounds of training without a positive given up.
ROUNDS = 3
#: Kernel from which on words are near, and the toxic rows among those of the words near a telling one.
NEAR, PURE = 0.5, 0.9


@dataclass(frozen=True)
class Model:
    table: np.ndarray
    bias: float
    slopes: np.ndarray
    offset: float

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.slopes + self.offset, -500, 500)))


#: Value of a text without any word of three letters, before the bias.
NOTHING = -1.0


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rng, steps: int = 4000, batch: int = 128) -> tuple[np.ndarray, float]:
    """Hinge loss by stochastic subgradient steps on small batches, half of each from either class; the mean of the later iterates."""
    w, b, mean_w, mean_b, kept = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0, 0
    sides = [(np.flatnonzero(y == v), np.cumsum(weight[y == v] / weight[y == v].sum())) for v in (-1, 1)]
    for t in range(steps):
        at = np.concatenate([k[np.minimum(np.searchsorted(draw, rng.random(batch // 2)), len(k) - 1)] for k, draw in sides])
        pace = 4.0 / (1 + t / 200)
        bad = at[y[at] * (x[at] @ w + b) < 1]
        w *= 1 - pace * 1e-5
        w += pace * (y[bad, None] * x[bad]).sum(0) / batch
        b += 0.2 * pace * y[bad].sum() / batch
        if 2 * t >= steps:
            mean_w, mean_b, kept = mean_w + w, mean_b + b, kept + 1
    return mean_w / kept, mean_b / kept


def _matrix(words: list[bytes], landmarks: Landmarks) -> np.ndarray:
    """Kernel of each word with each landmark, words of like length together."""
    out = np.zeros((len(words), landmarks.maps.shape[1]), np.float32)
    size = np.array([len(w) for w in words])
    for low, width in WIDTHS:
        at = np.flatnonzero((size >= low) & (size <= width))
        for part in np.array_split(at, -(-len(at) // 2048)) if len(at) else ():
            out[part] = landmarks.kernel(_padded([words[i] for i in part], width))
    return out


def _significant(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Which words stand in significantly more toxic rows than `share` of theirs.

    The chance of so many toxic rows, at that share, is at most exp(-rows * divergence); all words are tested, so the
    level is divided by their number.
    """
    rows = toxic + clean
    seen = np.clip(toxic / np.maximum(rows, 1), 1e-12, 1 - 1e-12)
    divergence = seen * np.log(seen / share) + (1 - seen) * np.log((1 - seen) / (1 - share))
    return (seen > share) & (rows * divergence > np.log(len(rows) / LEVEL))


def _told_apart(words: list[bytes], able: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Which of the words the kernel can tell from clean ones: among the rows of the words near it, `PURE` are toxic.

    A stem that clean texts hold as well makes a word significant that the machine could only learn with their words.
    """
    out, places = np.zeros(len(words), bool), np.flatnonzero(able)
    if len(places):
        near = _matrix(words, Landmarks([words[i] for i in places])) > NEAR
        bad, good = near.T @ clean.astype(float), near.T @ toxic.astype(float)
        out[places] = good >= PURE * (good + bad)
    return out


def _not_kept_apart(words: list[bytes], positive: np.ndarray, taken: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """The positives because of which the machine takes words of clean rows for toxic: each such word counts against the
    nearest positive, and a positive must hold `PURE` of the rows that it brings."""
    if not len(taken):
        return taken
    near = _matrix([words[i] for i in taken], Landmarks([words[i] for i in positive]))
    against = np.bincount(near.argmax(1), weights=clean[taken], minlength=len(positive))
    return positive[against * PURE > (1 - PURE) * toxic[positive]]


def _evidence(values: np.ndarray) -> np.ndarray:
    """The highest values of a text's different words, from `FLOOR` on, as features of its score."""
    found = np.full(TOP, FLOOR)
    best = np.sort(values[values > FLOOR])[::-1][:TOP]
    found[: len(best)] = best
    return found


def _fitted(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with weights that are not negative: more evidence never lowers a score."""
    w, b = np.ones(x.shape[1]), 0.0
    for _ in range(4000):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50)))
        w = np.maximum(w - 0.5 * (x.T @ (p - y) / len(y) + 1e-3 * w), 0)
        b -= 0.5 * float((p - y).mean())
    # A text without a word that the machine takes for toxic isn't toxic.
    return w, min(b, float(-FLOOR * w[1:].sum()))


def train(rows: list[tuple[str, int]], seed: int = 3) -> Model | None:
    rng = np.random.default_rng(seed)
    bags = [(_sentences(t), y) for t, y in sorted((t or "", y) for t, y in rows)]
    counts = {y: sum(label == y for _, label in bags) for y in (0, 1)}
    if not all(counts.values()):
        return None
    seen = {0: Counter(), 1: Counter()}
    for sentences, y in bags:
        seen[y].update({w for s in sentences for w in s})
    words = sorted(seen[0] | seen[1])
    number = {w: i for i, w in enumerate(words)}
    toxic_rows, clean_rows = (np.array([seen[y][w] for w in words]) for y in (1, 0))
    in_toxic, in_clean = toxic_rows / counts[1], clean_rows / counts[0]
    # Landmarks: words that tell the labels apart best, and frequent words of clean sentences.
    apart = (in_toxic - in_clean) / np.sqrt(in_toxic + in_clean + 1 / len(rows))
    marked = np.concatenate([np.argsort(-apart, kind="stable")[: 2 * LANDMARKS // 3], np.argsort(-in_clean, kind="stable")[: LANDMARKS // 3]])
    marked = list(dict.fromkeys(marked.tolist()))
    landmarks = Landmarks([words[i] for i in marked])
    matrix = _matrix(words, landmarks)
    inner = matrix[marked].astype(np.float64)
    low, turn = np.linalg.eigh((inner + inner.T) / 2 + 1e-3 * np.eye(len(marked)))
    whiten = turn / np.sqrt(np.maximum(low, 1e-6)) @ turn.T
    x = matrix @ whiten.astype(np.float32)
    clean = np.flatnonzero(in_clean > 0)
    # Only words that stand in toxic rows beyond chance can make a sentence toxic; rows without one bring no positives.
    able = _significant(toxic_rows, clean_rows, counts[1] / len(rows))
    able = _told_apart(words, able, toxic_rows, clean_rows)
    toxic = [[[number[w] for w in s] for s in sentences] for sentences, y in bags if y == 1]
    worth = apart.copy()
    hard = np.ones(len(clean))
    w = b = None
    done = 0
    while done < ROUNDS:
        witness: Counter = Counter()
        for sentences in toxic:
            known = [[i for i in s if able[i]] for s in sentences]
            witness.update({s[int(np.argmax(worth[s]))] for s in known if s})
        if not witness or not len(clean):
            return None
        positive = np.array(sorted(witness))
        sample = np.concatenate([positive, clean])
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(clean))])
        weight = np.concatenate([np.array([witness[i] for i in positive]) / sum(witness.values()), hard])
        w, b = _machine(x[sample], y, weight, rng)
        worth = x @ w + b
        # Clean words near the margin are drawn more often in the next round.
        hard = np.where(worth[clean] > -1, 20.0, 1.0)
        taken = clean[worth[clean] > 0]
        lost = _not_kept_apart(words, positive, taken, toxic_rows, clean_rows)
        able[lost] = False
        done = done + 1 if not len(lost) else 0
    each = [np.unique([number[u] for s in sentences for u in s]) for sentences, _ in bags]
    found = np.array([_evidence(worth[i.astype(int)]) for i in each])
    label = np.array([y for _, y in bags], float)
    # One telling word that no clean row has is enough: such a word alone is a toxic text as well.
    alone = np.array([_evidence(worth[[i]]) for i in np.flatnonzero(able & (clean_rows == 0)) for _ in range(toxic_rows[i])])
    if len(alone):
        found, label = np.concatenate([found, alone]), np.concatenate([label, np.ones(len(alone))])
    slopes, offset = _fitted(found, label)
    return Model(landmarks.folded(whiten @ w), float(b), slopes, offset)


class Known:
    """Values of the words that a task has met, by hash."""

    def __init__(self):
        self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0)

    def of(self, hashes: np.ndarray, find) -> np.ndarray:
        """The values of sorted hashes; `find` gives those of the places it is called with."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        new = np.ones(len(hashes), bool) if not len(self.hashes) else self.hashes[at] != hashes
        out = np.zeros(len(hashes))
        if len(self.hashes):
            out[~new] = self.values[at[~new]]
        places = np.flatnonzero(new)
        if len(places):
            out[places] = find(places)
            if len(self.hashes) + len(places) > WORDS:
                self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0)
            into = np.searchsorted(self.hashes, hashes[places])
            self.hashes, self.values = np.insert(self.hashes, into, hashes[places]), np.insert(self.values, into, out[places])
        return out


def _word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: Model) -> np.ndarray:
    """The value of each word, that of its parts or of what is left of it without a filler letter, if higher."""
    value = np.full(len(starts), NOTHING)
    length = ends - starts
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    gaps = np.append(0, np.cumsum(data > 63))
    gapped = gaps[ends] > gaps[starts]
    for low, width, some in [(*w, some) for w in WIDTHS for some in (False, True)]:
        at = np.flatnonzero((length >= low) & (length <= width) & (gapped == some))
        for part in np.array_split(at, -(-len(at) // 8192)) if len(at) else ():
            rows = padded[starts[part][:, None] + np.arange(width)]
            rows[np.arange(width) >= length[part][:, None]] = 0
            value[part] = values(rows, model.table)

    def also(i: int, words: list[bytes]) -> None:
        if found := [p for w in words for p in _parts(w) if len(p) >= 3]:
            value[i] = max(value[i], values(_padded(found), model.table).max())

    for i in np.flatnonzero(length > WIDTH):
        also(i, [data[starts[i] : ends[i]].tobytes()])
    # A filler letter stands at the second place and at the fourth or third and last: most words are ruled out by that.
    at = np.flatnonzero(length >= 5)
    second, third, fourth = (data[starts[at] + k] & 63 for k in (1, 2, 3))
    for i in at[(second == fourth) | (second == third)]:
        also(i, _unfilled(data[starts[i] : ends[i]].tobytes()))
    return value


def _worst(piece: Piece, model: Model, known: Known) -> np.ndarray:
    """The highest values of each text's different words, `TOP` of them. Equal words of a task are valued once."""
    data, starts, ends, first = spelled(piece.data, piece.bounds)
    evidence = np.full((len(piece), TOP), FLOOR)
    if not len(starts):
        return evidence
    hashes, one, back = np.unique(span_hash(prefix_hash(data), starts, ends), return_index=True, return_inverse=True)
    value = known.of(hashes, lambda places: _word_values(data, starts[one[places]], ends[one[places]], model)) + model.bias
    at = np.flatnonzero(value[back] > FLOOR)
    pairs = np.unique((np.searchsorted(first, at, "right") - 1) * len(one) + back[at])
    texts, found = pairs // len(one), value[pairs % len(one)]
    single = (ends - starts) == 1
    runs = np.flatnonzero(single[2:] & single[1:-1] & single[:-2]) if len(single) > 2 else []
    more = []
    for i in np.unique(np.searchsorted(first, runs, "right") - 1):
        words = [data[a:b].tobytes() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
        joined = sorted(set(_joined(words)))
        for w in joined:
            if parts := [p for u in [w, *_unfilled(w)] for p in _parts(u) if len(p) >= 3]:
                more.append((i, values(_padded(parts), model.table).max() + model.bias))
    if more:
        texts, found = np.append(texts, [i for i, _ in more]).astype(np.int64), np.append(found, [v for _, v in more])
    order = np.lexsort((-found, texts))
    texts, found = texts[order], found[order]
    rank = np.arange(len(texts)) - np.searchsorted(texts, texts)
    top = (rank < TOP) & (found > FLOOR)
    evidence[texts[top], rank[top]] = found[top]
    return evidence


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for piece in pieces(batches, limit=4 << 20):
            score = np.full(len(piece), 0.5) if model is None else model.score(_worst(piece, model, known))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, a row per document row."""
    model = train(training_rows(docs, labels, "toxic", parts, part, per_class))
    out = texts(docs).mapInArrow(_score(model), "doc_id long, score double")
    return out.select("doc_id", held_out(parts, part).alias("held_out"), "score")
