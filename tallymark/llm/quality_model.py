"""Quality classifier: averaged subword embeddings with a softmax output.

The features of a text are hashes of its words, of pairs of adjacent words and of the 3- and 4-byte pieces of its words,
case as written. Each hash bucket has a learned vector; a text is the mean of its features' vectors, and a softmax over
two classes reads it. Both layers are learned by stochastic gradient descent in numpy, on a sample of labelled rows of
bounded size (`PER_CLASS` rows of each label). With two classes the output depends on a vector only through its product
with the difference of the two output rows, so scoring needs one number per bucket; all texts are scored whole.

Cases: null and empty texts, and texts without a word, have no features and get the score of the bias. A null id is
scored and not held out. Repeated rows each get a row. With no labelled rows at all every score is 0.5. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymark.llm.common import Piece, pieces, prefix_hash, span_hash, texts, word_spans
from tallymark.llm.labelled import held_out, training_rows

BUCKETS = 1 << 17
DIMENSION = 16
EPOCHS = 6
#: Largest number of rows of each label that the model learns from.
PER_CLASS = 2000
GRAMS = (3, 4)


def features(piece: Piece) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, boundaries) per kind of feature: text i has buckets[boundaries[i]:boundaries[i + 1]]."""
    data, mask = piece.data, np.uint64(BUCKETS - 1)
    starts, ends, first = word_spans(data, piece.bounds)
    sums = prefix_hash(data)
    words = span_hash(sums, starts, ends)
    out = [((words & mask).astype(np.int32), first)]
    if len(words) > 1:
        pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]
        inside = np.ones(len(pairs), bool)
        cuts = first[1:-1]
        inside[cuts[(cuts > 0) & (cuts < len(words))] - 1] = False
        at = np.flatnonzero(inside)
        out.append((((pairs[at] >> np.uint64(40)) & mask).astype(np.int32), np.searchsorted(at, first)))
    lengths = ends - starts
    place = np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    left = np.repeat(ends, lengths) - place
    for n in GRAMS:
        at = place[left >= n]
        out.append(((span_hash(sums, at, at + n) >> np.uint64(47 - n)).astype(np.int64) & (BUCKETS - 1), np.searchsorted(at, piece.bounds)))
    return out


def _of_text(text: str) -> tuple[np.ndarray, np.ndarray]:
    piece = Piece(pa.RecordBatch.from_arrays([pa.array([text])], ["text"]))
    found = features(piece)
    return np.unique(np.concatenate([b for b, _ in found]), return_counts=True)


def train(rows: list[tuple[str, int]], rate: float = 40.0, seed: int = 5) -> tuple[np.ndarray, float]:
    """(one number per bucket, bias): log odds of label 1 are the mean of a text's numbers plus the bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION)).astype(np.float32)
    output = rng.normal(0, 0.1, (2, DIMENSION)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    if not rows:
        return np.zeros(BUCKETS, np.float32), 0.0
    known = [(_of_text(t), y) for t, y in rows]
    steps, step = EPOCHS * len(known), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(known)):
            (buckets, counts), y = known[i]
            pace = 1 - step / steps
            step += 1
            if not len(buckets):
                continue
            share = (counts / counts.sum()).astype(np.float32)
            mean = share @ vectors[buckets]
            logits = output @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ output
            output -= 0.3 * pace * np.outer(p, mean)
            bias -= 0.02 * pace * p
            vectors[buckets] -= rate * pace * share[:, None] * back
    lean = output[1] - output[0]
    return vectors @ lean, float(bias[1] - bias[0])


def _score(weights: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            total, count = np.zeros(len(piece)), np.zeros(len(piece))
            for buckets, bounds in features(piece):
                sums = np.concatenate([[0.0], np.cumsum(weights[buckets], dtype=np.float64)])
                total += sums[bounds[1:]] - sums[bounds[:-1]]
                count += np.diff(bounds)
            odds = np.clip(total / np.maximum(count, 1) + bias, -500, 500)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(1 / (1 + np.exp(-odds)))], ["doc_id", "score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, parts: int = 4, part: int = 2, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, a row per document row."""
    weights, bias = train(training_rows(docs, labels, "quality", parts, part, per_class))
    out = texts(docs).mapInArrow(_score(weights, bias), "doc_id long, score double")
    return out.select("doc_id", held_out(parts, part).alias("held_out"), "score")
