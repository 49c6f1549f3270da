"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

A text is split by the vocabulary's pattern; each piece is encoded by itself. A piece's bytes, read as Latin-1, go once
through an Aho-Corasick automaton of all tokens, which gives the longest token that starts at each byte. From the left,
the longest token is tried first, then its shorter prefixes. A token may follow another only if the merges would keep
exactly these two on their joined bytes; that is found by undoing the later of both tokens' last merges until either a
merge across the border would have come first or nothing is left, and is remembered per pair. Where nothing fits, the
last token is taken back and its end is never tried again: at most one encoding leads to each byte, so each end fails
once and the work is linear in the piece. The result is that of the merges by rank, leftmost first.

The vocabulary must hold all 256 bytes, and each longer token must come from two tokens of lower rank; a file that does
not raises `ValueError`. It is read and checked by the driver (a file of at most `VOCABULARY` bytes) and sent to the tasks.

Cases: a null text is empty and gives no ids. Very long texts and very long pieces (a text of one letter) take memory of
a constant times their bytes, in one task. A null or repeated id is a row like others. Characters that the pattern does
not match are lost, as in the library whose files these are; the pattern of the given vocabularies matches all. Other
columns stay, except those named like the new column, which is replaced. An empty table gives an empty result. An id
outside the vocabulary raises when decoded; null ids decode to no bytes.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from tallymark.llm.common import pieces

#: Largest size of a vocabulary file.
VOCABULARY = 64 << 20
#: Pairs that a task remembers before it starts anew; pieces that it remembers in each of two generations, of which the
#: older one goes when the newer is full; and the longest such piece.
PAIRS, PIECES, PIECE_LENGTH = 1 << 20, 1 << 19, 64


class ByteBPE:
    def __init__(self, vocabulary: bytes):
        self.tokens: dict[int, bytes] = {}
        for line in vocabulary.splitlines():
            if line:
                token, rank = line.split()
                self.tokens[int(rank)] = base64.b64decode(token)
        self.ranks = {token: rank for rank, token in self.tokens.items()}
        if len(self.ranks) < len(self.tokens) or any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a vocabulary holds each token once and all single bytes")
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, dict[int, bool]] = {}
        self.n_pairs = 0
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            made.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        made.make_automaton()
        return made

    @cached_property
    def tries(self) -> dict[int, tuple[tuple[int, int], ...]]:
        """Per token what to try in its place: itself and its prefixes, longest first, each with its size."""
        made: dict[int, tuple[tuple[int, int], ...]] = {}
        for token, rank in sorted(self.ranks.items(), key=lambda pair: len(pair[0])):
            shorter = next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), None)
            made[rank] = ((rank, len(token)), *made.get(shorter, ()))
        return made

    def check(self) -> None:
        for rank in self.tokens:
            self._halves(rank)

    def _halves(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives this one: merges by rank until two parts are left."""
        if rank in self.halves:
            return self.halves[rank]
        token, ranks = self.tokens[rank], self.ranks
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            joined = [ranks.get(a + b, -1) for a, b in zip(parts, parts[1:], strict=False)]
            best = min((r for r in joined if r >= 0), default=-1)
            if best < 0:
                break
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) > 2 or len(parts) == 2 and max(ranks[p] for p in parts) >= rank:
            raise ValueError(f"{token!r} does not come from two tokens of lower rank")
        found = self.halves[rank] = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None
        return found

    def _adjacent(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens apart.

        Going back in time on both sides of the border: whichever inner token was made last is replaced by its half at
        the border. A merge across the border counts if it ranks before what is known to have been made later; of equal
        ranks the left one was made first.
        """
        tokens, ranks, halves = self.tokens, self.ranks, self._halves
        before = 1 << 62
        while True:
            if ranks.get(tokens[left] + tokens[right], before) < before:
                return False
            if left > right:
                before, later = left, "left"
            else:
                before, later = right + 1, "right"
            made = halves(left if later == "left" else right)
            if made is None:
                later = "right" if later == "left" else "left"
                made = halves(left if later == "left" else right)
                if made is None:
                    return True
                before = left if later == "left" else right + 1
            if later == "left":
                left = made[1]
            else:
                right = made[0]

    def _fits(self, last: int, row: dict[int, bool], token: int) -> bool:
        """`_adjacent`, remembered in the row of the left token; anything may come first."""
        if self.n_pairs >= PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        found = row[token] = last < 0 or self._adjacent(last, token)
        return found

    def piece(self, data: bytes) -> list[int]:
        """The ids of one piece."""
        size, pairs, all_tries = len(data), self.pairs, self.tries
        longest = [0] * size
        for end, (back, rank) in self.automaton.iter(data.decode("latin-1")):
            longest[end - back] = rank
        open_ends = bytearray(b"\x01") * (size + 1)
        out: list[int] = []
        at, last = 0, -1
        tries = all_tries[longest[0]] if size else ()
        while at < size:
            row = pairs.get(last)
            if row is None:
                row = pairs[last] = {}
            for token, n in tries:
                if open_ends[at + n]:
                    fits = row.get(token)
                    if fits or fits is None and self._fits(last, row, token):
                        out.append(token)
                        last = token
                        at += n
                        if at < size:
                            tries = all_tries[longest[at]]
                        break
            else:
                open_ends[at] = 0
                tries = all_tries[out.pop()]
                at -= tries[0][1]
                last = out[-1] if out else -1
        return out

    def encode(self, text: str, split: Callable[[str], list[str]]) -> bytes:
        """The ids of a text as 32-bit integers, one after the other."""
        if len(self.known) >= PIECES:
            self.known, self.older = {}, self.known
        known, older, found = self.known, self.older, split(text)
        new = set(found).difference(known)
        for piece in new:
            ids = older.get(piece)
            known[piece] = array("i", self.piece(piece.encode())).tobytes() if ids is None else ids
        out = b"".join(map(known.__getitem__, found))
        for piece in new:
            if len(piece) > PIECE_LENGTH:
                del known[piece]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _loaded(vocabulary: bytes) -> ByteBPE:
    """One per vocabulary in each Python worker."""
    return ByteBPE(vocabulary)


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        found = file.read(VOCABULARY + 1)
    if len(found) > VOCABULARY:
        raise ValueError(f"{path} is larger than {VOCABULARY} bytes")
    ByteBPE(found).check()
    return found


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with the column `name` in last place."""
    rest = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), values], [*(batch.schema.names[i] for i in rest), name])


def _schema(df: DataFrame, name: str, kind) -> StructType:
    return StructType([f for f in df.schema.fields if f.name != name]).add(name, kind)


Batches = Iterator[pa.RecordBatch]


def _encoder(sent: Broadcast, pattern: str, text: str, ids: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        bpe, split = _loaded(sent.value), regex.compile(pattern)
        whole = (lambda s: [m.group() for m in split.finditer(s)]) if split.groups else split.findall
        for piece in pieces(batches, text):
            found = [bpe.encode(piece.text(i).decode(), whole) for i in range(len(piece))]
            ends = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(f) // 4 for f in found], out=ends[1:])
            flat = np.frombuffer(b"".join(found), np.int32)
            yield _replaced(piece.batch, ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))

    return run


def _decoder(sent: Broadcast, ids: str, data: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        bpe = _loaded(sent.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            found = [bpe.decode(column[i].as_py() or ()) for i in range(len(column))]
            yield _replaced(batch, data, pa.array(found, pa.binary()))

    return run


def _sent(df: DataFrame, vocabulary: str) -> Broadcast:
    return df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))


def _given(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))


def encoded(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with the ids of their texts as array `ids`."""
    given = _given(docs, text)
    run = _encoder(_sent(docs, vocabulary), pattern, text, ids)
    return given.mapInArrow(run, _schema(given, ids, ArrayType(IntegerType())))


def decoded(rows: DataFrame, vocabulary: str, ids: str = "ids", data: str = "data") -> DataFrame:
    """The rows with the bytes of their ids as binary column `data`; they need not be whole characters."""
    return rows.mapInArrow(_decoder(_sent(rows, vocabulary), ids, data), _schema(rows, data, BinaryType()))


def digest(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per row the number of ids, their digest, and that of the bytes they decode to.

    `encoded` and `decoded` in one Python task, so that a core keeps one vocabulary and not two.
    """
    sent, given = _sent(docs, vocabulary), _given(docs.select("doc_id", "text"), "text")
    encode, decode = _encoder(sent, pattern, "text", "ids"), _decoder(sent, "ids", "data")
    kinds = StructType().add("doc_id", docs.schema["doc_id"].dataType).add("ids", ArrayType(IntegerType())).add("data", BinaryType())

    def run(batches: Batches) -> Batches:
        for batch in decode(encode(batches)):
            yield batch.select(kinds.names)

    return given.mapInArrow(run, kinds).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
