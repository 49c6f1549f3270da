"""Secret scan: all rules compiled to one deterministic automaton that reads every byte once.

The automaton tells which rules match in which text. Only there the rule's own regex gives the spans: leftmost,
non-overlapping, a match that misses its length taking its characters with it. Rules beyond the base ones add spans.

Cases: null text is an empty one: no spans. Repeated rows each get a row, a null id is kept. An empty table gives an
empty result. Columns other than doc_id and text are ignored by `scan` and handed through by `redacted`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.automaton import RESET, Automaton
from tallymark.llm.common import pieces, texts

_VALUE = "[A-Za-z0-9+/_.=-]"


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORD = "(" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
_ASSIGN = _KEYWORD + "[\"']?\\x20*[:=]\\x20*[\"']?"

#: kind: (what the automaton looks for, the regex of a span, the group whose length counts, that length). The first may be
#: looser than the second, never tighter: long counts over a class that holds the rule's own first letters would multiply states.
RULES: dict[str, tuple[str, str, int, int]] = {
    "assign": (_ASSIGN + _VALUE + "{6}", _ASSIGN + f"({_VALUE}+)", 2, 6),
    "access": ("AKIA[A-Z0-9]{4}", "AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]{24}", "[0-9a-f]+", 0, 24),
    "github": ("gh[opsur]_[A-Za-z0-9]", "gh[opsur]_[A-Za-z0-9]{36,}", 0, 0),
    "slack": ("xox[abprs]-[A-Za-z0-9-]", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    "google": ("AIza[A-Za-z0-9_-]", "AIza[A-Za-z0-9_-]{35}", 0, 0),
    "jwt": ("eyJ[A-Za-z0-9_-]+\\.eyJ", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+", 0, 0),
    "pem": ("-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
}
KINDS = list(RULES)
BASE = KINDS[:3]


@cache
def automaton() -> Automaton:
    return Automaton({kind: rule[0] for kind, rule in RULES.items()})


@cache
def _regex(kind: str) -> re.Pattern:
    return re.compile(RULES[kind][1].encode())


def _spans(text: bytes, bits: int) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) in code points, of the kinds in `bits`."""
    found = []
    for rank, kind in enumerate(KINDS):
        if bits >> rank & 1:
            _, _, group, least = RULES[kind]
            found += [(m.start(), rank, m.end()) for m in _regex(kind).finditer(text) if m.end(group) - m.start(group) >= least]
    if not text.isascii():
        raw = np.frombuffer(text, np.uint8)
        points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        found = [(int(points[a]), rank, int(points[b])) for a, rank, b in found]
    return sorted(found)


SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine = automaton()
    for piece in pieces(batches):
        # Texts end to end with a resetting byte after each.
        ends = piece.bounds[1:] + np.arange(len(piece))
        laid = np.full(len(piece.data) + len(piece), RESET, np.uint8)
        gaps = np.zeros(len(laid), bool)
        gaps[ends] = True
        laid[~gaps] = piece.data
        at, bits = machine.hits(laid)
        which = np.zeros(len(piece), np.int64)
        np.bitwise_or.at(which, np.searchsorted(ends, at), bits)
        spans: list[list[dict]] = [[] for _ in range(len(piece))]
        for i in np.flatnonzero(which):
            spans[i] = [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in _spans(piece.text(i), int(which[i]))]
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(spans, _ARROW)], ["doc_id", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and its spans by start, then kind as listed; code points, end exclusive. A row per document row."""
    return texts(docs).mapInArrow(_scan, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    base = ", ".join(f"'{k}'" for k in BASE)
    joined = "array_join(transform({0}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(joined.format(f"filter(spans, s -> s.kind IN ({base}))")), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )


def _redact(batches: Iterator[pa.RecordBatch], mark: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        texts_out = []
        for text, spans in rows:
            out, done = [], 0
            for s in spans or ():
                if s["end"] > done:
                    out += [text[done : max(done, s["start"])], mark if s["start"] >= done else ""]
                    done = s["end"]
            texts_out.append(text if not spans else "".join(out) + text[done:])
        yield pa.RecordBatch.from_arrays([pa.array(texts_out, pa.string()), *batch.columns[2:]], ["text", *batch.schema.names[2:]])


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents, all rows and columns, with each secret replaced in `text`; `n_chars`, where there, follows."""
    others = [c for c in docs.columns if c != "text"]
    schema = docs.schema
    names = [f"c{i}" for i in range(len(others))]
    numbered = docs.select("text", *[F.col(f"`{c}`").alias(n) for c, n in zip(others, names, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _named(batches):
            yield from _redact(iter([piece]), mark)

    kinds = ", ".join(["text string", *[f"{n} {schema[c].dataType.simpleString()}" for c, n in zip(others, names, strict=True)]])
    out = numbered.mapInArrow(run, kinds)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            columns.append(F.char_length("text").cast(schema[c].dataType).alias(c))
        else:
            columns.append(F.col(names[others.index(c)]).alias(c))
    return out.select(*columns)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of text, spans and the other columns."""
    for piece in pieces(batches):
        column = piece.column("text")
        filled = pa.RecordBatch.from_arrays([pa.nulls(len(piece), pa.int64()), column.fill_null("")], ["doc_id", "text"])
        spans = next(_scan(iter([filled]))).column(1)
        others = [i for i, name in enumerate(piece.batch.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [column, spans, *[piece.batch.column(i) for i in others]],
            ["text", "spans", *[piece.batch.schema.names[i] for i in others]],
        )
