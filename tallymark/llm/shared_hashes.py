"""Which 64-bit hashes two texts have, as filters that tasks get by broadcast.

Tasks send the distinct hashes of some texts, five bytes each, dealt by the hash; the highest bit tells that two texts of the
task have it. Hashes that come twice, or with that bit, set HASHES bits of an array whose size follows their number. The
filter loses none of them and lets others through, the more the fuller it is. Hashes that come from many tasks' lots can have
a filter of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import kept, mixed

#: Bits set per hash, bits of a filter per hash where there is room, the least and the most bits, and those of a slice.
HASHES, ROOM = 3, 5
LEAST, MOST, SLICE = 1 << 21, 1 << 30, 1 << 21
#: Lots a hash comes from before it is a frequent one.
FREQUENT = 16

_REST = (1 << 39) - 1
SENT = "part long, hashes binary"


def _dealt(hashes: np.ndarray, deal: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each hash, and what is kept of it besides."""
    part = hashes % np.uint64(deal)
    return part.astype(np.uint16 if deal <= 1 << 16 else np.int64), (hashes // np.uint64(deal)) & np.uint64(_REST)


def blobs(parts: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row per part with each column's values packed."""
    order = np.argsort(parts, kind="stable")
    parts = parts[order]
    cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(parts)).astype(np.int64)
    arrays = [pa.array(parts[cuts].astype(np.int64))]
    for v in columns.values():
        v = v[order]
        arrays.append(pa.array([v[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["part", *columns])


def lot(hashes: np.ndarray, owners: np.ndarray | None, deal: int) -> pa.RecordBatch:
    """Rows (part, hashes) of what some texts have. Without owners, each text has a hash once."""
    if owners is None:
        hashes = np.sort(hashes)
    else:
        order = np.argsort(hashes)
        hashes, owners = hashes[order], owners[order]
    cuts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    if owners is None:
        two = np.diff(np.append(cuts, len(hashes))) > 1
    else:
        two = np.minimum.reduceat(owners, cuts) < np.maximum.reduceat(owners, cuts)
    part, rest = _dealt(hashes[cuts], deal)
    rest |= two.astype(np.uint64) << np.uint64(39)
    return blobs(part, {"hashes": rest.view(np.uint8).reshape(-1, 8)[:, :5]})


def _met(deal: int):
    """Rows (n, shared, n_frequent, frequent): names of the hashes that two texts have, and of the frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("hashes").to_pylist(), strict=True):
                held.setdefault(part, []).append(raw)
        while held:
            part, lots = held.popitem()
            raw = np.frombuffer(b"".join(lots), np.uint8).reshape(-1, 5)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :5] = raw
            # The bit of two texts stands lowest, so that a hash's last row has it if any has.
            v = wide.view(np.uint64).ravel()
            v = np.sort((v & np.uint64(_REST)) << np.uint64(1) | v >> np.uint64(39))
            rest = v >> np.uint64(1)
            cuts = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
            count = np.diff(np.append(cuts, len(v)))
            names = rest[cuts] * np.uint64(deal) + np.uint64(part)
            shared = names[(count > 1) | (v[cuts + count - 1] & np.uint64(1) > 0)]
            frequent = names[count >= FREQUENT]
            if len(shared):
                columns = [pa.array([len(shared)]), pa.array([shared.tobytes()]), pa.array([len(frequent)]), pa.array([frequent.tobytes()])]
                yield pa.RecordBatch.from_arrays(columns, ["n_shared", "shared", "n_frequent", "frequent"])

    return run


def _bits(names: np.ndarray, size: int) -> np.ndarray:
    """HASHES bit numbers per name."""
    return np.stack([mixed(names + np.uint64(j << 60)) & np.uint64(size - 1) for j in range(1, HASHES + 1)])


def _placed(column: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(batch.schema.get_field_index(column)).to_pylist():
                if raw:
                    bits = np.unique(_bits(np.frombuffer(raw, np.uint64), size).ravel())
                    yield blobs(bits // np.uint64(SLICE), {"bits": (bits % np.uint64(SLICE)).astype(np.uint32)})

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("bits").to_pylist(), strict=True):
            here = found.setdefault(part, np.zeros(SLICE, np.uint8))
            here[np.frombuffer(raw, np.uint32)] = 1
    if found:
        packed = [np.packbits(v).tobytes() for v in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(packed, pa.binary())], ["part", "bits"])


def _filter(found: DataFrame, column: str, least: int) -> bytes:
    n = found.agg(F.sum(f"n_{column}")).first()[0] or 0
    size = least
    while size < MOST and size < ROOM * n:
        size *= 2
    out = np.zeros(size // 8, np.uint8)
    placed = found.select(column).mapInArrow(_placed(column, size), "part long, bits binary").repartition("part")
    for part, raw in kept(placed.mapInArrow(_slices, "part long, bits binary"), "filter").toLocalIterator():
        out[part * SLICE // 8 : (part + 1) * SLICE // 8] = np.frombuffer(bytes(raw), np.uint8)
    return out.tobytes()


def filters(sent: DataFrame, deal: int, frequent: bool = False, least: int = LEAST) -> list[bytes]:
    """The filter of the hashes that two texts have, and that of the frequent ones if asked for, from rows that `lot` made."""
    spark = sent.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = sent.repartition(2 * n, "part").mapInArrow(_met(deal), "n_shared long, shared binary, n_frequent long, frequent binary")
    found = kept(found, "shared-hashes")
    return [_filter(found, column, least) for column in ("shared", "frequent")[: 1 + frequent]]


def passing(hashes: np.ndarray, sieve: bytes, deal: int) -> np.ndarray:
    """Whether the filter has each hash."""
    bits = np.frombuffer(sieve, np.uint8)
    part, rest = _dealt(hashes, deal)
    number = _bits(rest * np.uint64(deal) + part.astype(np.uint64), len(bits) * 8)
    return (bits[number >> np.uint64(3)] >> (7 - (number & np.uint64(7))).astype(np.uint8) & 1).all(0)
