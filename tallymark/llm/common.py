"""What the operators share: intermediate tables, Arrow pieces of bounded size, words and their hashes.

Tables between steps are Parquet below `spark.checkpoint.dir`, so that a lost executor costs a stage at most and no
step is computed twice. Where the setting is absent (tests, a local master) a temporary folder takes its place.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these characters.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: The array of a text's words, as SQL text; backslashes are doubled for the SQL parser.
SPACE_CLASS = "[\\\\x20\\\\x09-\\\\x0D]"
WORDS_SQL = f"filter(split(text, '{SPACE_CLASS}+'), w -> w != '')"
#: Text bytes that a task works on at once; a longer text is a piece of its own.
PIECE = 1 << 20
#: Bytes of rows that Spark hands to a worker at once in `small_batches`.
BATCH = 1 << 21

_MIX = np.uint64(0x9E3779B97F4A7C15)


def work_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file://" + tempfile.mkdtemp(prefix="tallymark-")


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """What the session had set holds again afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once and read back. Shuffles that made it are deleted as soon as it is written, instead of when the
    driver happens to collect its garbage."""
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that `kept` wrote, once what was made from them is written itself."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.kept_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession):
    """Steps that run inside hand their rows to the Python workers in batches of `BATCH` bytes: the executor and the worker hold
    several copies of one each, and keep the room that the largest took. What the session had set holds again afterwards."""
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH)):
        yield


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Id and text by name, a null text as an empty one; other columns only where asked for."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *more)


class Piece:
    """Some texts as one byte array: text i is `data[bounds[i]:bounds[i + 1]]`."""

    def __init__(self, batch: pa.RecordBatch, text: str = "text"):
        self.batch = batch
        column = batch.column(batch.schema.get_field_index(text))
        if column.type == pa.large_string():
            kind = np.int64
        else:
            kind = np.int32
        offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]] if len(offsets) else data[:0]
        self.bounds = offsets - offsets[0]

    def __len__(self) -> int:
        return self.batch.num_rows

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name))

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE) -> Iterator[Piece]:
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = Piece(batch, text).bounds
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
            yield Piece(batch.slice(first, last - first), text)
            first = last


#: Bytes of words: all but spaces; letters, digits and everything beyond ASCII.
SOLID = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
LETTERS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, bounds: np.ndarray, members: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each text (one more entry than texts)."""
    solid = members[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def _constants() -> tuple[np.ndarray, np.uint64, np.uint64]:
    table = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    base = 0xD1342543DE82EF95
    return table, np.uint64(base), np.uint64(pow(base, -1, 1 << 64))


BYTE_VALUE, _BASE, _INVERSE = _constants()
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(1 << n.bit_length(), base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64, out=steps)
    return _powers[kind]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose low and high bits depend on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which `span_hash` gets the polynomial hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * _power("up", _BASE, len(data) + 1)[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: equal for equal bytes wherever they stand."""
    down = _power("down", _INVERSE, len(sums) + 1)
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _MIX)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
