"""What tasks hold at once is bounded by bytes, whatever the rows."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallymark.llm import common, decontamination, ngram_join


def traced(run):
    tracemalloc.start()
    out = run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


def test_batches_are_of_bounded_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    # Rows as long as texts: 10000 of them, Spark's own limit, would be 26 MB.
    rows = spark.range(0, 5000, 1, 1).select(F.repeat(F.lit("x"), 2600).alias("text"))
    with common.small_batches(spark):
        found = rows.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 5000 and max(r["size"] for r in found) < 1.1 * common.BATCH
    assert spark.conf.get(name) == before


def test_join_and_decontamination_run_in_small_batches(spark, monkeypatch):
    seen = []
    for module in (ngram_join, decontamination):

        def kept(df, label, write=module.kept):
            seen.append((label, spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")))
            return write(df, label)

        monkeypatch.setattr(module, "kept", kept)
    docs = spark.createDataFrame([(i, "the quick brown fox jumps over the lazy dog") for i in range(3)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    assert {r["component_id"] for r in ngram_join.near_components(docs).collect()} == {0}
    assert decontamination.leaks(docs, benchmark).count() == 3
    small = {label for label, size in seen if size == str(common.BATCH)}
    assert {"shingle-nodes", "links", "windows"} <= small


def test_stars_take_few_bytes_a_key():
    rng = np.random.default_rng(3)
    n = 400_000
    batches = []
    for _ in range(8):
        short, nodes = rng.integers(0, 256, (n // 8, 6), dtype=np.uint8), np.sort(rng.integers(0, 1 << 62, n // 8))
        short[::5, 1:] = 7
        columns = [pa.array([3], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in (short, nodes, np.ones(n // 8, np.uint32))]]
        batches.append(pa.RecordBatch.from_arrays(columns, ["part", *ngram_join.PACKED]))
    out, peak = traced(lambda: list(ngram_join._stars(iter(batches))))
    assert out[0].num_rows > 1000
    assert peak < 45 * n
    assert list(ngram_join._stars(iter([]))) == []
    one = [pa.array([3], pa.int64()), *[pa.array([x], pa.binary()) for x in (bytes(12), np.arange(2).tobytes(), np.ones(2, np.uint32).tobytes())]]
    (few,) = ngram_join._stars(iter([pa.RecordBatch.from_arrays(one, ["part", *ngram_join.PACKED])]))
    assert few.to_pydict() == {"a": [1], "b": [0]}


def test_key_rows_take_few_bytes_a_key(monkeypatch):
    monkeypatch.setattr(ngram_join, "FLUSH", 1 << 18)
    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.integers(0, 5000, 400))) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    out, peak = traced(lambda: [b.nbytes for b in ngram_join._key_rows(5, 80, 24)(iter([batch]))])
    assert len(out) > 1 and peak < 30e6


def test_latent_sums_come_in_lots_that_end_at_cuts(monkeypatch):
    rng = np.random.default_rng(5)
    matrix = rng.standard_normal((300, 64)).astype(np.float32)
    cuts = np.unique(np.append(0, rng.integers(0, 40_000, 3000)))
    place, value = rng.integers(0, 300, 40_000), rng.standard_normal(40_000).astype(np.float32)
    whole = np.add.reduceat(matrix[place] * value[:, None], cuts, axis=0)
    for lot in (1, 100, 1 << 13):
        monkeypatch.setattr(decontamination, "ENTRIES", lot)
        out, peak = traced(lambda: decontamination._added_up(cuts, place, value, matrix))
        assert out.dtype == whole.dtype and np.array_equal(out, whole)
    assert peak < 8e6 < place.size * matrix.shape[1] * 4


def test_power_tables_are_as_long_as_asked_for(monkeypatch):
    monkeypatch.setattr(common, "_powers", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    sums = common.prefix_hash(np.full(1000, 65, np.uint8))
    same = common.span_hash(sums, np.array([0, 500]), np.array([7, 507]))
    assert same[0] == same[1]
    assert all(1000 <= len(t) <= 2048 for t in common._powers.values())
