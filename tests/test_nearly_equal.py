"""Comparisons whose shuffles grow with the differences, names of every kind, sorted parts, profiles of growing tables."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import tallymark.operators.sorting as sorting
from tallymark.operators import buckets, reconcile
from tallymark.operators.align import align
from tallymark.operators.discovery import candidate_keys, renamed_columns
from tallymark.operators.incremental import files, profile_incremental
from tallymark.operators.multiset import bag_diff
from tallymark.operators.profile import profile
from tallymark.operators.rows import duplicate_keys, keyed_diff, numbered, positional_diff, row_status_counts
from tallymark.plans.compare import compare
from tallymark.session import written

SCHEMA = "k int, a int, b string"


def rows_of(df):
    return Counter(map(repr, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def sides(spark):
    """Copies, nulls, a key of many rows; changed, lost and added rows."""
    rng = random.Random(2)
    data = [(rng.choice([None, 1, *range(400)]), rng.choice([None, 1, 2]), rng.choice([None, "x", "y"])) for _ in range(3000)]
    target = [r for r in data if rng.random() > 0.01] + [(r[0], 9, r[2]) for r in data[:20]] + data[100:110] * 3
    return spark.createDataFrame(data, SCHEMA).repartition(5), spark.createDataFrame(target, SCHEMA).repartition(3)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ buckets


@pytest.mark.parametrize("keys", [None, ["k"]])
def test_bag_diff_by_buckets(sides, keys):
    assert rows_of(buckets.bag_diff_by_buckets(*sides, keys)) == rows_of(bag_diff(*sides))


def test_one_changed_row_reads_one_bucket(spark):
    source = spark.range(200000).selectExpr("id as k", "id % 7 as v", "if(id % 3 = 0, null, 'x') as s")
    target = source.selectExpr("k", "if(k = 777, 99L, v) as v", "s")
    pair = buckets.narrowed(align(source, target), ["k"])
    # 65536 buckets hold three rows on average.
    assert pair.source.count() < 20 and pair.target.where("k = 777 and v = 99").count() == 1
    same = buckets.narrowed(align(source, source.repartition(3)), ["k"])
    assert same.source.count() == same.target.count() == 0
    assert rows_of(buckets.bag_diff_by_buckets(source, target, ["k"])) == Counter(["(777, 0, 'x', 1, 0)" if 777 % 3 else "(777, 0, None, 1, 0)", "(777, 99, 'x', 0, 1)" if 777 % 3 else "(777, 99, None, 0, 1)"])


def test_trees_add_up_and_shuffle_sums_only(sides):
    source, target = align(*sides).coded()
    tree = written(buckets.digest_tree(source), "tree")
    for level, bits in enumerate(buckets.LEVELS):
        nodes = tree.where(f"level = {level}")
        assert nodes.agg(F.sum("n_rows")).first()[0] == 3000 and nodes.count() <= 1 << bits
    text = plan(buckets.digest_tree(source))
    for below in text.split("Exchange hashpartitioning(")[1:]:
        assert "partial_sum" in below.split("Exchange")[0]
    assert buckets.differing_buckets(tree, tree) == []
    other = written(buckets.digest_tree(target), "tree")
    found = buckets.differing_buckets(tree, other)
    leaves = [{r["node"]: tuple(r) for r in t.where("level = 2").collect()} for t in (tree, other)]
    assert found == sorted(n for n in leaves[0].keys() | leaves[1].keys() if leaves[0].get(n) != leaves[1].get(n))


def test_buckets_with_lost_columns(spark):
    source, target = spark.sql("select 1 as k, 'a' as b"), spark.sql("select 1 as k, 'a' as b, 2 as c")
    assert rows_of(buckets.bag_diff_by_buckets(source, target)) == rows_of(bag_diff(source, target))


# ------------------------------------------------------------------ set reconciliation


@pytest.mark.parametrize("first", [3, 6, 10])
def test_hashes_of_differing_rows(sides, first):
    """Small first tables get stuck and grow."""
    pair = align(*sides)
    found = reconcile.differing_hashes(pair, first)
    source, target = (Counter(r[0] for r in df.selectExpr(reconcile.row_hash(pair.codes, 3)).collect()) for df in pair.coded())
    assert Counter(found) == Counter(h for h in source.keys() | target.keys() if source[h] != target[h])
    assert reconcile.differing_hashes(pair, 2, 3) is None


def test_keyed_diff_small(spark, sides, monkeypatch):
    want = keyed_diff(*sides, ["k"])
    for most in (reconcile.MOST, 4):
        monkeypatch.setattr(reconcile, "differing_hashes", lambda pair, full=reconcile.differing_hashes, most=most: full(pair, min(4, most), most))
        got = reconcile.keyed_diff_small(*sides, ["k"])
        assert rows_of(got.rows) == rows_of(want.rows) and rows_of(got.cells()) == rows_of(want.cells())
        monkeypatch.undo()
    same = reconcile.keyed_diff_small(sides[0], sides[0].repartition(2), ["k"])
    assert same.rows.count() == 0


def test_colliding_hashes_are_told():
    """Two rows of one hash, one on each side, cancel but for their second hash: the table does not come out empty."""
    cells = [dict(cell=c, n=0, low=0, high=0, crc=0, other=5) for c in (1, 17, 40)]
    assert reconcile.peeled(cells, 4) is None and reconcile.peeled([], 4) == []


def test_what_is_shuffled_does_not_grow_with_the_rows(spark):
    for n in (1000, 100000):
        same = spark.range(n).selectExpr("id as k", "id * 3 as v")
        other = same.selectExpr("k", "if(k in (5, 500), -1L, v) as v")
        cells = reconcile.lookup_table(align(same, other), reconcile.FIRST)
        text = plan(cells)
        assert text.count("Exchange") == 1 and "partial_sum" in text.split("Exchange hashpartitioning(cell")[1]
        assert cells.count() <= 12


# ------------------------------------------------------------------ names

NAMES = ["status", "source", "target", "s", "t", "row", "occurrence", "matched", "place", "part", "cuts", "n_source", "lo", "hi", "bucket", "c0", "c1", "column", "diff", "row_index"]


@pytest.mark.parametrize("name", NAMES)
def test_any_name(spark, name):
    """Keys and values called like helpers and like the reports' own columns."""
    plain = [spark.sql(f"select id % 50 as k, {v} as v, 'x' as w from range(200)") for v in ("id % 5", "if(id % 20 = 3, null, id % 5)")]
    as_key, as_value = ([df.toDF(*names) for df in plain] for names in ((name, "v", "w"), ("k", name, "w")))
    want = keyed_diff(*plain, ["k"])
    got = keyed_diff(*as_key, [name])
    assert rows_of(got.cells()) == rows_of(want.cells()) and rows_of(got.rows.select(got.by)) == rows_of(want.rows.select("k", "occurrence"))
    assert got.cells().columns[:2] == got.by and len(set(got.cells().columns)) == 6
    assert rows_of(got.statuses()) == rows_of(want.statuses()) and rows_of(got.columns()) == rows_of(want.columns())
    assert rows_of(row_status_counts(*as_key, [name])) == rows_of(row_status_counts(*plain, ["k"]))
    assert rows_of(duplicate_keys(*as_key, [name])) == rows_of(duplicate_keys(*plain, ["k"]))
    assert rows_of(compare(*as_key, [name]).summary()) == rows_of(compare(*plain, ["k"]).summary())
    assert rows_of(bag_diff(*as_value)) == rows_of(bag_diff(*plain)) == rows_of(compare(*as_value, mode="bag").bag)
    assert len(positional_diff(*as_value).cells().collect()) == len(positional_diff(*plain).cells().collect())


def test_names_of_clashing_report_columns(spark):
    df, other = spark.sql("select 1 as source_extra, 2 as remarks"), spark.sql("select 1 as source_extra, 3 as remarks, 4 as x")
    assert bag_diff(df, other).columns == ["source_extra", "remarks", "source_extra_", "target_extra", "remarks_"]
    assert keyed_diff(df, other, ["source_extra"], unique=True).cells().columns == ["source_extra", "occurrence", "column", "source_value", "target_value", "diff"]
    named = spark.sql("select 1 as status, 1 as occurrence, 1 as diff, 2 as v")
    diff = keyed_diff(named, named.withColumn("v", F.lit(3)), ["status", "occurrence", "diff"])
    assert diff.cells().columns == ["status", "occurrence", "diff", "occurrence_", "column", "source_value", "target_value", "diff_"]
    assert diff.rows.columns == ["status", "occurrence", "diff", "occurrence_", "status_", "source", "target"]


# ------------------------------------------------------------------ sorted parts


def test_sorted_parts(spark, monkeypatch):
    """Long common prefixes, few values in front, nulls last, and each part in one task."""
    monkeypatch.setattr(sorting, "LEAST", 50)
    rng = random.Random(1)
    data = [(rng.choice([None, "a", "b"]), "prefix" * 20 + str(rng.randrange(10**6)), rng.choice([None, 1.5, -2.0]), i) for i in range(4000)]
    df = written(spark.createDataFrame(data, "flag string, text string, x double, id int"), "sorted")
    columns = ["flag", "text", "x", "id"]
    got = sorting.sorted_parts(df, columns)[0].withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r["id"] for r in got) == list(range(4000))
    assert len({(r["part"], r["task"]) for r in got}) == len({r["part"] for r in got}) == 8

    def key(r):
        return tuple((r[c] is None, r[c] if r[c] is not None else 0) for c in columns)

    parts = {}
    for r in got:
        parts.setdefault(r["part"], []).append(key(r))
    order = [parts[p] for p in sorted(parts)]
    assert all(max(a) < min(b) for a, b in zip(order, order[1:]))
    assert max(map(len, order)) < 3 * 4000 / 8


def test_sample_is_bounded_and_short(spark, monkeypatch):
    asked = []
    df = written(spark.range(100000).selectExpr("id", "repeat('x', 2000) as wide"), "wide")
    taken = type(df).limit
    monkeypatch.setattr(type(df), "limit", lambda self, n: asked.append((n, self)) or taken(self, n))
    cuts = sorting.splitters(df, ["id", "wide"], 8, 100000).first()["cuts"]
    assert len(cuts) == 7 and max(len(c["v1"]) for c in cuts) <= sorting.LETTERS
    assert [n for n, sample in asked if n > 1] == [2 * sorting.SAMPLED * 8]


def test_numbering_needs_one_shuffle(spark, monkeypatch):
    """The windows know how the parts lie: no shuffle by hash of a part's number."""
    seen = []
    monkeypatch.setattr("tallymark.operators.rows.written", lambda df, label: seen.append((label, plan(df))) or written(df, label))
    monkeypatch.setattr(sorting, "LEAST", 100)
    runs = spark.range(5000).selectExpr("id % 10 as c0", "id as c1", "1L as n_source", "2L as n_target")
    got = numbered(runs, ["c0"], ["c1"]).collect()
    text = dict(seen)["parts"]
    assert text.count("Exchange") - text.count("ReusedExchange") == 1 and "shufflepartitionidpassthrough" in text
    assert "hashpartitioning(part" not in text and "rangepartitioning" not in text
    for r in got:
        assert (r["source_at"], r["target_at"]) == (r["c1"] // 10, 2 * (r["c1"] // 10))


# ------------------------------------------------------------------ counts on the way


@pytest.mark.parametrize("keys,mode", [(["k"], "auto"), (None, "bag"), (None, "auto")])
def test_counts_come_with_the_pairing(sides, monkeypatch, keys, mode):
    def never():
        raise AssertionError("a job of its own for a count")

    aligned = align(*sides)
    for df in (aligned.source, aligned.target):
        monkeypatch.setattr(df, "count", never)
    monkeypatch.setattr("tallymark.plans.compare.align", lambda *_: aligned)
    got = compare(*sides, keys, mode)
    monkeypatch.undo()
    assert (got.count_source, got.count_target) == (sides[0].count(), sides[1].count())
    assert got.summary().count() == 2


# ------------------------------------------------------------------ growing tables


def test_only_new_files_are_read(spark, tmp_path, monkeypatch):
    path, store = f"{tmp_path}/table", f"{tmp_path}/store"
    read = []
    partials = profile_incremental.__globals__["_partials"]
    monkeypatch.setitem(profile_incremental.__globals__, "_partials", lambda s, paths, *a: read.append(len(paths)) or partials(s, paths, *a))

    row = ["id", "if(id % 3 = 0, null, cast(id as string)) as `odd name`", "cast(id as double) / 3 as x", "timestamp_ntz '2024-01-01' as ts"]
    for n, want in ((10, 1), (30, 1), (0, None), (5, 1)):
        if n:
            spark.range(n).selectExpr(*row).coalesce(1).write.mode("append").parquet(path)
        before = len(read)
        got = profile_incremental(spark, path, store)
        assert read[before:] == ([want] if want else [])
        assert rows_of(got) == rows_of(profile(spark.read.parquet(path)))
    # A file that is gone drops out; without files nothing is left to sum.
    lost = files(spark, path).orderBy("length").first()["path"]
    (tmp_path / "table" / lost.rsplit("/", 1)[1]).unlink()
    spark.catalog.refreshByPath(path)
    assert rows_of(profile_incremental(spark, path, store)) == rows_of(profile(spark.read.parquet(path)))


def test_a_new_column_is_a_new_profile(spark, tmp_path):
    path, store = f"{tmp_path}/table", f"{tmp_path}/store"
    spark.range(5).coalesce(1).write.parquet(path)
    profile_incremental(spark, path, store)
    spark.range(7).selectExpr("id", "'x' as s").coalesce(1).write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    assert rows_of(profile_incremental(spark, path, store)) == rows_of(profile(spark.read.parquet(path)))


def test_values_that_do_not_fit_stay_incomplete(spark, tmp_path):
    path, store = f"{tmp_path}/table", f"{tmp_path}/store"
    for big in ("1D", "1e300D"):
        spark.sql(f"select {big} as x").write.mode("append").parquet(path)
    assert rows_of(profile_incremental(spark, path, store)) == rows_of(profile(spark.read.parquet(path)))


# ------------------------------------------------------------------ renamed columns, keys


def test_renamed_columns(spark):
    df = spark.range(20000).selectExpr("id as k", "id * 7 % 9001 as a", "concat('n', id % 300) as b", "id % 2 as same", "cast(id as double) / 7 as x")
    other = df.where("k % 20 > 0").selectExpr("k", "cast(a as int) as `A new`", "b as `odd.name`", "same + 5 as `unlike`", "'n1' as few", "x as ratio")
    got = {(r["source_column"], r["target_column"]): r["overlap"] for r in renamed_columns(df, other).collect()}
    assert set(got) == {("a", "a new"), ("b", "odd.name"), ("x", "ratio")} and all(0.85 < v <= 1 for v in got.values())
    assert renamed_columns(df, df).count() == 0 and renamed_columns(df, df.select("k")).count() == 0
    empty = renamed_columns(df.limit(0), other.limit(0))
    assert empty.columns == ["source_column", "target_column", "overlap"] and empty.count() == 0


def test_candidate_keys(spark):
    df = spark.range(5000).selectExpr("id % 50 as a", "id div 50 as b", "id % 10 as c", "if(id = 7, null, id) as gap", "concat('x', id) as `odd, name`", "id % 500 as d", "id div 500 as e")
    got = {(r["key"], r["n_columns"]) for r in candidate_keys(df).collect()}
    # b is the hundreds of halves: b with a, and d with e, number the rows.
    assert got == {("odd, name", 1), ("a, b", 2), ("d, e", 2), ("b, d", 2)}
    assert candidate_keys(df.select("a", "c")).count() == 0
    nearly = spark.range(5000).selectExpr("if(id = 9, 8, id) as k", "id % 2 as p")
    assert [r["key"] for r in candidate_keys(nearly).collect()] == ["k, p"]
    three = spark.range(4096).selectExpr("id % 16 as a", "id div 16 % 16 as b", "id div 256 as c")
    assert [r["key"] for r in candidate_keys(three, 3).collect()] == ["a, b, c"] and candidate_keys(three).count() == 0


def test_growing_table_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from tallymark.queries import registry

    rows = spark.range(400).selectExpr(
        "id as o_orderkey", "id as o_custkey", "'F' as o_orderstatus", "cast(id as double) as o_totalprice", "timestamp_ntz '2024-01-02 00:00:00' as o_orderdate", "'1-URGENT' as o_orderpriority"
    )
    rows.repartition(4).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(registry, "new_folder", lambda s, name: f"{tmp_path}/{name}")
    got = registry.q_profile_incremental(spark, str(tmp_path))
    assert rows_of(got) == rows_of(profile(registry.table(spark, str(tmp_path), "orders_target")))
    for i in range(2):
        assert len(list((tmp_path / "growing" / f"part={i}").glob("*.parquet"))) > 1
