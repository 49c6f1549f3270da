import random
from collections import Counter

import pytest

import tallymark.operators.rows as rows_module
from tallymark.operators.multiset import bag_diff, is_equal, table_equality
from tallymark.operators.rows import duplicate_keys, keyed_diff, positional_diff, row_status_counts
from tallymark.plans.compare import compare

SCHEMA = "k int, a int, b string"


def last_null(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def keyed_brute(source, target):
    """Cancel equal rows, then pair what is left within a key by sorted order."""
    s, t = Counter(source), Counter(target)
    extra = [(s - t), (t - s)]
    out = []
    for key in {r[0] for c in extra for r in c}:
        left, right = (sorted((r[1:] for r in c.elements() if r[0] == key), key=last_null) for c in extra)
        for i in range(max(len(left), len(right))):
            out.append((key, i, left[i] if i < len(left) else None, right[i] if i < len(right) else None))
    return sorted(out, key=repr)


def positional_brute(source, target):
    s, t = sorted(source, key=last_null), sorted(target, key=last_null)
    pairs = [
        (i, s[i] if i < len(s) else None, t[i] if i < len(t) else None) for i in range(max(len(s), len(t)))
    ]
    return [p for p in pairs if p[1] != p[2]]


def random_rows(rng, n, keys):
    return [
        (rng.choice(keys), rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])) for _ in range(n)
    ]


def changed(rng, data):
    out = [r for r in data if rng.random() > 0.1]
    out = [(r[0], 9, r[2]) if rng.random() < 0.1 else r for r in out]
    return out + [r for r in data if rng.random() < 0.1] + [(99, 1, "new")]


def struct(row):
    return None if row is None else tuple(row)


@pytest.mark.parametrize("seed", range(3))
def test_keyed_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(rows_module, "BUCKET", 3)
    rng = random.Random(seed)
    # A third of all rows under one key.
    source = random_rows(rng, 200, list(range(40)) + [7] * 20 + [None])
    target = changed(rng, source)
    s, t = spark.createDataFrame(source, SCHEMA).repartition(5), spark.createDataFrame(target, SCHEMA)
    diff = keyed_diff(s, t, ["k"])
    got = [(r["k"], r["occurrence"], struct(r["source"]), struct(r["target"])) for r in diff.rows.collect()]
    expected = keyed_brute(source, target)
    assert sorted(got, key=repr) == expected
    statuses = {r["status"]: r["n_rows"] for r in row_status_counts(s, t, ["k"]).collect()}
    both = sum(1 for r in expected if r[2] and r[3])
    assert statuses["mismatch"] == both
    assert statuses["source_only"] == sum(1 for r in expected if not r[3])
    assert statuses["target_only"] == sum(1 for r in expected if not r[2])
    assert statuses["match"] == sum((Counter(source) & Counter(target)).values())
    # What is on one side and not the other adds up.
    assert len(source) + statuses["target_only"] == len(target) + statuses["source_only"]
    cells = {(r["k"], r["occurrence"], r["column"]): r["diff"] for r in diff.cells().collect()}
    want = {}
    for key, i, left, right in expected:
        if left and right:
            for name, x, y in zip(("a", "b"), left, right):
                if x != y:
                    shown = ["null" if v is None else str(v) for v in (x, y)]
                    want[(key, i, name)] = " vs ".join(shown)
    assert cells == want
    columns = {r["column"]: r["n_mismatch"] for r in diff.columns().collect()}
    assert columns == dict(Counter(c for _, _, c in want))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bucket", [2, 4096])
def test_positional_against_brute_force(spark, monkeypatch, seed, bucket):
    monkeypatch.setattr(rows_module, "BUCKET", bucket)
    rng = random.Random(seed)
    source = random_rows(rng, 150, [1, 2, 3, 4, None])
    target = changed(rng, source)
    diff = positional_diff(
        spark.createDataFrame(source, SCHEMA).repartition(4), spark.createDataFrame(target, SCHEMA)
    )
    got = sorted((r["row_index"], struct(r["source"]), struct(r["target"])) for r in diff.rows.collect())
    assert got == positional_brute(source, target)


def test_one_row_fills_a_third(spark):
    """A long run of one row is laid out over many buckets, and only where the sides differ."""
    source = spark.sql("select 5 as a, 'x' as b from range(30000) union all select int(id), 'y' from range(100, 60100)")
    target = spark.sql("select 6 as a, 'x' as b from range(30000) union all select int(id), 'y' from range(100, 60100)")
    diff = positional_diff(source, target)
    assert diff.rows.count() == 30000
    assert {(r["column"], r["n_mismatch"]) for r in diff.columns().collect()} == {("a", 30000)}
    assert diff.rows.selectExpr("min(row_index)", "max(row_index)").first() == (0, 29999)


def test_one_key_fills_a_third(spark):
    source = spark.sql("""
        select if(id < 20000, 1, int(id)) as k, int(id) as a, 'x' as b from range(60000)""")
    target = source.selectExpr("k", "a", "if(k = 1 and a % 2 = 0, 'z', b) as b").where("a <> 5")
    diff = keyed_diff(source, target, ["k"])
    got = {r["status"]: r["n_rows"] for r in diff.statuses().collect()}
    assert got == {"mismatch": 10000, "source_only": 1}
    # Ten thousand rows of the key differ in one column, but one row is gone: past it pairs are shifted.
    assert diff.rows.where("k <> 1").count() == 0
    assert diff.rows.selectExpr("count(distinct occurrence)").first()[0] == 10001


def test_mirror(spark):
    rng = random.Random(5)
    source = random_rows(rng, 80, list(range(10)))
    target = changed(rng, source)
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA)
    there = {(tuple(r)[:3], r["source_extra"], r["target_extra"]) for r in bag_diff(s, t).collect()}
    back = {(tuple(r)[:3], r["target_extra"], r["source_extra"]) for r in bag_diff(t, s).collect()}
    assert there == back
    assert sum(x for _, x, _ in there) == sum((Counter(source) - Counter(target)).values())


def test_a_table_equals_itself_in_any_order(spark):
    df = spark.sql("""
        select id % 7 as a, cast(null as string) as b, array(id % 2, null) as c, map('k', id % 3) as m,
               named_struct('x', if(id % 5 = 0, double('NaN'), id)) as s, binary('q') as d from range(100)""")
    turned = df.repartition(9).select("s", "d", "m", "c", "b", "a")
    assert is_equal(df, turned) and is_equal(df, turned, fast=True)
    assert bag_diff(df, turned).count() == 0
    assert table_equality(df, turned).first()["status"] == "Data Match"
    assert positional_diff(df, turned).rows.count() == 0
    assert keyed_diff(df, turned, ["a"]).rows.count() == 0
    assert not is_equal(df, df.limit(99))
    assert not is_equal(df, df.drop("m"))


def test_fingerprint_sees_where_nulls_stand(spark):
    left = spark.sql("select cast(null as int) as a, 1 as b")
    right = spark.sql("select 1 as a, cast(null as int) as b")
    assert not is_equal(left, right, fast=True)


def test_key_of_all_columns(spark):
    left, right = spark.sql("select int(id) as a from range(3)"), spark.sql("select int(id) as a from range(1, 5)")
    diff = keyed_diff(left, right, ["A"])
    assert {r["status"]: r["n_rows"] for r in diff.statuses().collect()} == {"source_only": 1, "target_only": 2}
    assert diff.cells().count() == 0 and diff.columns().count() == 0
    twice = left.unionAll(left)
    assert {r["status"]: r["n_rows"] for r in keyed_diff(twice, right, ["a"]).statuses().collect()} == {
        "source_only": 4,
        "target_only": 2,
    }


def test_key_must_exist(spark):
    with pytest.raises(ValueError, match="key columns"):
        keyed_diff(spark.range(1), spark.range(1), ["nope"])
    with pytest.raises(ValueError, match="no comparable column"):
        bag_diff(spark.sql("select 1 as a"), spark.sql("select 1 as b"))


def test_duplicate_keys(spark):
    left = spark.sql("select 1 as k, 2 as v union all select 1, 3 union all select 2, 2")
    right = spark.sql("select 1 as k, 2 as v union all select 3, 2 union all select 3, 3")
    assert sorted(map(tuple, duplicate_keys(left, right, ["k"]).collect())) == [(1, 2, 1), (3, 0, 2)]


def test_cells_show_null_and_types(spark):
    left = spark.sql("select 1 as k, cast(null as string) as s, cast(1.50 as decimal(5,2)) as d, array(1) as a")
    right = spark.sql("select 1 as k, 'x' as s, cast(2.5 as decimal(5,1)) as d, array(2L) as a")
    got = {r["column"]: r["diff"] for r in keyed_diff(left, right, ["k"]).cells().collect()}
    assert got == {"s": "null vs x", "d": "1.50 vs 2.50", "a": "[1] vs [2]"}


def test_modes_of_compare(spark):
    left = spark.sql("select id as k, id % 3 as v from range(20)")
    moved = left.selectExpr("k", "if(k = 4, 9, v) as v")
    keyed = compare(left, moved, keys=["k"])
    assert keyed.mode == "keyed" and keyed.cells().first()["diff"] == "1 vs 9"
    same_size = compare(left, moved)
    assert same_size.mode == "positional"
    assert [tuple(r) for r in same_size.summary().collect()] == [
        ("Count", "Count Match", "20 vs 20"),
        ("Data", "Data Mismatch", "v"),
    ]
    assert compare(left, left.where("k < 15")).cells().count() == 0
    assert compare(left, left.where("k < 15")).mode == "positional"
    shorter = compare(left, left.where("k < 15"), mode="bag")
    assert [tuple(r) for r in shorter.summary().collect()] == [
        ("Count", "Count Mismatch", "20 vs 15"),
        ("Data", "Data Mismatch", "5 rows only in Source"),
    ]
    with pytest.raises(ValueError):
        shorter.cells()
    with pytest.raises(ValueError):
        compare(left, left, mode="fuzzy")


def test_compare_reports_columns_it_cannot_compare(spark):
    left, right = spark.sql("select 1 as a, 'x' as b, 1 as c"), spark.sql("select 1 as a, 2 as b, 1 as d")
    got = compare(left, right).summary().collect()[1]
    assert tuple(got)[1:] == (
        "Data Mismatch",
        "Column c not in Target, Column d not in Source, Column b of another type",
    )
    equal = compare(left, left).summary().collect()[1]
    assert tuple(equal)[1:] == ("Data Match", "-")


def test_unique_keys(spark):
    source = spark.sql("select id as k, id % 3 as a, concat('s', id) as b from range(200)")
    target = source.selectExpr("k", "if(k % 20 = 0, null, a) as a", "b").where("k <> 7").unionAll(
        spark.sql("select -1L, 0L, 'new'")
    )
    one, two = keyed_diff(source, target, ["k"], unique=True), keyed_diff(source, target, ["k"])
    assert sorted(one.rows.collect(), key=repr) == sorted(two.rows.select(one.rows.columns).collect(), key=repr)
    assert sorted(map(tuple, one.cells().collect())) == sorted(map(tuple, two.cells().collect()))
    for bad in (source.unionAll(source), source.selectExpr("nullif(k, 3) as k", "a", "b")):
        with pytest.raises(ValueError, match="not unique"):
            keyed_diff(bad, target, ["k"], unique=True)
        with pytest.raises(ValueError, match="not unique"):
            keyed_diff(source, bad, ["k"], unique=True)


def test_lost_columns_are_said(spark):
    left = spark.sql("select id as k, 1 as a, 2 as b from range(3)")
    right = left.drop("b")
    assert {r["status"]: r["n_rows"] for r in row_status_counts(left, right, ["k"]).collect()}["unaligned_columns"] == 1
    assert [r["remarks"] for r in bag_diff(left, right).collect()] == ["Column b not in Target"]
    diff = keyed_diff(left, right, ["k"])
    assert [tuple(r) for r in diff.statuses().collect()] == [("unaligned_columns", 1)]
    assert [tuple(r) for r in diff.columns().collect()] == [("b", None)]


def test_diffs_of_reserved_names_run_at_a_time(spark, tmp_path, monkeypatch):
    from threading import Barrier

    from tallymark.queries import registry

    meeting, plain = Barrier(2), registry.keyed_diff

    def together(*given):
        meeting.wait(60)
        return plain(*given)

    monkeypatch.setattr(registry, "keyed_diff", together)
    kinds = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame([(k, 1, "F", 1.0, None, "1") for k in (1, 50, 70, 97)], kinds).write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.q_keyed_diff_reserved_names(spark, str(tmp_path)).select("key_name", "key_value", "col").collect()
    assert sorted(map(tuple, got)) == sorted((k, v, c) for k in registry._KEY_NAMES for v, c in ((50, "_n_source"), (70, "source_extra")))
