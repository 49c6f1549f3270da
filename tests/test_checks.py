import duckdb
import pytest

from tallymark.functions.types import CHAR_VARCHAR_KEY, canonical
from tallymark.operators.checks import (
    check_compare,
    check_summary,
    compare_profiles,
    row_count_check,
    table_verdict,
)
from tallymark.operators.hash_profile import hash_profile, hash_profile_compare, hash_profile_long
from tallymark.operators.profile import (
    check_queries,
    metrics,
    profile,
    remote_profile,
    remote_profile_query,
    single_check,
)


def by_metric(df):
    return {(r["check"], r["metric"]): r["value"] for r in df.collect()}


def summary(source, target):
    return {r["TestCases"]: (r["Status"], r["Remarks"]) for r in check_summary(check_compare(source, target)).collect()}


def verdict(source, target):
    return table_verdict(check_summary(check_compare(source, target))).first()["Status"]


def test_metric_names_and_values(spark):
    df = spark.sql("""
        select * from values (1, 'ab', 1.75D, timestamp_ntz '2024-01-01', cast(1.5 as decimal(10,2))),
                             (2, null, -1.75D, null, null) as t(i, s, f, ts, d)""")
    got = by_metric(profile(df))
    assert got[("Count", "Total_count")] == "2"
    assert got[("Null", "Number_of_Null_Values_s")] == "1"
    assert got[("Sum", "sum_i")] == "3"
    assert got[("Sum", "sum_f")] == "0"  # each value truncates toward zero
    assert got[("Sum", "sum_d")] == "1.500000000000"
    assert got[("Max", "MAX_ts")] == got[("Max", "MIN_ts")] == "2024-01-01 00:00:00"
    assert got[("Length", "max_len_s")] == got[("RLength", "min_len_s")] == "2"


def test_check_applicability(spark):
    checks = lambda sql: {m.check for m in metrics(spark.sql(sql).schema)}
    assert checks("select 'x' as s") == {"Count", "Null", "Length", "RLength"}
    assert checks("select 1 as i") == {"Count", "Null", "Sum"}
    assert checks("select date '2024-01-01' as d, true as b") == {"Count", "Null", "Max"}
    assert checks("select array(1) as a, binary('x') as b") == {"Count", "Null"}
    with pytest.raises(ValueError):
        single_check(spark.sql("select 'x' as s"), "Sum")


def test_char_padding_counts_in_length_only(spark):
    padded = spark.sql("select 'ab   ' as c")
    field = padded.c.alias("c", metadata={CHAR_VARCHAR_KEY: "char(5)"})
    got = summary(padded.select(field), spark.sql("select 'ab' as c"))
    assert got["Length"] == ("Not match", "max_len_c, min_len_c")
    assert got["RLength"] == ("Match", "-")


def test_rtrim_removes_blanks_only(spark):
    df = spark.sql("select 'a\\t ' as c")
    df = df.select(df.c.alias("c", metadata={CHAR_VARCHAR_KEY: "char(3)"}))
    assert single_check(df, "RLength").first()["max_len_c"] == 2


def test_equal_tables_match(spark):
    df = spark.sql("select id, cast(id as string) as s, id / 3 as f from range(10)")
    assert set(summary(df, df.repartition(3)).values()) == {("Match", "-")}
    assert verdict(df, df) == "Pass"


def test_missing_columns_are_named_in_both_directions(spark):
    left = spark.sql("select 1 as a, 2 as b")
    right = spark.sql("select 1 as a, 2 as c")
    got = summary(left, right)
    assert got["Null"] == (
        "Not match",
        "Column number_of_null_values_b not in Target, Column number_of_null_values_c not in Source",
    )
    assert got["Count"] == ("Match", "-")
    assert verdict(left, right) == "Fail"


def test_types_are_compared_by_value(spark):
    ints = spark.sql("select cast(id as int) as a, date '2024-01-01' as d from range(3)")
    decimals = spark.sql("select cast(id as decimal(10,2)) as A, timestamp_ntz '2024-01-01 00:00:00' as D from range(3)")
    assert set(summary(ints, decimals).values()) == {("Match", "-")}


def test_decimals_beyond_double_precision(spark):
    one = spark.sql("select cast('12345678901234567890.123456789012' as decimal(38,12)) as d")
    two = spark.sql("select cast('12345678901234567890.123456789013' as decimal(38,12)) as d")
    assert summary(one, two)["Sum"] == ("Not match", "sum_d")


def test_large_sums_stay_exact(spark):
    df = spark.sql("select 9223372036854775807L as a from range(5)")
    assert by_metric(profile(df))[("Sum", "sum_a")] == str(5 * 9223372036854775807)


@pytest.mark.parametrize(
    "value", ["1e30D", "double('Infinity')", "cast('9999999999999999999999999999' as decimal(38,0))"]
)
def test_values_outside_the_sum_fail_the_check_only(spark, value):
    df = spark.sql(f"select {value} as a, 1 as b")
    got = summary(df, df)
    assert got["Sum"][0] == "Failed" and "sum_a" in got["Sum"][1]
    assert got["Count"] == ("Match", "-")
    assert verdict(df, df) == "Fail"


def test_nan_counts_as_null(spark):
    nan, null = spark.sql("select double('NaN') as f"), spark.sql("select cast(null as double) as f")
    assert set(summary(nan, null).values()) == {("Match", "-")}
    assert by_metric(profile(nan))[("Sum", "sum_f")] is None


def test_empty_side(spark):
    df = spark.sql("select id, 'x' as s from range(3)")
    got = summary(df, df.where("false"))
    assert {k: v[0] for k, v in got.items()} == {c: "Not match" for c in ("Count", "Null", "Sum", "Length", "RLength")}
    assert set(summary(df.where("false"), df.where("false")).values()) == {("Match", "-")}


def test_text_keeps_leading_zeros_and_na(spark):
    left = spark.sql("select '007' as s union all select 'NA'")
    right = spark.sql("select '7' as s union all select null")
    got = summary(left, right)
    assert got["Null"][0] == got["Length"][0] == "Not match"


def test_no_check_is_no_pass(spark):
    empty = spark.createDataFrame([], "TestCases string, Status string, Remarks string")
    assert table_verdict(empty).first()["Status"] == "Failed"


def test_passes_over_wide_tables_agree(spark):
    df = spark.range(50).selectExpr(*[f"id * {i} as c{i}" for i in range(45)])
    rows = lambda n: sorted(map(tuple, profile(df, columns_per_pass=n).collect()))
    assert rows(7) == rows(100)
    assert hash_profile_long(df, "md5").count() == 45


def test_odd_names(spark):
    df = spark.sql("select 1 as `a b`, 'x' as `it's`, 2.0D as `c.d`, 'y' as `back``tick`")
    assert set(summary(df, df).values()) == {("Match", "-")}
    assert [tuple(r)[1:] for r in hash_profile_compare(df, df).collect()] == [
        ("Count Match", "1 vs 1"),
        ("Data Match", "-"),
    ]


def test_row_counts(spark):
    row = row_count_check(spark.range(3), spark.range(4)).first()
    assert tuple(row) == (3, 4, "Count Mismatch", "3 vs 4")
    assert row_count_check(spark.range(0), spark.range(0)).first()["status"] == "Count Match"


def test_hash_profile_algorithms(spark):
    df = spark.sql("""
        select * from values ('a', 1, true, timestamp_ntz '2024-01-01', cast(2.5 as decimal(5,1))),
                             (null, 3, null, null, null) as t(S, i, b, ts, d)""")
    murmur = hash_profile(df).first().asDict()
    assert list(murmur) == ["avgs", "avgi", "avgb", "avgts", "avgd"]
    expected = spark.sql("select (hash('a') + 42) / 2 as h").first()["h"]  # null gives the seed
    assert murmur["avgs"] == expected and murmur["avgi"] == 2.0 and murmur["avgd"] == 2.5
    md5 = {r["metric"]: (r["n_values"], r["value"]) for r in hash_profile_long(df, "md5").collect()}
    assert md5["avgs"] == (1, float(int("0cc175b9", 16)))
    assert {r["n_values"] for r in hash_profile_long(df, "xxhash64").collect()} == {1, 2}
    with pytest.raises(ValueError):
        hash_profile(df, "sha")


@pytest.mark.parametrize("algorithm", ["murmur", "md5", "xxhash64"])
def test_hash_profiles_ignore_row_order(spark, algorithm):
    df = spark.range(1000).selectExpr("id * 0.1D as f", "cast(id as string) as s", "array(id, null) as a")
    turned = df.repartition(7).orderBy("s")
    assert hash_profile(df, algorithm).first() == hash_profile(turned, algorithm).first()
    changed = df.selectExpr("f", "if(s = '7', 'x', s) as s", "a")
    rows = [tuple(r) for r in hash_profile_compare(df, changed, algorithm).collect()]
    assert rows == [("Count", "Count Match", "1000 vs 1000"), ("Data", "Data Mismatch", "avgs")]


def test_hash_profile_of_huge_doubles(spark):
    row = hash_profile(spark.sql("select 1e300D as f union all select 3e300D")).first()
    assert row["avgf"] == 2e300


def test_hash_compare_names_missing_columns(spark):
    got = hash_profile_compare(spark.sql("select 1 as a, 2 as b"), spark.sql("select 1 as a, 3 as c"))
    assert got.collect()[1]["Remarks"] == "Column avgb not in Target, Column avgc not in Source"


def test_remote_queries_give_the_same_profile(spark, tmp_path):
    """The SQL meant for a source engine, run on the oracle engine, profiles like Spark itself."""
    df = spark.sql("""
        select id as k, cast(id % 5 as int) as i, cast(id as double) as f, cast(id / 7 as decimal(12,3)) as d,
               if(id % 4 = 0, null, concat('s', id)) as s, concat('p', id % 9, '   ') as c,
               timestamp_ntz '2024-01-01' as ts, date '2024-02-03' as dt, id = 3 as b
        from range(50)""")
    df.write.parquet(f"{tmp_path}/t")
    df = df.withColumn("c", df.c.alias("c", metadata={CHAR_VARCHAR_KEY: "char(9)"}))
    engine = duckdb.connect()
    place = f"'{tmp_path}/t/*.parquet'"
    cursor = engine.execute(remote_profile_query(df.schema, place, "k > 10"))
    values = [None if v is None else str(v) for v in cursor.fetchall()[0]]
    row = spark.createDataFrame([values], ", ".join(f"v{i} string" for i in range(len(values))))
    compared = compare_profiles(remote_profile(row, df.schema), profile(df.where("k > 10"))).collect()
    assert {r["status"] for r in compared} == {"Match"} and len(compared) == len(metrics(df.schema))
    queries = check_queries(df.schema, place)
    assert list(queries) == ["Count", "Null", "Sum", "Max", "Length", "RLength"]
    for check, text in queries.items():
        cursor = engine.execute(text)
        assert [d[0] for d in cursor.description] == [m.name for m in metrics(df.schema) if m.check == check]


def test_values_of_other_types_compare(spark):
    columns = "check string, column string, metric string, value string, ok boolean"
    left = spark.createDataFrame(
        [("Sum", "a", "sum_a", "12", True), ("Max", "d", "MAX_d", "2024-01-01", True), ("Sum", "x", "sum_x", None, True),
         ("Length", "s", "max_len_s", "12", True)],
        columns,
    )
    right = spark.createDataFrame(
        [("Sum", "a", "sum_a", "12.000000000000", True), ("Max", "d", "MAX_d", "2024-01-01 00:00:00", True),
         ("Sum", "x", "sum_x", "0", True), ("Length", "s", "max_len_s", "12.0", True)],
        columns,
    )
    got = {r["metric"]: r["status"] for r in compare_profiles(left, right).collect()}
    assert got == {"sum_a": "Match", "MAX_d": "Match", "sum_x": "Not match", "max_len_s": "Not match"}


def test_hashed_averages_see_one_changed_key(spark):
    left = spark.sql("select 100000000000000000 + id as k from range(1000)")
    right = left.selectExpr("if(k = 100000000000000500, k + 1, k) as k")
    status = {r["key"]: r["Status"] for r in hash_profile_compare(left, right, "md5").collect()}
    assert status == {"Count": "Count Match", "Data": "Data Mismatch"}


def test_one_pass_unless_asked(spark, tmp_path):
    spark.range(5).selectExpr(*[f"id + {i} as c{i}" for i in range(60)]).write.csv(f"{tmp_path}/wide")
    wide = spark.read.csv(f"{tmp_path}/wide")
    plan = check_compare(wide, wide)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


def test_pushed_texts_take_the_sources_quote_and_nan_as_null(spark):
    """On an engine that reads "order" as a text the null count would be 0 whatever the data."""
    df = spark.sql("select * from values (1, 2.5D), (null, double('NaN')), (3, null), (4, double('Infinity')), (5, -double('Infinity')) as t(`order`, x)")
    text = remote_profile_query(df.schema, "t", quote="`")
    assert "`order`" in text and '"' not in text
    assert "`order`" in check_queries(df.schema, "t", quote="`")["Null"]
    engine = duckdb.connect()
    engine.execute("create table t as select * from (values (1, 2.5::double), (null, 'NaN'::double), (3, null), (4, 'Infinity'::double), (5, '-Infinity'::double)) as t(\"order\", x)")
    finite = engine.execute(check_queries(df.schema, "t")["Null"]).fetchone()
    assert finite == (1, 2)
    assert [r["value"] for r in profile(canonical(df), ["Null"]).collect()] == ["1", "2"]
