from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tallymark.functions.types import canonical, common_type, exact_cast, lower_names, type_length, type_name
from tallymark.operators.align import align
from tallymark.operators.checks import check_compare, check_summary
from tallymark.operators.hash_profile import hash_profile_compare
from tallymark.operators.multiset import bag_diff, is_equal
from tallymark.operators.rows import keyed_diff, positional_diff


def test_names_that_differ_in_case_collide(spark):
    with pytest.raises(ValueError, match="differ only in case"):
        lower_names(spark.range(1).selectExpr("id as A", "id as a"))


def test_canonical_values(spark):
    df = spark.sql("""
        select double('NaN') as n, double(-0.0) as z, array(float('NaN'), float(1)) as a, map('b', 1, 'a', 2) as m,
               named_struct('X', double('NaN'), 'y', array(map(1, double('NaN')))) as s, null as v""")
    row = canonical(df).first()
    assert row["n"] is None
    assert str(row["z"]) == "0.0"
    assert row["a"] == [None, 1.0]
    assert [tuple(e) for e in row["m"]] == [("a", 2), ("b", 1)]
    assert row["s"]["X"] is None and row["s"]["y"][0][0]["value"] is None
    assert dict(canonical(df).dtypes)["v"] == "string"


def test_canonical_keeps_null_structs(spark):
    df = spark.sql("select if(id = 0, null, named_struct('x', double(1))) as s from range(2)")
    assert [r["s"] is None for r in canonical(df).orderBy("s").collect()] == [True, False]


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("int", "decimal(10,2)", "decimal(12,2)"),
        ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"),
        ("decimal(38,2)", "decimal(38,10)", "decimal(38,10)"),
        ("float", "double", "double"),
        ("decimal(10,2)", "double", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", "timestamp"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("struct<A:int>", "struct<a:bigint>", "struct<a:bigint>"),
        ("string", "int", None),
        ("boolean", "int", None),
        ("struct<a:int>", "struct<b:int>", None),
        ("array<string>", "array<int>", None),
    ],
)
def test_common_type(a, b, expected):
    left, right = (T._parse_datatype_string(x) for x in (a, b))
    found = common_type(left, right)
    assert (found and found.simpleString()) == expected
    assert (common_type(right, left) and common_type(right, left).simpleString().lower()) == expected


def test_a_decimal_that_does_not_fit_raises(spark):
    big = spark.sql("select cast('123456789012345678901234567890123456' as decimal(38,2)) as d")
    small = spark.sql("select cast('1.0000000001' as decimal(38,10)) as d")
    with pytest.raises(Exception, match="does not fit"):
        align(big, small).source.collect()
    assert align(small, small).source.first()["d"] == Decimal("1.0000000001")


def test_nested_cast(spark):
    left = spark.sql("select named_struct('A b', 1, 'c', array(1)) as s")
    right = spark.sql("select named_struct('a b', 1L, 'c', array(1L)) as s")
    pair = align(left, right)
    assert pair.source.schema["s"].dataType == pair.target.schema["s"].dataType
    assert pair.source.first() == pair.target.first()


def test_declared_names_and_lengths():
    char = T.StructField("c", T.StringType(), True, {"__CHAR_VARCHAR_TYPE_STRING": "char(5)"})
    assert (type_name(char), type_length(char)) == ("CHAR", "5")
    assert type_name(T.StructField("c", T.VarcharType(7))) == "VARCHAR"
    assert type_length(T.StructField("c", T.VarcharType(7))) == "7"
    assert type_length(T.StructField("c", T.DecimalType(10, 2))) == "10,2"
    assert type_name(T.StructField("c", T.ArrayType(T.LongType()))) == "ARRAY"
    assert type_name(T.StructField("c", T.DayTimeIntervalType())).startswith("INTERVAL DAY")


def test_exact_cast_is_plain_where_it_fits():
    assert exact_cast("x", T.IntegerType(), T.IntegerType()) == "x"
    assert exact_cast("x", T.IntegerType(), T.DecimalType(12, 2)) == "cast(x as decimal(12,2))"


def test_every_type_goes_through_every_operator(spark):
    text = """
        select id as k, interval '1' day * (id % 4) as iv, make_ym_interval(int(id % 3)) as ym,
               parse_json(concat('{"a":', id % 5, '}')) as v, binary(concat('b', id % 3)) as bin,
               array(named_struct('x', id % 2, 'y', map('q', double(id % 3)))) as nest,
               timestamp '2024-01-01' + make_dt_interval(int(id % 9)) as tz, null as n, time '10:00:00' as tt,
               id % 2 = 0 as bo, cast(id as float) as fl, cast(id as tinyint) as ti
        from range(100)"""
    spark.conf.set("spark.sql.timeType.enabled", True)
    try:
        source = spark.sql(text)
        target = spark.sql(text.replace("'b', id % 3", "'b', if(id = 9, 7, id % 3)").replace("double(id % 3)", "double(if(id = 11, 5, id % 3))"))  # noqa: E501
        assert {r["Status"] for r in check_summary(check_compare(source, target)).collect()} == {"Match"}
        assert hash_profile_compare(source, target).collect()[1]["Remarks"] == "avgbin, avgnest"
        for diff in (keyed_diff(source, target, ["k"]), positional_diff(source, target)):
            assert {(r["column"], r["diff"]) for r in diff.cells().collect()} == {
                ("bin", "YjA= vs Yjc="),
                ("nest", "[{1, [{q, 2.0}]}] vs [{1, [{q, 5.0}]}]"),
            }
        assert bag_diff(source, target).count() == 4
        assert not is_equal(source, target) and is_equal(source, source.repartition(3))
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")
