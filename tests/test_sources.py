import json
from datetime import date

import duckdb
import pytest
from pyspark.sql import types as T

from tallymark.functions.sqltext import sql_name
from tallymark.functions.types import TYPE_CODES, UNKNOWN_TYPE
from tallymark.operators.schema_diff import metadata_diff, missing_columns, schema_diff
from tallymark.sources.catalog import decode_catalog, describe_columns, resolve_base_table, split_type_text
from tallymark.sources.manifest import connections, read_manifest, with_base_tables
from tallymark.sources.readers import (
    bounds_query,
    columns_query,
    condition,
    filtered,
    jdbc_options,
    read_files,
    read_jdbc,
    split_predicates,
    spread_bounds_query,
    read_location,
    read_query,
)

META = "column string, data_type string, length string"


def issues(spark, source, target):
    return {
        r["column"]: r["issue"]
        for r in metadata_diff(spark.createDataFrame(source, META), spark.createDataFrame(target, META)).collect()
    }


@pytest.mark.parametrize(
    "source, target, issue",
    [
        (("VARCHAR", "10"), ("VARCHAR", "10"), None),
        (("VARCHAR", "10"), ("VARCHAR", "20"), "length"),
        (("CHAR", None), ("VARCHAR", "20"), None),
        (("CLOB", None), ("STRING", None), None),
        (("VARCHAR", "10"), ("TIMESTAMP", None), None),
        (("VARCHAR", "10"), ("BIGINT", None), "data_type"),
        (("VOID", None), ("INT", None), "data_type"),
        (("DECIMAL", "10,2"), ("DECIMAL", "12,2"), "length"),
        (("DECIMAL", "10,2"), ("FLOAT", None), None),
        (("FLOAT", None), ("BIGINT", None), "data_type"),
        (("SMALLINT", None), ("BIGINT", None), None),
        (("INT", None), ("STRING", None), "data_type"),
        (("TIMESTAMP", None), ("TIMESTAMP", None), None),
        (("TIMESTAMP", None), ("DATE", None), "data_type"),
        (("DATE", None), ("STRING", None), None),
        (("BLOB", None), ("ARRAY", None), None),
    ],
)
def test_type_families(spark, source, target, issue):
    assert issues(spark, [("a", *source)], [("A", *target)]).get("a") == issue


def test_columns_of_one_side(spark):
    assert issues(spark, [("a", "INT", None)], [("b", "INT", None)]) == {
        "a": "missing_in_target",
        "b": "missing_in_source",
    }
    left, right = spark.sql("select 1 as a, null as v, 'x' as b"), spark.sql("select 1 as A, 2.5D as c")
    got = {r["column"]: (r["missing_in"], r["data_type"], r["n_values"]) for r in missing_columns(left, right).collect()}
    assert got == {"b": ("target", "STRING", 1), "c": ("source", "FLOAT", 1)}
    assert missing_columns(left, left).count() == 0


def test_describe_columns(spark):
    df = spark.sql("select 1 as a, 'abc' as s, cast(1 as decimal(9,3)) as d, null as v, 2 as ` `")
    assert [tuple(r)[1:4] for r in describe_columns(df).collect()] == [
        ("a", "INT", None),
        ("s", "STRING", None),
        ("d", "DECIMAL", "9,3"),
    ]
    seen = {r["column"]: r for r in describe_columns(df, observe=True).collect()}
    assert seen["s"]["length"] == "3" and seen["s"]["n_null"] == 0 and seen["d"]["length"] == "9,3"
    assert schema_diff(df, df).count() == 0


def test_every_type_code(spark):
    codes = list(TYPE_CODES) + ["??"]
    view = spark.createDataFrame(
        [("db ", "t ", f"C{i}  ", c + " ", "Y", 10, 2) for i, c in enumerate(codes)],
        "DatabaseName string, TableName string, ColumnName string, ColumnType string, Nullable string, "
        "DecimalTotalDigits int, DecimalFractionalDigits int",
    )
    got = {r["column"]: r for r in decode_catalog(view).collect()}
    for i, c in enumerate(codes):
        assert got[f"C{i}"]["data_type"] == TYPE_CODES.get(c, UNKNOWN_TYPE)
        assert got[f"C{i}"]["length"] == ("10,2" if c == "D" else None)
        assert got[f"C{i}"]["nullable"] is True


def test_catalog_view_finds_its_columns_anywhere(spark):
    view = spark.sql(
        "select " + ", ".join(f"{i} as x{i}" for i in range(20)) + ", 'a' as ColumnName, 'D' as ColumnType,"
        " 'N' as Nullable, 10 as DecimalTotalDigits, 2 as DecimalFractionalDigits"
    )
    got = decode_catalog(view)
    assert got.columns == [f"x{i}" for i in range(20)] + ["column", "data_type", "length", "nullable"]
    assert got.first()["length"] == "10,2"


def test_type_text(spark):
    rows = [
        ("a", "varchar(10)"), ("b", "decimal(10, 2)"), ("c", "array<decimal(3,1)>"), ("d", "void"), ("", "int"),
        ("e ", " bigint"),
    ]
    got = {r["column"]: (r["data_type"], r["length"]) for r in split_type_text(spark.createDataFrame(rows, "n string, t string"), "n", "t").collect()}  # noqa: E501
    assert got == {"A": ("VARCHAR", "10"), "B": ("DECIMAL", "10,2"), "C": ("ARRAY", None), "E": ("BIGINT", None)}


def test_base_table_names(spark):
    names = {
        "sales_v.orders": "SALES_T.ORDERS",
        "SALES_V.ORDERS_V": "SALES_T.ORDERS",
        "sales_v.order_values": "SALES_T.ORDER_VALUES",
        "sales_t.orders_v": "sales_t.orders_v",
        "orders_v": "orders_v",
    }
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: r["base"] for r in df.withColumn("base", resolve_base_table(df.name)).collect()}
    assert got == names


@pytest.mark.parametrize("text", [None, "", "  ", "nan", "NaN"])
def test_no_condition(spark, text):
    assert spark.range(5).where(condition(text)).count() == 5


@pytest.mark.parametrize("text", ["where id > 2", "WHERE  id > 2", "id > 2", "where\nid > 2"])
def test_condition(spark, text):
    assert filtered(spark.range(5), text).count() == 2


def test_manifest_formats(spark, tmp_path):
    csv = tmp_path / "jobs.csv"
    csv.write_text(
        "Connection_Name,Table_Name,Iceberg_Table,Iceberg_database,query_TD,query_Iceberg,condition_td,condition_ib\n"
        "dev,sales_v.orders_v,orders,lake,nan,,where a > 1,\n"
        "uat,sales_v.parts,parts,lake,select 1,select 2,,nan\n"
    )
    got = with_base_tables(read_manifest(spark, str(csv))).orderBy("source").collect()
    first, second = got
    assert (first["table"], first["target"], first["base_table"]) == (
        "sales_v.orders_v",
        "lake.orders",
        "SALES_T.ORDERS",
    )
    assert (first["source_query"], first["source_condition"], first["target_condition"]) == (None, "where a > 1", None)
    assert (second["source_query"], second["target_query"]) == ("select 1", "select 2")
    assert {r[0] for r in connections(read_manifest(spark, str(csv))).collect()} == {"dev", "uat"}
    jsons = tmp_path / "jobs.json"
    jsons.write_text(json.dumps([{"table": "t", "source": "/a", "target": "/b", "keys": ["k", "l"]}]))
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps({"table": t, "source": "/a", "target": "/b"}) for t in "tu"))
    assert {r["table"] for r in read_manifest(spark, str(lines)).collect()} == {"t", "u"}
    quoted = tmp_path / "quoted.csv"
    quoted.write_text('table,source_query\nt,"select ""a"",\n b from t"\n')
    assert read_manifest(spark, str(quoted)).first()["source_query"] == 'select "a",\n b from t'
    row = read_manifest(spark, str(jsons)).first()
    assert (row["table"], row["keys"], row["source_condition"]) == ("t", "k|l", None)


def test_files_and_tables(spark, tmp_path):
    df = spark.sql("select id, concat('00', id) as s from range(3)")
    for fmt in ("parquet", "orc", "json", "csv"):
        path = f"{tmp_path}/data.{fmt}"
        writer = df.write.option("header", True) if fmt == "csv" else df.write
        writer.format(fmt).save(path)
        schema = "id bigint, s string" if fmt in ("csv", "json") else None
        assert sorted(map(tuple, read_files(spark, path, schema=schema).collect())) == [(i, f"00{i}") for i in range(3)]
    assert read_files(spark, f"{tmp_path}/data.csv").schema["s"].dataType.simpleString() == "string"
    df.createOrReplaceTempView("numbers")
    assert read_location(spark, "numbers").count() == 3
    assert read_query(spark, "select max(id) as m from {x}", x=df).first()["m"] == 2


def test_jdbc_options():
    assert jdbc_options("jdbc:x", table="db.t", user="u") == {"url": "jdbc:x", "user": "u", "dbtable": "db.t"}
    assert jdbc_options("jdbc:x", query="select 1")["query"] == "select 1"
    split = jdbc_options("jdbc:x", query="select a from t", partition=("a", 1, 90, 8))
    assert split["dbtable"] == "(select a from t) a" and "query" not in split
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "a",
        "1",
        "90",
        "8",
    )
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_texts_sent_to_the_source():
    assert bounds_query("a", 2, "(select a from t) a") == "select percentile_disc(0.5) within group (order by a) as b1 from (select a from t) a"
    assert bounds_query('"order"', 1, "db.t") == "select null as b1 from db.t"
    assert columns_query("db.o'x", "dbc.columns") == (
        "select * from dbc.columns where databasename = 'db' and tablename = 'o''x'"
    )


@pytest.mark.parametrize("values", ["id", "id * id", "id % 7", "cast(pow(1.7, id % 70) as bigint)", "if(id < 900, 5, id - 500)", "if(id % 5 = 0, null, -id)", "9000000000000000000 + id", "cast(id as decimal(20,2)) / 3", "cast(null as bigint)"])
def test_spread_bounds_are_the_quantiles(spark, values):
    spark.range(1000).selectExpr(f"{values} as k").createOrReplaceTempView("spread_values")
    known = sorted(r["k"] for r in spark.table("spread_values").where("k is not null").collect())
    for parts in (1, 8):
        want = [known[-(-i * len(known) // parts) - 1] if known else None for i in range(1, parts)] or [None]
        assert list(spark.sql(spread_bounds_query("k", parts, "spread_values")).first()) == want


def test_spread_bounds_gather_no_values(spark):
    """Neither all values as one state nor as one window."""
    spark.range(1000).selectExpr("id as k").createOrReplaceTempView("spread_values")
    plan = spark.sql(spread_bounds_query("k", 8, "spread_values"))._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "Window" in plan and "windowspecdefinition(k" not in plan


def test_split_predicates():
    whole, text, day = T.LongType(), T.StringType(), T.DateType()
    assert split_predicates("k", [1, 1, 5, None], whole) == ["k <= 1", "k > 1 and k <= 5", "k > 5", "k is null"]
    assert split_predicates("k", ["o'x"], text) == ["k <= 'o''x'", "k > 'o''x'", "k is null"]
    assert split_predicates("k", [date(2024, 1, 2)], day)[0] == "k <= date '2024-01-02'"
    assert split_predicates("k", [None], whole) == ["1 = 1"]


SKEWED = "select case when l_partkey % 10 = 0 then null else l_partkey * l_partkey * l_partkey end as \"order\" from lineitem"


def test_equal_parts_in_plain_sql():
    """The texts as another engine runs them: every row in one part, parts of a skewed key of like size."""
    engine = duckdb.connect()
    engine.execute("create view lineitem as select * from '/root/testdata/sf0.01/lineitem.parquet'")
    name = sql_name("order")
    assert name == '"order"' and sql_name("order", "`") == "`order`" and sql_name("plain", "`") == "plain"
    bounds = engine.execute(bounds_query(name, 8, f"({SKEWED}) a")).fetchone()
    sizes = [engine.execute(f"select count(*) from ({SKEWED}) a where {p}").fetchone()[0] for p in split_predicates(name, list(bounds), T.LongType())]
    total, nulls = engine.execute(f"select count(*), count(*) - count({name}) from ({SKEWED}) a").fetchone()
    assert len(sizes) == 9 and sizes[-1] == nulls and sum(sizes) == total
    assert max(sizes[:-1]) < 1.1 * min(sizes[:-1])


def test_jdbc_reads_are_split_by_predicates(spark, monkeypatch):
    """A stand-in for the source: what is asked of it, and in which words."""
    asked = []

    class Reader:
        def format(self, _):
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            text = asked[-1].get("query", "")
            return spark.sql("select 10 as b1, 20 as b2, 20 as b3" if text else "select 5L as `Order`, 'x' as s")

        def jdbc(self, url, table, predicates, properties):
            return url, table, predicates, properties

    class Session:
        read = Reader()

    url, table, predicates, properties = read_jdbc(Session(), "jdbc:x", "order", 4, "`", table="db.t", user="u")
    assert asked[-1]["query"] == bounds_query("`order`", 4, "db.t") and "dbtable" not in asked[-1]
    assert (url, table, properties) == ("jdbc:x", "db.t", {"user": "u"})
    assert predicates == ["`order` <= 10", "`order` > 10 and `order` <= 20", "`order` > 20", "`order` is null"]
