"""One query per operator. Each reads whole tables; its oracle is plain SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.types import CHAR_VARCHAR_KEY, lower_names
from tallymark.operators.buckets import bag_diff_by_buckets
from tallymark.operators.checks import check_compare, check_summary, row_count_check, table_verdict
from tallymark.operators.discovery import candidate_keys, renamed_columns
from tallymark.operators.hash_profile import hash_profile, hash_profile_compare, hash_profile_long
from tallymark.operators.incremental import profile_incremental
from tallymark.operators.multiset import bag_diff, table_equality
from tallymark.operators.profile import profile, single_check
from tallymark.operators.reconcile import keyed_diff_small
from tallymark.operators.rows import duplicate_keys, keyed_diff, positional_diff, row_status_counts
from tallymark.operators.schema_diff import missing_columns, schema_diff
from tallymark.operators.sinks import preview, write_result
from tallymark.plans.compare import compare
from tallymark.plans.job import run
from tallymark.queries import oracle as o
from tallymark.queries.fixtures import sql, table
from tallymark.session import new_folder
from tallymark.sources.catalog import decode_catalog, describe_columns, resolve_base_table, split_type_text
from tallymark.sources.manifest import connections, normalise_manifest, read_manifest
from tallymark.sources.readers import bounds_query, canonical_text, columns_query, filtered, read_query, split_predicates

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ORDERS, LINEITEM, PART, CUSTOMER = (o.COLUMNS[t] for t in ("orders", "lineitem", "part", "customer"))
LINE_KEYS = ["l_orderkey", "l_linenumber"]


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, less the leading ``q_``."""

    def register(function: Query) -> Query:
        name = function.__name__.removeprefix("q_")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def _text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# ---------------------------------------------------------------- sources


@query(
    "SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase' AND value > 50 AND user_id IS NOT NULL"
)
def q_source_scan(spark, folder):
    events = filtered(table(spark, folder, "events"), "where event_type = 'purchase' and value > 50")
    return filtered(events, "user_id is not null").select("event_id", "ts", "user_id", "value")


_TYPES = {"n": ("BIGINT", None), "f": ("FLOAT", None), "t": ("TIMESTAMP", None), "s": ("STRING", None)}
_NARROW = {"p_size", "c_nationkey", "l_linenumber"}


def _declared(columns: dict[str, str]) -> dict[str, tuple[str, str | None]]:
    return {c: ("INT", None) if c in _NARROW else _TYPES[kind] for c, kind in columns.items()}


_VARIANT_TYPES = {
    "o_orderkey": ("INT", None),
    "o_custkey": ("BIGINT", None),
    "o_orderstatus": ("DATE", None),
    "o_totalprice": ("DECIMAL", "18,2"),
    "o_orderdate": ("TIMESTAMP", None),
    "load_id": ("BIGINT", None),
}


@query(
    " UNION ALL ".join(
        [o.metadata_sql(t, t, _declared(o.COLUMNS[t])) for t in ("orders", "lineitem", "part", "customer", "events")]
        + [o.metadata_sql("orders_variant", "orders_variant", _VARIANT_TYPES)]
    )
)
def q_schema_metadata(spark, folder):
    names = ("orders", "lineitem", "part", "customer", "events", "orders_variant")
    parts = [
        describe_columns(table(spark, folder, n), observe=True).select(F.lit(n).alias("table"), "*") for n in names
    ]
    return reduce(DataFrame.unionByName, parts)


@query(f"""
    SELECT columnid, "column", data_type,
           CASE WHEN data_type = 'DECIMAL' THEN concat(digits, ',', scale) END AS length, nullable
    FROM (SELECT ColumnId AS columnid, rtrim(ColumnName) AS "column", DecimalTotalDigits AS digits,
                 DecimalFractionalDigits AS scale, Nullable = 'Y' AS nullable,
                 CASE trim(ColumnType) WHEN 'CF' THEN 'CHAR' WHEN 'CV' THEN 'VARCHAR' WHEN 'D' THEN 'DECIMAL'
                      WHEN 'I' THEN 'INT' WHEN 'I8' THEN 'BIGINT' WHEN 'DA' THEN 'DATE' WHEN 'TS' THEN 'TIMESTAMP'
                      WHEN 'SZ' THEN 'TIMESTAMP WITH TIME ZONE' WHEN 'BO' THEN 'BLOB' WHEN 'JN' THEN 'JSON'
                      WHEN 'YR' THEN 'INTERVAL YEAR' ELSE 'UNKNOWN' END AS data_type
          FROM {sql("catalog_view")} AS v) AS d""")
def q_decode_type_codes(spark, folder):
    return lower_names(decode_catalog(table(spark, folder, "catalog_view")))


@query(f"""
    SELECT c_custkey, name,
           CASE WHEN contains(lower(name), 'v.')
                THEN regexp_replace(replace(upper(name), '_V.', '_T.'), '_V$', '') ELSE name END AS base_table
    FROM {sql("view_names")} AS n""")
def q_resolve_base_table(spark, folder):
    return table(spark, folder, "view_names").withColumn("base_table", resolve_base_table(F.col("name")))


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""")
def q_canonical_projection(spark, folder):
    orders = table(spark, folder, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return canonical_text(lower_names(orders.toDF(*[c.upper() for c in orders.columns])))


_DECODED = """CASE trim(ColumnType) WHEN 'D' THEN 'DECIMAL' WHEN 'CV' THEN 'VARCHAR' ELSE 'BIGINT' END AS data_type,
           CASE WHEN trim(ColumnType) = 'D' THEN concat(DecimalTotalDigits, ',', DecimalFractionalDigits) END AS length,
           Nullable = 'Y' AS nullable"""
_BESIDE = ", ".join(f"x{i}" for i in range(14))


@query(f"""
    SELECT {_BESIDE}, DatabaseName AS databasename, TableName AS tablename, ColumnId AS columnid,
           rtrim(ColumnName) AS "column", {_DECODED} FROM {sql("catalog_wide")} AS v""")
def q_catalog_wide_view(spark, folder):
    """The columns that are needed stand behind sixteen others."""
    return lower_names(decode_catalog(table(spark, folder, "catalog_wide")))


@query(f"""
    SELECT ColumnId AS columnid, rtrim(ColumnName) AS "column", {_DECODED} FROM {sql("catalog_wide")} AS v
    WHERE DatabaseName = 'db1' AND TableName = 't2'""")
def q_metadata_predicate(spark, folder):
    """The text that is sent to a source, here answered by a view."""
    table(spark, folder, "catalog_wide").createOrReplaceTempView("tallymark_columns")
    found = decode_catalog(read_query(spark, columns_query("db1.t2", "tallymark_columns")))
    return lower_names(found).select("columnid", "column", "data_type", "length", "nullable")


@query(f"""
    SELECT upper(trim(name)) AS "column",
           CASE p_partkey % 6 WHEN 0 THEN 'VARCHAR' WHEN 1 THEN 'DECIMAL' WHEN 2 THEN 'ARRAY' WHEN 4 THEN 'BIGINT' ELSE 'TIMESTAMP' END AS data_type,
           CASE WHEN p_partkey % 6 < 2 THEN replace(regexp_extract(type_text, '[(](.*)[)]', 1), ' ', '') END AS length
    FROM {sql("type_texts")} AS t WHERE p_partkey % 11 <> 0 AND p_partkey % 6 <> 3""")
def q_type_text_metadata(spark, folder):
    return split_type_text(table(spark, folder, "type_texts"), "name", "type_text")


def _manifest(spark, folder):
    """A manifest file, written as a user would have it, and read back."""
    path = f"{new_folder(spark, 'manifest')}.csv"
    table(spark, folder, "manifest_rows").write.option("header", True).option("escape", '"').csv(path)
    return read_manifest(spark, path)


@query(f"""
    SELECT nullif(Connection_Name, 'nan') AS connection, Table_Name AS "table", Table_Name AS source,
           concat(Iceberg_database, '.', Iceberg_Table) AS target, nullif(query_TD, '') AS source_query,
           CAST(NULL AS VARCHAR) AS target_query, nullif(condition_td, 'nan') AS source_condition,
           CAST(NULL AS VARCHAR) AS target_condition, CAST(NULL AS VARCHAR) AS keys, CAST(NULL AS VARCHAR) AS split_column,
           CAST(NULL AS VARCHAR) AS splits
    FROM {sql("manifest_rows")} AS m""")
def q_manifest_read(spark, folder):
    return _manifest(spark, folder)


@query(f"SELECT DISTINCT Connection_Name AS connection FROM {sql('manifest_rows')} AS m WHERE Connection_Name <> 'nan'")
def q_distinct_connections(spark, folder):
    return connections(_manifest(spark, folder))


_CONDITIONS = {"none": None, "empty": "", "blank": "  ", "nan": "NaN", "where": "where value > 50", "bare": "value > 50"}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS given, count(*) AS n_rows FROM events WHERE {'true' if name in ('none', 'empty', 'blank', 'nan') else 'value > 50'}"
        for name in _CONDITIONS
    )
)
def q_missing_condition(spark, folder):
    events = table(spark, folder, "events")
    parts = [filtered(events, text).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("given"), "n_rows") for name, text in _CONDITIONS.items()]
    return reduce(DataFrame.unionAll, parts)


@query(f"""
    WITH s AS (SELECT l_partkey * l_partkey AS k FROM lineitem),
         b AS (SELECT {", ".join(f"percentile_disc({i / 8}) WITHIN GROUP (ORDER BY k) AS b{i}" for i in range(1, 8))} FROM s),
         p AS (SELECT {" + ".join(f"CASE WHEN k > b{i} THEN 1 ELSE 0 END" for i in range(1, 8))} AS part, k FROM s, b)
    SELECT part::INT AS part, count(*) AS n_rows, min(k) AS lowest, max(k) AS highest FROM p GROUP BY part""")
def q_jdbc_split_bounds(spark, folder):
    """The texts that split a JDBC read, here answered by a view over a key of squares."""
    place = "tallymark_lines"
    table(spark, folder, "lineitem").selectExpr("l_partkey * l_partkey as k").createOrReplaceTempView(place)
    bounds = read_query(spark, bounds_query("k", 8, place, spread=True)).first()
    parts = split_predicates("k", list(bounds), T.LongType())
    rows = read_query(spark, f"select case {' '.join(f'when {p} then {i}' for i, p in enumerate(parts))} end as part, k from {place}")
    return rows.groupBy("part").agg(F.count("*").alias("n_rows"), F.min("k").alias("lowest"), F.max("k").alias("highest"))


# ---------------------------------------------------------------- checks


@query(f"""
    SELECT s AS count_source, t AS count_target, CASE WHEN s = t THEN 'Count Match' ELSE 'Count Mismatch' END AS status,
           concat(s, ' vs ', t) AS remarks
    FROM (SELECT (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM {sql("orders_target")} AS t) AS t) AS c""")
def q_row_count_check(spark, folder):
    return row_count_check(table(spark, folder, "orders"), table(spark, folder, "orders_target"))


@query(o.wide_sql("orders_target", ORDERS, "Null"))
def q_null_count_check(spark, folder):
    return single_check(table(spark, folder, "orders_target"), "Null")


@query(o.wide_sql("lineitem", LINEITEM, "Sum", "VARCHAR"))
def q_sum_check_integral(spark, folder):
    return _text(single_check(table(spark, folder, "lineitem"), "Sum"))


@query(
    o.wide_sql(
        "lineitem_decimal", dict(l_quantity="d", l_extendedprice="d", l_discount="d", l_tax="d"), "Sum", "VARCHAR"
    )
)
def q_sum_check_decimal(spark, folder):
    return _text(single_check(table(spark, folder, "lineitem_decimal"), "Sum"))


@query(o.wide_sql("orders", ORDERS, "Max", "TIMESTAMP"))
def q_minmax_temporal_check(spark, folder):
    return single_check(table(spark, folder, "orders"), "Max")


@query(o.wide_sql("events", o.COLUMNS["events"], "Max", "TIMESTAMP"))
def q_minmax_temporal_events(spark, folder):
    return single_check(table(spark, folder, "events"), "Max")


def _char_part(spark, folder):
    """Padded types declared as CHAR, the way a catalog table carries the declaration."""
    declared = {CHAR_VARCHAR_KEY: "char(27)"}
    padded = table(spark, folder, "part_padded")
    return padded.withColumn("p_type", F.col("p_type").alias("p_type", metadata=declared))


@query(o.wide_sql("part_padded", PART, "Length"))
def q_length_check(spark, folder):
    return single_check(_char_part(spark, folder), "Length")


@query(f"""
    SELECT max(length(p_name)) AS max_len_p_name, min(length(p_name)) AS min_len_p_name,
           max(length(p_brand)) AS max_len_p_brand, min(length(p_brand)) AS min_len_p_brand,
           max(length(rtrim(p_type))) AS max_len_p_type, min(length(rtrim(p_type))) AS min_len_p_type
    FROM {sql("part_padded")} AS p""")
def q_rtrim_length_check(spark, folder):
    return single_check(_char_part(spark, folder), "RLength")


@query(o.compare_sql("part_padded", "part", PART, padded=("p_type",)))
def q_rtrim_length_compare(spark, folder):
    return check_compare(_char_part(spark, folder), table(spark, folder, "part"))


@query(o.profile_sql("orders_target", ORDERS))
def q_profile_all_checks(spark, folder):
    return profile(table(spark, folder, "orders_target"))


@query(o.profile_sql("lineitem", LINEITEM))
def q_profile_lineitem(spark, folder):
    return profile(table(spark, folder, "lineitem"))


@query(o.profile_sql("orders_target", ORDERS))
def q_profile_incremental(spark, folder):
    """A table that grows by files, changes some and loses one between two profiles."""
    orders, path, store = table(spark, folder, "orders_target"), new_folder(spark, "growing"), new_folder(spark, "profiles")
    parts = [f"{path}/part={i}" for i in range(3)]
    halves = [orders.where(f"pmod(o_orderkey, 2) = {i}") for i in range(2)]
    halves[0].write.parquet(parts[0])
    halves[0].limit(10).coalesce(1).write.parquet(parts[1])
    profile_incremental(spark, f"{path}/part=*", store)
    halves[1].write.mode("overwrite").parquet(parts[1])
    return profile_incremental(spark, f"{path}/part=*", store)


_COMPARED = o.compare_sql("orders", "orders_target", ORDERS)


def _orders_compared(spark, folder):
    return check_compare(table(spark, folder, "orders"), table(spark, folder, "orders_target"))


@query(_COMPARED)
def q_check_compare(spark, folder):
    return _orders_compared(spark, folder)


@query(o.summary_sql(_COMPARED))
def q_check_summary(spark, folder):
    return check_summary(_orders_compared(spark, folder))


@query(o.verdict_sql(o.summary_sql(_COMPARED)))
def q_table_verdict(spark, folder):
    return table_verdict(check_summary(_orders_compared(spark, folder)))


@query(
    o.summary_sql(
        o.compare_sql(
            "orders", "orders_target", ORDERS, "o_orderpriority <> '1-URGENT'", "o_orderstatus IN ('F', 'O', 'X')"
        )
    )
)
def q_filtered_check(spark, folder):
    source = filtered(table(spark, folder, "orders"), "WHERE o_orderpriority <> '1-URGENT'")
    target = filtered(table(spark, folder, "orders_target"), "o_orderstatus in ('F', 'O', 'X')")
    return check_summary(check_compare(source, target))


# ---------------------------------------------------------------- hashed averages


@query(o.hash_profile_sql("customer", CUSTOMER))
def q_hash_profile_md5(spark, folder):
    return hash_profile_long(table(spark, folder, "customer"), "md5")


_MURMUR_MEANS = {
    "n": "CAST(sum(CAST({0} AS BIGINT)) AS DOUBLE) / count({0})",
    "f": "CAST(sum(CAST({0} AS DECIMAL(18, 2))) AS DECIMAL(18, 2))::DOUBLE / count({0})",
}


@query(
    "SELECT "
    + ", ".join(
        (_MURMUR_MEANS[k].format(c) if k in _MURMUR_MEANS else f"CAST(sum({o.murmur_sql(c)}) AS DOUBLE) / count(*)") + f' AS "avg{c}"'
        for c, k in CUSTOMER.items()
    )
    + " FROM customer"
)
def q_hash_profile_murmur(spark, folder):
    return hash_profile(table(spark, folder, "customer"))


@query(f"""
    SELECT 'Count' AS key, 'Count Match' AS Status, concat(n, ' vs ', n) AS Remarks
    FROM (SELECT count(*) AS n FROM customer) AS c
    UNION ALL
    SELECT 'Data', CASE WHEN count(*) = 0 THEN 'Data Match' ELSE 'Data Mismatch' END,
           coalesce(string_agg(s.metric, ', ' ORDER BY s.metric), '-')
    FROM ({o.hash_profile_sql("customer", CUSTOMER)}) AS s
    JOIN ({o.hash_profile_sql("customer_target", CUSTOMER)}) AS t ON s.metric = t.metric
    WHERE s.value IS DISTINCT FROM t.value""")
def q_hash_profile_compare(spark, folder):
    return hash_profile_compare(table(spark, folder, "customer"), table(spark, folder, "customer_target"), "md5")


# ---------------------------------------------------------------- schema


@query("""
    SELECT 'o_orderstatus' AS "column", 'data_type' AS issue, 'STRING' AS source_type, 'DATE' AS target_type,
           CAST(max(length(o_orderstatus)) AS VARCHAR) AS source_length, CAST(NULL AS VARCHAR) AS target_length
    FROM orders
    UNION ALL
    SELECT 'o_orderpriority', 'missing_in_target', 'STRING', NULL, CAST(max(length(o_orderpriority)) AS VARCHAR), NULL
    FROM orders
    UNION ALL
    SELECT 'load_id', 'missing_in_source', NULL, 'BIGINT', NULL, NULL""")
def q_schema_diff(spark, folder):
    return schema_diff(table(spark, folder, "orders"), table(spark, folder, "orders_variant"), observe=True)


@query(f"""
    SELECT 'o_orderpriority' AS "column", 'target' AS missing_in, 'STRING' AS data_type,
           count(o_orderpriority) AS n_values FROM orders
    UNION ALL
    SELECT 'load_id', 'source', 'BIGINT', count(load_id) FROM {sql("orders_variant")} AS v""")
def q_missing_columns(spark, folder):
    return missing_columns(table(spark, folder, "orders"), table(spark, folder, "orders_variant"))


_RENAMES = {"o_custkey": "customer", "o_orderpriority": "urgency", "o_orderdate": "placed", "o_totalprice": "other"}


@query("""
    WITH s AS (SELECT unnest(['o_custkey', 'o_orderpriority', 'o_orderdate', 'o_totalprice']) AS source_column, unnest([o_custkey::VARCHAR, o_orderpriority, o_orderdate::VARCHAR, o_totalprice::VARCHAR]) AS v FROM orders),
         t AS (SELECT unnest(['customer', 'urgency', 'placed', 'other']) AS target_column, unnest([o_custkey::VARCHAR, o_orderpriority, o_orderdate::VARCHAR, (o_totalprice + 1000000)::VARCHAR]) AS v FROM orders WHERE o_orderkey % 10 <> 0),
         d AS (SELECT DISTINCT source_column, v FROM s), e AS (SELECT DISTINCT target_column, v FROM t),
         n AS (SELECT source_column, count(*) AS n FROM d GROUP BY ALL), m AS (SELECT target_column, count(*) AS m FROM e GROUP BY ALL),
         b AS (SELECT source_column, target_column, count(*) AS c FROM d JOIN e USING (v) GROUP BY ALL)
    SELECT source_column, target_column FROM b JOIN n USING (source_column) JOIN m USING (target_column) WHERE c >= 0.5 * (n + m - c)""")
def q_renamed_columns(spark, folder):
    """Three renamed columns are told; one that was lost and another that was gained are not a pair."""
    orders = table(spark, folder, "orders")
    target = orders.where("o_orderkey % 10 <> 0").withColumn("o_totalprice", F.col("o_totalprice") + 1000000).withColumnsRenamed(_RENAMES)
    return renamed_columns(orders, target).select("source_column", "target_column")


def _keys_sql(name: str, columns: list[str]) -> str:
    full = " AND ".join(f"(SELECT count({c}) FROM {name}) = (SELECT count(*) FROM {name})" for c in ["{0}", "{1}"])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = "(SELECT count(DISTINCT {0}) FROM {1}) = (SELECT count(*) FROM {1})"
    two = "(SELECT count(*) FROM (SELECT DISTINCT {0}, {1} FROM {2})) = (SELECT count(*) FROM {2})"
    parts = [f"SELECT '{name}' AS of_table, '{c}' AS key, 1 AS n_columns WHERE {one.format(c, name)}" for c in columns]
    parts += [
        f"SELECT '{name}', '{a}, {b}', 2 WHERE {two.format(a, b, name)} AND NOT {one.format(a, name)} AND NOT {one.format(b, name)} AND {full.format(a, b)}"
        for a, b in pairs
    ]
    return " UNION ALL ".join(parts)


_KEYED = {"orders": list(ORDERS), "customer": list(CUSTOMER), "lineitem": ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]}


@query(" UNION ALL ".join(_keys_sql(name, columns) for name, columns in _KEYED.items()))
def q_candidate_keys(spark, folder):
    parts = [candidate_keys(table(spark, folder, name).select(*columns)).select(F.lit(name).alias("of_table"), "*") for name, columns in _KEYED.items()]
    return reduce(DataFrame.unionAll, parts)


# ---------------------------------------------------------------- rows and cells

_ORDER_COLUMNS, _LINE_COLUMNS = list(ORDERS), list(LINEITEM)


def _equality_sql(label: str, source: str, target: str, columns: list[str]) -> str:
    return f"""
        ({o.paired_sql(source, target, columns)}
        SELECT '{label}' AS label, CAST(sum(ns) AS BIGINT) AS count_source, CAST(sum(nt) AS BIGINT) AS count_target,
               CAST(sum(greatest(ns - nt, 0)) AS BIGINT) AS source_extra,
               CAST(sum(greatest(nt - ns, 0)) AS BIGINT) AS target_extra,
               CASE WHEN bool_and(ns = nt) THEN 'Data Match' ELSE 'Data Mismatch' END AS status, '-' AS remarks
        FROM counts)"""


@query(
    _equality_sql("shuffled", "orders", "orders_shuffled", _ORDER_COLUMNS)
    + " UNION ALL "
    + _equality_sql("changed", "orders", "orders_target", _ORDER_COLUMNS)
)
def q_table_equality(spark, folder):
    orders = table(spark, folder, "orders")
    same = table_equality(orders, table(spark, folder, "orders_shuffled"))
    changed = table_equality(orders, table(spark, folder, "orders_target"))
    return same.select(F.lit("shuffled").alias("label"), "*").unionByName(
        changed.select(F.lit("changed").alias("label"), "*")
    )


@query(f"""
    {o.paired_sql("lineitem", "lineitem_target", _LINE_COLUMNS)}
    SELECT {", ".join(_LINE_COLUMNS)}, CAST(xs AS BIGINT) AS source_extra, CAST(xt AS BIGINT) AS target_extra
    FROM surplus""")
def q_bag_diff(spark, folder):
    return bag_diff(table(spark, folder, "lineitem"), table(spark, folder, "lineitem_target"))


@query(f"""
    {o.paired_sql("lineitem", "lineitem_one_changed", _LINE_COLUMNS)}
    SELECT {", ".join(_LINE_COLUMNS)}, CAST(xs AS BIGINT) AS source_extra, CAST(xt AS BIGINT) AS target_extra
    FROM surplus""")
def q_equality_by_buckets(spark, folder):
    return bag_diff_by_buckets(table(spark, folder, "lineitem"), table(spark, folder, "lineitem_one_changed"), LINE_KEYS)


_ORDERS_JOIN = f"""
    FROM (SELECT *, 1 AS here FROM orders) AS s
    FULL OUTER JOIN (SELECT *, 1 AS here FROM {sql("orders_target")} AS x) AS t ON s.o_orderkey = t.o_orderkey"""
_ORDERS_DIFFER = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in _ORDER_COLUMNS)


@query(f"""
    SELECT k.status, coalesce(n_rows, 0) AS n_rows
    FROM (VALUES ('match'), ('mismatch'), ('source_only'), ('target_only')) AS k(status)
    LEFT JOIN (SELECT CASE WHEN t.here IS NULL THEN 'source_only' WHEN s.here IS NULL THEN 'target_only'
                           WHEN {_ORDERS_DIFFER} THEN 'mismatch' ELSE 'match' END AS status, count(*) AS n_rows
               {_ORDERS_JOIN} GROUP BY 1) AS c ON k.status = c.status""")
def q_row_status_counts(spark, folder):
    return row_status_counts(table(spark, folder, "orders"), table(spark, folder, "orders_target"), ["o_orderkey"])


def _orders_diff(spark, folder):
    return keyed_diff(table(spark, folder, "orders"), table(spark, folder, "orders_target"), ["o_orderkey"])


_ORDERS_CELLS = o.cells_sql(
    _ORDERS_JOIN, ["o_orderkey"], _ORDER_COLUMNS[1:], "s.here IS NOT NULL AND t.here IS NOT NULL"
)


@query(_ORDERS_CELLS)
def q_cell_diff_keyed(spark, folder):
    return _orders_diff(spark, folder).cells().drop("occurrence")


@query(_ORDERS_CELLS)
def q_keyed_diff_small(spark, folder):
    orders, changed = table(spark, folder, "orders"), table(spark, folder, "orders_target")
    return keyed_diff_small(orders, changed, ["o_orderkey"]).cells().drop("occurrence")


#: Diffs of one query that run at a time.
_AT_ONCE = 4
_KEY_NAMES = ["status", "source", "target", "s", "t", "row", "occurrence", "column", "place", "k0"]
_NAMED = ["_part", "_n_source", "source_extra", "diff", "c1"]


def _named_sql(key: str) -> str:
    join = f"FROM {sql(f'orders_named@{key}')} AS s JOIN {sql(f'orders_named_target@{key}')} AS t ON s.{key} = t.{key}"
    cells = o.cells_sql(join, [key], _NAMED)
    return f"""SELECT '{key}' AS key_name, {key} AS key_value, "column" AS col, source_value, target_value FROM ({cells}) AS c"""


@query(" UNION ALL ".join(map(_named_sql, [k for k in _KEY_NAMES if k != "column"])) + """
    UNION ALL SELECT 'column', key_value, col, source_value, target_value FROM (""" + _named_sql("k0") + """) AS c""")
def q_keyed_diff_reserved_names(spark, folder):
    """Keys and columns called what the reports call their own.

    Each diff writes tables before it returns, with steps of few tasks in between; a few diffs at once fill the cores.
    """

    def cells(key: str) -> DataFrame:
        found = keyed_diff(*[table(spark, folder, f"orders_named{side}@`{key}`") for side in ("", "_target")], [key]).cells()
        found = found.toDF("key_value", "occurrence", "col", "source_value", "target_value", "diff")
        return found.select(F.lit(key).alias("key_name"), "key_value", "col", "source_value", "target_value")

    with ThreadPoolExecutor(max_workers=_AT_ONCE) as pool:
        parts = list(pool.map(inheritable_thread_target(spark)(cells), _KEY_NAMES))
    return reduce(DataFrame.unionAll, parts)


_NAMED_ROWS = f"""
    {o.paired_sql("orders_named@status", "orders_named_target@status", ["status", *_NAMED])}
    SELECT status, {", ".join(_NAMED)}, CAST(xs AS BIGINT) AS source_extra_, CAST(xt AS BIGINT) AS target_extra FROM surplus"""


@query(_NAMED_ROWS)
def q_bag_diff_reserved_names(spark, folder):
    return bag_diff(table(spark, folder, "orders_named@status"), table(spark, folder, "orders_named_target@status"))


@query(_ORDERS_CELLS)
def q_cell_diff_unique_key(spark, folder):
    orders, changed = table(spark, folder, "orders"), table(spark, folder, "orders_target")
    return keyed_diff(orders, changed, ["o_orderkey"], unique=True).cells().drop("occurrence")


@query(f'SELECT "column", count(*) AS n_mismatch FROM ({_ORDERS_CELLS}) AS c GROUP BY "column"')
def q_column_mismatch(spark, folder):
    return _orders_diff(spark, folder).columns()


def _lines_diff(spark, folder):
    return keyed_diff(table(spark, folder, "lineitem"), table(spark, folder, "lineitem_changed"), LINE_KEYS)


_LINE_CTES = o.numbered_sql("lineitem", "lineitem_changed", LINE_KEYS, _LINE_COLUMNS)


@query(
    _LINE_CTES
    + o.cells_sql(
        o.keyed_pairs(LINE_KEYS),
        LINE_KEYS + ["occurrence"],
        [c for c in _LINE_COLUMNS if c not in LINE_KEYS],
        "s.occurrence IS NOT NULL AND t.occurrence IS NOT NULL",
    )
)
def q_keyed_diff_duplicates(spark, folder):
    return _lines_diff(spark, folder).cells()


@query(f"""
    {_LINE_CTES}
    SELECT coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey,
           coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber, coalesce(s.occurrence, t.occurrence) AS occurrence,
           CASE WHEN t.occurrence IS NULL THEN 'source_only' WHEN s.occurrence IS NULL THEN 'target_only'
                ELSE 'mismatch' END AS status
    {o.keyed_pairs(LINE_KEYS)}""")
def q_row_status_duplicates(spark, folder):
    return _lines_diff(spark, folder).rows.select(*LINE_KEYS, "occurrence", "status")


@query(f"""
    SELECT l_orderkey, l_linenumber, CAST(sum(s) AS BIGINT) AS count_source, CAST(sum(t) AS BIGINT) AS count_target
    FROM (SELECT l_orderkey, l_linenumber, 1 AS s, 0 AS t FROM lineitem
          UNION ALL SELECT l_orderkey, l_linenumber, 0, 1 FROM {sql("lineitem_changed")} AS c) AS u
    GROUP BY l_orderkey, l_linenumber HAVING sum(s) > 1 OR sum(t) > 1""")
def q_duplicate_key_counts(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), table(spark, folder, "lineitem_changed"), LINE_KEYS)


@query(o.positional_sql("part", "part_target", list(PART)))
def q_cell_diff_positional(spark, folder):
    return positional_diff(table(spark, folder, "part"), table(spark, folder, "part_target")).cells()


@query(o.positional_sql("texts", "texts_target", ["source", "text", "lang", "doc_id", "n_chars"]))
def q_cell_diff_positional_wide(spark, folder):
    """Whole documents in the sort key, behind a column of few values."""
    return positional_diff(table(spark, folder, "texts"), table(spark, folder, "texts_target")).cells()


@query(o.positional_sql("flags", "flags_target", ["l_returnflag", "l_linestatus", "l_quantity"]))
def q_cell_diff_positional_repeats(spark, folder):
    return positional_diff(table(spark, folder, "flags"), table(spark, folder, "flags_target")).cells()


@query(o.positional_sql("part", "part_shorter", list(PART)))
def q_compare_unequal_counts(spark, folder):
    return compare(table(spark, folder, "part"), table(spark, folder, "part_shorter")).cells()


# ---------------------------------------------------------------- lost and retyped columns

_LOST = "Column o_orderpriority not in Target"
_KEPT = ", ".join(c for c in ORDERS if c != "o_orderpriority")


@query(f"""
    SELECT k.status, n_rows::BIGINT AS n_rows FROM (
      SELECT count(*) FILTER (WHERE o_orderkey % 97 <> 0) AS match, 0 AS mismatch,
             count(*) FILTER (WHERE o_orderkey % 97 = 0) AS source_only, 0 AS target_only, 1 AS unaligned_columns
      FROM orders) AS c UNPIVOT (n_rows FOR status IN (match, mismatch, source_only, target_only, unaligned_columns)) AS k""")
def q_row_status_lost_column(spark, folder):
    return row_status_counts(table(spark, folder, "orders"), table(spark, folder, "orders_lost"), ["o_orderkey"])


@query(f"""
    SELECT {_KEPT}, 1::BIGINT AS source_extra, 0::BIGINT AS target_extra, CAST(NULL AS VARCHAR) AS remarks
    FROM orders WHERE o_orderkey % 97 = 0
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 0, 0, '{_LOST}'""")
def q_bag_diff_lost_column(spark, folder):
    return bag_diff(table(spark, folder, "orders"), table(spark, folder, "orders_lost"))


@query("""
    SELECT * FROM (VALUES
      ('Count', 'Match', '-'),
      ('Null', 'Not match', 'Column number_of_null_values_o_orderpriority not in Target, Column o_orderdate of another type, Column o_orderstatus of another type'),
      ('Sum', 'Not match', 'Column sum_o_orderdate not in Source, Column sum_o_orderstatus not in Source'),
      ('Max', 'Not match', 'Column max_o_orderdate not in Target, Column min_o_orderdate not in Target'),
      ('Length', 'Not match', 'Column max_len_o_orderpriority not in Target, Column max_len_o_orderstatus not in Target, Column min_len_o_orderpriority not in Target, Column min_len_o_orderstatus not in Target'),
      ('RLength', 'Not match', 'Column max_len_o_orderpriority not in Target, Column max_len_o_orderstatus not in Target, Column min_len_o_orderpriority not in Target, Column min_len_o_orderstatus not in Target')
    ) AS t(TestCases, Status, Remarks)""")  # noqa: E501
def q_check_compare_retyped(spark, folder):
    return check_summary(check_compare(table(spark, folder, "orders"), table(spark, folder, "orders_retyped")))


@query(f"""
    WITH s AS (SELECT count(*) AS n, sum(k::HUGEINT) AS total FROM {sql("far_keys")} AS a),
         t AS (SELECT count(*) AS n, sum(k::HUGEINT) AS total FROM {sql("far_keys_changed")} AS b)
    SELECT 'Count' AS key, CASE WHEN s.n = t.n THEN 'Count Match' ELSE 'Count Mismatch' END AS Status, concat(s.n, ' vs ', t.n) AS Remarks FROM s, t
    UNION ALL
    SELECT 'Data', CASE WHEN s.total = t.total THEN 'Data Match' ELSE 'Data Mismatch' END, CASE WHEN s.total = t.total THEN '-' ELSE 'avgk' END FROM s, t""")
def q_hash_profile_compare_exact(spark, folder):
    return hash_profile_compare(table(spark, folder, "far_keys"), table(spark, folder, "far_keys_changed"), "md5")


# ---------------------------------------------------------------- reports

_BY_FLAG = "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_quantity) AS top FROM {l} GROUP BY ALL"
_BY_FLAG_SQL = _BY_FLAG.replace("{l}", "lineitem")
_BY_FLAG_CHANGED_SQL = _BY_FLAG.replace("{l}", sql("lineitem_target") + " AS t")


@query(f"""
    WITH s AS (SELECT *, row_number() OVER (ORDER BY l_returnflag NULLS LAST, l_linestatus NULLS LAST, n, top) AS i
               FROM ({_BY_FLAG_SQL}) AS a),
         t AS (SELECT *, row_number() OVER (ORDER BY l_returnflag NULLS LAST, l_linestatus NULLS LAST, n, top) AS i
               FROM ({_BY_FLAG_CHANGED_SQL}) AS b),
         d AS (SELECT concat_ws(', ',
                   CASE WHEN bool_or(s.l_returnflag IS DISTINCT FROM t.l_returnflag) THEN 'l_returnflag' END,
                   CASE WHEN bool_or(s.l_linestatus IS DISTINCT FROM t.l_linestatus) THEN 'l_linestatus' END,
                   CASE WHEN bool_or(s.n IS DISTINCT FROM t.n) THEN 'n' END,
                   CASE WHEN bool_or(s.top IS DISTINCT FROM t.top) THEN 'top' END) AS columns
               FROM s JOIN t ON s.i = t.i)
    SELECT 'Count' AS key, 'Count Match' AS Status,
           concat((SELECT count(*) FROM s), ' vs ', (SELECT count(*) FROM t)) AS Remarks
    UNION ALL
    SELECT 'Data', CASE WHEN columns = '' THEN 'Data Match' ELSE 'Data Mismatch' END,
           CASE WHEN columns = '' THEN '-' ELSE columns END FROM d""")
def q_custom_query_compare(spark, folder):
    source = read_query(spark, _BY_FLAG, l=table(spark, folder, "lineitem"))
    target = read_query(spark, _BY_FLAG, l=table(spark, folder, "lineitem_target"))
    return compare(source, target).summary()


@query(f"""
    WITH c AS (SELECT DISTINCT "column" AS c FROM ({_ORDERS_CELLS}) AS x),
         n AS (SELECT count(*) FILTER (WHERE t.here IS NULL) AS s, count(*) FILTER (WHERE s.here IS NULL) AS t {_ORDERS_JOIN})
    SELECT 'Count' AS key, 'Count Mismatch' AS Status,
           concat((SELECT count(*) FROM orders), ' vs ', (SELECT count(*) FROM {sql("orders_target")} AS o)) AS Remarks
    UNION ALL
    SELECT 'Data', 'Data Mismatch', concat_ws(', ', {", ".join(f"(SELECT c FROM c WHERE c = '{c}')" for c in _ORDER_COLUMNS)},
           CASE WHEN s > 0 THEN concat(s, ' rows only in Source') END, CASE WHEN t > 0 THEN concat(t, ' rows only in Target') END) FROM n""")
def q_compare_observed(spark, folder):
    """Rows are counted by the pass that pairs them."""
    return compare(table(spark, folder, "orders"), table(spark, folder, "orders_target"), ["o_orderkey"]).summary()


@query("SELECT event_id, ts, event_type, value FROM events ORDER BY ts, event_id LIMIT 1000")
def q_topn_preview(spark, folder):
    return preview(table(spark, folder, "events").select("event_id", "ts", "event_type", "value"), ["ts", "event_id"])


_JOB = {
    "orders": "orders_target",
    "customer": "customer_target",
    "part": "part",
    "lineitem": "lineitem_target",
    "customer again": "customer",
    "missing": "absent",
}


def _job(spark, folder):
    manifest = normalise_manifest(
        spark.createDataFrame([(n, n.split()[0], t) for n, t in _JOB.items()], "table string, source string, target string")
    )
    return run(spark, manifest, read=lambda session, row, side: table(session, folder, row[side]))


_JOB_SQL = {
    n: o.summary_sql(o.compare_sql(n.split()[0], t, o.COLUMNS[n.split()[0]])) for n, t in _JOB.items() if n != "missing"
}


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", Status, Remarks FROM ({o.verdict_sql(s)}) AS j" for n, s in _JOB_SQL.items()
    )
    + " UNION ALL SELECT 'missing', 'Failed with Error', 'KeyError: ''missing'''"
)
def q_job_summary(spark, folder):
    return _job(spark, folder).report.select("table", "Status", "Remarks")


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", TestCases, Status, Remarks FROM ({s}) AS j" for n, s in _JOB_SQL.items()
    )
)
def q_job_checks(spark, folder):
    return _job(spark, folder).summary.drop("job_row")


@query(" UNION ALL ".join(
    f"""SELECT '{run_id}' AS run_id, "check", count(*) AS n_metrics FROM ({o.compare_sql("customer", "customer_target", CUSTOMER)}) AS c GROUP BY "check" """
    for run_id in ("first", "second")
))
def q_run_stamp(spark, folder):
    """Two runs append to the same reports, each under its stamp."""
    path = new_folder(spark, "reports")
    manifest = normalise_manifest(spark.createDataFrame([("customer", "customer_target")], "source string, target string"))
    for run_id in ("first", "second"):
        run(spark, manifest, read=lambda session, row, side: table(session, folder, row[side]), folder=path, run_id=run_id)
    return spark.read.parquet(f"{path}/detail").groupBy("run_id", "check").agg(F.count("*").alias("n_metrics"))


@query(_ORDERS_CELLS)
def q_diff_sink_roundtrip(spark, folder):
    path = new_folder(spark, "cells")
    write_result(_orders_diff(spark, folder).cells().drop("occurrence"), path, partition_by=["column"])
    return spark.read.parquet(path)
