"""Target tables derived from the given ones by fixed rules, as SQL that both engines run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DERIVED = {
    # Rows dropped, statuses and prices changed, prices lost, rows added under unused keys.
    "orders_target": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderkey % 70 = 0 THEN NULL WHEN o_orderkey % 30 = 0 THEN o_totalprice + 1
                    ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 97 <> 0
        UNION ALL
        SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 500 = 1""",
    # Rows dropped, rows doubled.
    "lineitem_target": """
        SELECT * FROM {lineitem} WHERE l_orderkey % 97 <> 0
        UNION ALL SELECT * FROM {lineitem} WHERE l_orderkey % 100 = 0""",
    # Values changed under keys that repeat; rows dropped, rows doubled.
    "lineitem_changed": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CASE WHEN l_partkey % 40 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
               l_extendedprice, l_discount, l_tax,
               CASE WHEN l_suppkey % 20 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
               l_linestatus, l_shipdate
        FROM {lineitem} WHERE l_orderkey % 97 <> 0
        UNION ALL SELECT * FROM {lineitem} WHERE l_orderkey % 100 = 0""",
    "part_target": """
        SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_partkey % 41 = 0 THEN 0 ELSE p_size END AS p_size,
               p_retailprice
        FROM {part}""",
    # Few columns with few values: nearly all rows repeat.
    "flags": "SELECT l_returnflag, l_linestatus, l_quantity FROM {lineitem}",
    "flags_target": """
        SELECT l_returnflag, l_linestatus,
               CASE WHEN l_orderkey % 900 = 0 THEN 51.0 WHEN l_orderkey % 800 = 0 THEN NULL ELSE l_quantity END
                   AS l_quantity
        FROM {lineitem}""",
    "customer_target": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal,
               CASE WHEN c_custkey % 10 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
        FROM {customer}""",
    # Narrower key, decimal price, one column lost, one gained.
    "orders_variant": """
        SELECT CAST(o_orderkey AS INT) AS o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderstatus,
               CAST(o_totalprice AS DECIMAL(18, 2)) AS o_totalprice, o_orderdate, o_custkey % 7 AS load_id
        FROM {orders}""",
    "lineitem_decimal": """
        SELECT CAST(l_quantity AS DECIMAL(18, 2)) AS l_quantity,
               CAST(l_extendedprice AS DECIMAL(18, 2)) AS l_extendedprice,
               CAST(l_discount AS DECIMAL(18, 2)) AS l_discount, CAST(l_tax AS DECIMAL(18, 2)) AS l_tax
        FROM {lineitem}""",
    "part_padded": """
        SELECT p_partkey, p_name, p_brand, concat(p_type, '  ') AS p_type, p_size, p_retailprice FROM {part}""",
    "part_shorter": "SELECT * FROM {part} WHERE p_partkey % 500 <> 250",
    "orders_retyped": """
        SELECT o_orderkey, o_custkey, CAST(o_orderkey % 2 AS INT) AS o_orderstatus, o_totalprice,
               CAST(o_orderkey AS INT) AS o_orderdate FROM {orders}""",
    "orders_lost": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM {orders} WHERE o_orderkey % 97 <> 0",
    # Keys in a range where doubles no longer tell neighbours apart.
    "far_keys": "SELECT 100000000000000000 + l_orderkey * 10 + l_linenumber AS k FROM {lineitem}",
    "far_keys_changed": """
        SELECT 100000000000000000 + l_orderkey * 10 + l_linenumber + CASE WHEN l_linenumber = 1 AND l_orderkey = 7 THEN 1 ELSE 0 END AS k
        FROM {lineitem}""",
    "orders_shuffled": """
        SELECT o_orderpriority, o_totalprice, o_orderdate, o_orderstatus, o_custkey, o_orderkey FROM {orders}""",
    # One value of one row changed.
    "lineitem_one_changed": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               l_quantity + CASE WHEN l_orderkey = (SELECT min(l_orderkey) FROM {lineitem}) AND l_partkey = (
                   SELECT min(l_partkey) FROM {lineitem} WHERE l_orderkey = (SELECT min(l_orderkey) FROM {lineitem})) THEN 1 ELSE 0 END AS l_quantity,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        FROM {lineitem}""",
    # Long texts and few sources in front of the key: sorted parts must look past both.
    "texts": "SELECT source, text, lang, doc_id, n_chars FROM {documents}",
    "texts_target": """
        SELECT source, text, CASE WHEN doc_id % 90 = 0 THEN NULL ELSE lang END AS lang, doc_id,
               CASE WHEN doc_id % 70 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars
        FROM {documents}""",
    # Columns whose names the library's own reports and helpers use.
    "orders_named": """
        SELECT o_orderkey AS {key}, o_custkey AS _part, o_orderstatus AS _n_source, o_totalprice AS source_extra,
               o_orderdate AS diff, o_orderpriority AS c1 FROM {orders}""",
    "orders_named_target": """
        SELECT o_orderkey AS {key}, o_custkey AS _part,
               CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE o_orderstatus END AS _n_source,
               CASE WHEN o_orderkey % 70 = 0 THEN NULL ELSE o_totalprice END AS source_extra,
               o_orderdate AS diff, o_orderpriority AS c1 FROM {orders} WHERE o_orderkey % 97 <> 0""",
    # A catalog's columns view, one row per part.
    "catalog_view": """
        SELECT p_partkey AS ColumnId, concat(p_name, '  ') AS ColumnName,
               CASE p_partkey % 12 WHEN 0 THEN 'CF' WHEN 1 THEN 'CV' WHEN 2 THEN 'D ' WHEN 3 THEN 'I ' WHEN 4 THEN 'I8'
                    WHEN 5 THEN 'DA' WHEN 6 THEN 'TS' WHEN 7 THEN 'SZ' WHEN 8 THEN 'BO' WHEN 9 THEN 'JN'
                    WHEN 10 THEN 'YR' ELSE '??' END AS ColumnType,
               CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS Nullable,
               p_size % 30 + 8 AS DecimalTotalDigits, p_size % 8 AS DecimalFractionalDigits
        FROM {part}""",
    # The same beside sixteen other columns, as in a catalog with more than one table.
    "catalog_wide": """
        SELECT """ + ", ".join(f"p_size + {i} AS x{i}" for i in range(14)) + """,
               concat('db', p_size % 3) AS DatabaseName, concat('t', p_size % 5) AS TableName,
               p_partkey AS ColumnId, concat(p_name, '  ') AS ColumnName,
               CASE p_partkey % 3 WHEN 0 THEN 'D ' WHEN 1 THEN 'CV' ELSE 'I8' END AS ColumnType,
               CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS Nullable,
               p_size % 30 + 8 AS DecimalTotalDigits, p_size % 8 AS DecimalFractionalDigits
        FROM {part}""",
    # What a catalog says about a column in words.
    "type_texts": """
        SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN ' ' ELSE concat(p_name, ' ') END AS name,
               CASE p_partkey % 6 WHEN 0 THEN concat('varchar(', p_size, ')')
                                  WHEN 1 THEN concat('decimal(', p_size % 30 + 8, ', ', p_size % 8, ')')
                                  WHEN 2 THEN 'array<decimal(3,1)>' WHEN 3 THEN 'void' WHEN 4 THEN ' Bigint'
                                  ELSE 'timestamp' END AS type_text
        FROM {part}""",
    # A manifest as a file holds it: other header names, blank and nan cells.
    "manifest_rows": """
        SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'nan' ELSE concat('env', s_nationkey % 3) END AS Connection_Name,
               s_name AS Table_Name, concat('t', s_suppkey) AS Iceberg_Table, 'lake' AS Iceberg_database,
               CASE WHEN s_suppkey % 5 = 0 THEN concat('select ''a, b'', "q" from t', s_suppkey) ELSE '' END AS query_TD,
               CASE WHEN s_suppkey % 7 = 0 THEN 'where x > 1' ELSE 'nan' END AS condition_td
        FROM {supplier}""",
    "view_names": """
        SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN concat(c_mktsegment, '_V.order_values_v')
                               WHEN c_custkey % 3 = 1 THEN concat(c_mktsegment, '_v.', c_name)
                               ELSE concat(c_mktsegment, '_T.', c_name, '_V') END AS name
        FROM {customer}""",
}

GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def _text(name: str) -> str:
    """The derived table's SQL; what stands behind an ``@`` in the name is put in as ``{key}``."""
    name, _, key = name.partition("@")
    return DERIVED[name].replace("{key}", key)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given or a derived table."""
    if name in GIVEN:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    text = _text(name)
    used = {g: table(spark, folder, g) for g in GIVEN if "{" + g + "}" in text}
    return spark.sql(text, **used)


def sql(name: str) -> str:
    """The derived table as a SQL subquery over the given tables."""
    return name if name in GIVEN else "(" + _text(name).format(**{g: g for g in GIVEN}) + ")"
