"""Read either side of a comparison: files, tables, SQL text, or a JDBC source."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.sqltext import sql_name
from tallymark.sources.catalog import decode_catalog

FILE_FORMATS = ("parquet", "orc", "csv", "json")


def read_files(spark: SparkSession, path: str, fmt: str | None = None, schema=None, **options) -> DataFrame:
    """Files of one format, told from the ending where ``fmt`` is not given; Parquet otherwise.

    CSV and JSON want a ``schema``: without one CSV columns stay text, so that no value changes by guessing.
    """
    ending = os.path.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    fmt = fmt or (ending if ending in FILE_FORMATS else "parquet")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options = {"header": True, **options}
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def read_location(spark: SparkSession, location: str) -> DataFrame:
    """A path where the name holds a slash, else a table of the catalog."""
    return read_files(spark, location) if "/" in location else spark.table(location)


def read_query(spark: SparkSession, query: str, **views: DataFrame) -> DataFrame:
    """The result of SQL text; ``views`` can be named in it as ``{name}``."""
    return spark.sql(query, **views)


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    **options,
) -> dict[str, str]:
    """Options of one JDBC scan.

    A plain query is handed to the source whole. With ``partition`` = (column, lower, upper, partitions) the
    scan is split into that many range reads, which JDBC allows on a table expression only.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    out = {"url": url, **{k: str(v) for k, v in options.items()}}
    if partition is None:
        out["dbtable" if table else "query"] = table or query
        return out
    column, lower, upper, count = partition
    out["dbtable"] = table or f"({query}) a"
    return out | {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(count),
    }


def read_jdbc(spark: SparkSession, url: str, partition_column=None, partitions: int = 16, quote: str = '"', **request) -> DataFrame:
    """A JDBC table or query. ``partition_column`` splits the read into parts of about equal numbers of rows, whatever the
    values are: the source is asked for the column's quantiles first. Rows without a value are a part of their own.
    ``quote`` is the character the source takes around names."""

    def scan(**more) -> DataFrame:
        return spark.read.format("jdbc").options(**jdbc_options(url, **{**request, **more})).load()

    if partition_column is None:
        return scan()
    name, whole = sql_name(partition_column, quote), scan()
    place = request.get("table") or f"({request['query']}) a"
    bounds = scan(table=None, query=bounds_query(name, partitions, place)).first()
    kind = next(f.dataType for f in whole.schema.fields if f.name.lower() == partition_column.lower())
    own = {k: str(v) for k, v in request.items() if k not in ("table", "query")}
    return spark.read.jdbc(url, place, predicates=split_predicates(name, list(bounds), kind), properties=own)


def bounds_query(column: str, partitions: int, place: str, spread: bool = False) -> str:
    """SQL for one row of the values that part ``place`` into equal numbers of rows by ``column``.

    With ``spread`` the text is that of ``spread_bounds_query``.
    """
    if spread and partitions > 1:
        return spread_bounds_query(column, partitions, place)
    shares = [f"percentile_disc({i / partitions!r}) within group (order by {column}) as b{i}" for i in range(1, partitions)]
    return f"select {', '.join(shares) or 'null as b1'} from {place}"


#: Bins into which `spread_bounds_query` deals the values, and what a bin holds again, how often.
BINS, LEVELS = 1024, 2


def spread_bounds_query(column: str, partitions: int, place: str) -> str:
    """The row of ``bounds_query`` for whole numbers and decimals, where Spark itself answers.

    Its ``percentile_disc`` gathers all values in one task. Here values are counted, then the bins of equal width that
    their range falls into, and only the bins that hold a bound are looked into, by bins of their own, and at last by value.
    Rounding keeps the order of values, so their order among bins is exact however they lie.
    """
    if partitions < 2:
        return bounds_query(column, partitions, place)
    wanted = " union all ".join(f"select {i} as i" for i in range(1, partitions))
    steps = [
        f"v as (select {column} as k, count(*) as n from {place} where {column} is not null group by {column})",
        "t as (select sum(n) as total from v)",
        f"q as (select i * total as r from ({wanted}) i cross join t)",
        "r0 as (select k, n, cast(0 as bigint) as g, cast(0 as bigint) as below from v)",
    ]
    for j in range(LEVELS):
        bin_ = f"case when e.wide = 0 then 0 else floor((r.k * 1e0 - e.low) / e.wide * {BINS - 1}) end"
        steps += [
            f"e{j} as (select g, min(k) * 1e0 as low, max(k) * 1e0 - min(k) * 1e0 as wide from r{j} group by g)",
            f"x{j} as (select r.k, r.n, r.g * {BINS} + cast({bin_} as bigint) as g, r.below from r{j} r join e{j} e on r.g = e.g)",
            f"h{j} as (select g, below, sum(n) as n from x{j} group by g, below)",
            f"c{j} as (select g, n, below + sum(n) over (partition by below order by g) - n as below from h{j})",
            f"""w{j} as (select distinct c.g, c.below from c{j} c join q
                on c.below * {partitions} < q.r and q.r <= (c.below + c.n) * {partitions})""",
            f"r{j + 1} as (select x.k, x.n, x.g, w.below from x{j} x join w{j} w on x.g = w.g)",
        ]
    steps.append(f"u as (select k, below + sum(n) over (partition by g order by k) as upto from r{LEVELS})")
    bounds = [f"min(case when u.upto * {partitions} >= {i} * t.total then u.k end) as b{i}" for i in range(1, partitions)]
    return f"with {', '.join(steps)} select {', '.join(bounds)} from t left join u on true"


def split_predicates(column: str, bounds: list, kind: T.DataType) -> list[str]:
    """One condition per part: up to each bound, past the last, and without a value. Every row meets exactly one.

    A value that many parts begin or end with bounds a part once, so a value that fills several parts is one part.
    """
    cuts = list(dict.fromkeys(b for b in bounds if b is not None))
    if not cuts:
        return ["1 = 1"]
    texts = [_constant(c, kind) for c in cuts]
    between = [f"{column} > {a} and {column} <= {b}" for a, b in zip(texts, texts[1:])]
    return [f"{column} <= {texts[0]}", *between, f"{column} > {texts[-1]}", f"{column} is null"]


def _constant(value: object, kind: T.DataType) -> str:
    """A value as a constant of plain SQL."""
    if isinstance(kind, T.DateType):
        return f"date '{value}'"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"timestamp '{value}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def columns_query(table: str, view: str) -> str:
    """The catalog rows of ``database.table``, filtered at the source."""
    database, _, name = (part.replace("'", "''") for part in table.partition("."))
    return f"select * from {view} where databasename = '{database}' and tablename = '{name}'"


def read_jdbc_columns(spark: SparkSession, url: str, table: str, view: str = "dbc.columns", **options) -> DataFrame:
    """Decoded column metadata of ``database.table`` from a catalog view."""
    return decode_catalog(read_jdbc(spark, url, query=columns_query(table, view), **options))


def condition_text(text: str | None) -> str:
    """A row condition without a leading ``where``; empty where none is given."""
    text = (text or "").strip()
    if text.lower() == "nan":
        return ""
    return re.sub(r"^where\s+", "", text, flags=re.IGNORECASE)


def condition(text: str | None) -> Column:
    """A row condition from text; always true where none is given."""
    return F.expr(condition_text(text) or "true")


def filtered(df: DataFrame, text: str | None) -> DataFrame:
    return df.where(condition(text))


def canonical_text(df: DataFrame) -> DataFrame:
    """Timestamps and decimals as text, for display."""
    shown = (T.TimestampType, T.TimestampNTZType, T.DecimalType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, shown) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
