"""SQL text for the oracle, built from plain column lists."""

from __future__ import annotations

from tallymark.queries.fixtures import sql

# Columns of the tables the checks run over: name to kind (n whole, f floating, d decimal, t time, s text).
COLUMNS = {
    "orders": dict(
        o_orderkey="n", o_custkey="n", o_orderstatus="s", o_totalprice="f", o_orderdate="t", o_orderpriority="s"
    ),
    "customer": dict(c_custkey="n", c_name="s", c_nationkey="n", c_acctbal="f", c_mktsegment="s"),
    "part": dict(p_partkey="n", p_name="s", p_brand="s", p_type="s", p_size="n", p_retailprice="f"),
    "lineitem": dict(
        l_orderkey="n", l_partkey="n", l_suppkey="n", l_linenumber="n", l_quantity="f", l_extendedprice="f",
        l_discount="f", l_tax="f", l_returnflag="s", l_linestatus="s", l_shipdate="t",
    ),
    "events": dict(event_id="n", ts="t", user_id="n", event_type="s", value="f", props="s"),
}


def metric_list(columns: dict[str, str], rlength: bool = True) -> list[tuple[str, str, str, str]]:
    """``(check, column, metric, expression)``."""
    out = [("Count", "*", "Total_count", "count(*)")]
    for c, kind in columns.items():
        out.append(("Null", c, f"Number_of_Null_Values_{c}", f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"))
        if kind == "n":
            out.append(("Sum", c, f"sum_{c}", f"sum(CAST({c} AS BIGINT))"))
        elif kind == "f":
            out.append(("Sum", c, f"sum_{c}", f"sum(CAST(trunc({c}) AS BIGINT))"))
        elif kind == "d":
            out.append(("Sum", c, f"sum_{c}", f"sum(CAST({c} AS DECIMAL(38, 12)))"))
        elif kind == "t":
            out += [("Max", c, f"MAX_{c}", f"max({c})"), ("Max", c, f"MIN_{c}", f"min({c})")]
        else:
            for check in ("Length", "RLength") if rlength else ("Length",):
                out += [
                    (check, c, f"max_len_{c}", f"max(length({c}))"),
                    (check, c, f"min_len_{c}", f"min(length({c}))"),
                ]
    return out


def profile_sql(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{check}' AS "check", '{column}' AS "column", '{metric}' AS metric,
            CAST({value} AS VARCHAR) AS value, true AS ok FROM {sql(table)} AS p"""
        for check, column, metric, value in metric_list(columns)
    )


def wide_sql(table: str, columns: dict[str, str], check: str, cast: str = "BIGINT") -> str:
    parts = [f"CAST({v} AS {cast}) AS {m}" for k, _, m, v in metric_list(columns) if k == check]
    return f"SELECT {', '.join(parts)} FROM {sql(table)} AS w"


def compare_sql(
    source: str,
    target: str,
    columns: dict[str, str],
    source_where: str = "true",
    target_where: str = "true",
    padded: tuple[str, ...] = (),
) -> str:
    """Every metric of both sides with its status and remark; RLength trims the ``padded`` columns of the source."""

    def at_source(check: str, column: str, value: str) -> str:
        return value.replace(column, f"rtrim({column})") if check == "RLength" and column in padded else value

    parts = [
        f"""SELECT '{check}' AS "check", '{column}' AS "column", '{metric}' AS metric,
            (SELECT CAST({at_source(check, column, value)} AS VARCHAR) FROM {sql(source)} AS s WHERE {source_where}) AS source_value,
            (SELECT CAST({value} AS VARCHAR) FROM {sql(target)} AS t WHERE {target_where}) AS target_value"""
        for check, column, metric, value in metric_list(columns)
    ]
    return f"""
        SELECT *, CASE WHEN source_value IS NOT DISTINCT FROM target_value THEN 'Match' ELSE 'Not match' END AS status,
               CASE WHEN source_value IS DISTINCT FROM target_value THEN lower(metric) END AS remark
        FROM ({" UNION ALL ".join(parts)}) AS m"""


def summary_sql(compared: str) -> str:
    return f"""
        SELECT "check" AS TestCases, CASE WHEN bool_and(status = 'Match') THEN 'Match' ELSE 'Not match' END AS Status,
               coalesce(string_agg(remark, ', ' ORDER BY remark), '-') AS Remarks
        FROM ({compared}) AS c GROUP BY "check" """


def verdict_sql(summary: str) -> str:
    return f"""
        SELECT CASE WHEN bool_and(Status = 'Match') THEN 'Pass' ELSE 'Fail' END AS Status,
               CASE WHEN bool_and(Status = 'Match') THEN '..' ELSE
                    string_agg(CASE WHEN Status <> 'Match' THEN concat(TestCases, ': ', Status, ' ', Remarks) END, '; '
                               ORDER BY TestCases) END AS Remarks
        FROM ({summary}) AS v"""


def paired_sql(source: str, target: str, columns: list[str], prefix: str = "") -> str:
    """CTEs: ``counts`` of copies per distinct row and side, ``surplus`` after identical rows cancel."""
    cols = ", ".join(columns)
    return f"""
        WITH {prefix} counts AS (
            SELECT {cols}, sum(s) AS ns, sum(t) AS nt
            FROM (SELECT {cols}, 1 AS s, 0 AS t FROM {sql(source)} AS a
                  UNION ALL SELECT {cols}, 0, 1 FROM {sql(target)} AS b) AS u
            GROUP BY {cols}),
        surplus AS (SELECT *, greatest(ns - nt, 0) AS xs, greatest(nt - ns, 0) AS xt FROM counts WHERE ns <> nt)"""


def numbered_sql(source: str, target: str, keys: list[str], columns: list[str]) -> str:
    """CTEs ``s`` and ``t``: the surplus rows one by one, numbered within their key."""
    rest = [c for c in columns if c not in keys]
    order = ", ".join(f"{c} NULLS LAST" for c in rest)
    k, cols = ", ".join(keys), ", ".join(columns)

    def side(name: str, n: str) -> str:
        return f"""{name} AS (SELECT {cols}, row_number() OVER (PARTITION BY {k} ORDER BY {order}) - 1 AS occurrence
            FROM (SELECT {cols}, unnest(range(CAST({n} AS BIGINT))) AS copy FROM surplus WHERE {n} > 0) AS x)"""

    return f"{paired_sql(source, target, columns)}, {side('s', 'xs')}, {side('t', 'xt')}"


def keyed_pairs(keys: list[str]) -> str:
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys + ["occurrence"])
    return f"FROM s FULL OUTER JOIN t ON {on}"


def cells_sql(pairs: str, by: list[str], columns: list[str], where: str = "true") -> str:
    """Differing cells of row pairs ``s`` and ``t``."""
    lead = ", ".join(f"s.{k} AS {k}" for k in by)
    return " UNION ALL ".join(
        f"""SELECT {lead}, '{c}' AS "column", coalesce(CAST(s.{c} AS VARCHAR), 'null') AS source_value,
            coalesce(CAST(t.{c} AS VARCHAR), 'null') AS target_value,
            concat(coalesce(CAST(s.{c} AS VARCHAR), 'null'), ' vs ', coalesce(CAST(t.{c} AS VARCHAR), 'null')) AS diff
            {pairs} WHERE s.{c} IS DISTINCT FROM t.{c} AND {where}"""
        for c in columns
    )


def sorted_sql(name: str, columns: list[str]) -> str:
    order = ", ".join(f"{c} NULLS LAST" for c in columns)
    return f"(SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS row_index FROM {sql(name)} AS z)"


def positional_sql(source: str, target: str, columns: list[str]) -> str:
    pairs = (
        f"FROM {sorted_sql(source, columns)} AS s JOIN {sorted_sql(target, columns)} AS t ON s.row_index = t.row_index"
    )
    return cells_sql(pairs, ["row_index"], columns)


def hash_profile_sql(table: str, columns: dict[str, str]) -> str:
    """Averages of numbers as they are and of the first 32 bits of md5 for everything else."""
    parts = []
    for c, kind in columns.items():
        if kind == "n":
            mean = f"CAST(sum(CAST({c} AS BIGINT)) AS DOUBLE) / count({c})"
        elif kind == "f":
            mean = f"CAST(sum(CAST({c} AS DECIMAL(18, 2))) AS DECIMAL(18, 2))::DOUBLE / count({c})"
        else:
            bits = f"CAST(concat('0x', substr(md5(CAST({c} AS VARCHAR)), 1, 8)) AS BIGINT)"
            mean = f"CAST(sum({bits}) AS DOUBLE) / count({c})"
        parts.append(
            f"SELECT 'avg{c}' AS metric, count({c}) AS n_values, {mean} AS value FROM {sql(table)} AS h"
        )
    return " UNION ALL ".join(parts)


def metadata_sql(label: str, table: str, types: dict[str, tuple[str, str | None]]) -> str:
    """Column metadata with what one pass over the data shows; ``types``: column to (type, declared length)."""
    parts = []
    for i, (c, (kind, length)) in enumerate(types.items()):
        longest = f"max(length({c}))" if kind in ("STRING", "VARCHAR", "CHAR") else "CAST(NULL AS BIGINT)"
        shown = f"'{length}'" if length else f"CAST({longest} AS VARCHAR)"
        parts.append(
            f"""SELECT '{label}' AS "table", {i} AS ordinal, '{c}' AS "column", '{kind}' AS data_type,
            {shown} AS length, true AS nullable, count({c}) AS n_values, count(*) - count({c}) AS n_null,
            {longest} AS max_length FROM {sql(table)} AS m"""
        )
    return " UNION ALL ".join(parts)


def murmur_sql(text: str) -> str:
    """Murmur3 (32 bits, seed 42) of ASCII text as a signed number; null gives the seed. Whole words of four bytes are
    mixed in first, then the bytes left over one by one, then the length."""
    wrap, let = "4294967296", "list_transform([{0}], lambda {1}: {2})[1]"

    def turned(x: str, bits: int) -> str:
        return f"(({x} * {1 << bits}::UBIGINT) % {wrap} + {x} // {1 << (32 - bits)}::UBIGINT)"

    def times(x: str, factor: int) -> str:
        return f"(({x} * {factor}::UBIGINT) % {wrap})"

    key = let.format(times("k", 0xCC9E2D51), "a", times(turned("a", 15), 0x1B873593))
    mixed = let.format(f"xor(h, {key})", "b", f"(({turned('b', 13)} * 5 + {0xE6546B64}::UBIGINT) % {wrap})")
    code = f"ord({text}[4 * i + {{0}}])::UBIGINT"
    whole = " + ".join(f"{code.format(j + 1)} * {256**j}::UBIGINT" for j in range(4))
    left = f"ord({text}[length({text}) // 4 * 4 + i + 1])::UBIGINT"
    words = f"list_concat([42::UBIGINT], list_transform(range(length({text}) // 4), lambda i: {whole}), list_transform(range(length({text}) % 4), lambda i: {left}))"
    value = f"xor(list_reduce({words}, lambda h, k: {mixed}), length({text})::UBIGINT)"
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        value = let.format(value, "c", let.format(f"xor(c, c // {1 << shift}::UBIGINT)", "e", times("e", factor)))
    return f"CASE WHEN {text} IS NULL THEN 42 ELSE {let.format(value, 'f', 'CASE WHEN f >= 2147483648 THEN f::BIGINT - 4294967296 ELSE f::BIGINT END')} END"
