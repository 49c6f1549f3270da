"""Run a manifest: every pair of tables through its checks, up to one verdict per pair."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.types import canonical, lower_names
from tallymark.operators.checks import (
    FAILED_WITH_ERROR,
    MATCH,
    NOT_MATCH,
    check_compare,
    check_summary,
    all_checks,
    compare_profiles,
    table_verdict,
    target_profile,
    with_retyped,
)
from tallymark.operators.profile import check_queries, remote_profile, remote_profile_query
from tallymark.operators.align import align
from tallymark.operators.rows import UNALIGNED, row_status_counts
from tallymark.operators.schema_diff import metadata_diff
from tallymark.operators.sinks import write_result
from tallymark.sources.catalog import column_rows
from tallymark.sources.manifest import FIELDS
from tallymark.sources.readers import condition_text, filtered, read_jdbc, read_location

DETAIL = (
    "job_row int, table string, check string, column string, metric string, source_value string, "
    "target_value string, status string, remark string"
)
METADATA = (
    "job_row int, table string, side string, ordinal int, column string, data_type string, length string, "
    "nullable boolean"
)
SQL_TEXTS = "job_row int, table string, side string, check string, query string"
ERRORS = "job_row int, error string"

Reader = Callable[[SparkSession, Row, str], DataFrame]


@dataclass
class JobResult:
    """``report``: manifest plus Status and Remarks. ``summary``: one row per pair and check. ``detail``: one
    row per metric. ``drift``: schema differences. ``metadata``: the columns of both sides. ``queries``: the
    checks as plain SQL texts."""

    report: DataFrame
    summary: DataFrame
    detail: DataFrame
    drift: DataFrame
    metadata: DataFrame
    queries: DataFrame

    run_id: str

    def write(self, folder: str, fmt: str = "parquet") -> None:
        """Append all reports below ``folder``, each row with its ``run_id``."""
        parts = {"report": [], "detail": ["table", "check"]}
        for name in ("report", "summary", "detail", "drift", "metadata", "queries"):
            df = getattr(self, name).withColumn("run_id", F.lit(self.run_id))
            write_result(df, f"{folder}/{name}", fmt, ["run_id", *parts.get(name, ["table"])], "append")


def default_reader(jdbc: dict[str, dict] | None = None) -> Reader:
    """Read a side by its query where one is set, else by its name.

    ``jdbc`` maps connection names to JDBC options; a source of such a connection is read there, split as the manifest
    says for its table.
    """

    def read(spark: SparkSession, row: Row, side: str) -> DataFrame:
        query, name = row[f"{side}_query"], row[side]
        options = (jdbc or {}).get(row["connection"]) if side == "source" else None
        if options:
            df = read_jdbc(spark, **_split(options, row), **({"query": query} if query else {"table": name}))
        else:
            df = spark.sql(query) if query else read_location(spark, name)
        return filtered(df, row[f"{side}_condition"])

    return read


def _split(options: dict, row: Row) -> dict:
    """The options of a connection with the split of the pair's own table, if it has one."""
    if not row["split_column"]:
        return options
    own = {"partition_column": row["split_column"]}
    return options | own | ({"partitions": int(row["splits"])} if row["splits"] else {})


def pushed_check_compare(
    spark: SparkSession, options: dict, row: Row, source: DataFrame, target: DataFrame
) -> DataFrame:
    """``check_compare`` with the source's metrics computed by the JDBC source, which returns one row."""
    source, target = lower_names(source), canonical(target)
    taken = all_checks(source.schema, target.schema)
    query = remote_profile_query(source.schema, _place(row, "source"), condition_text(row["source_condition"]), _quote(options))
    pushed = {k: v for k, v in options.items() if k not in ("partition_column", "partitions")}
    left = remote_profile(read_jdbc(spark, query=query, **pushed), source.schema)
    compared = compare_profiles(left.where(F.col("check").isin(taken)), target_profile(target, taken))
    return with_retyped(compared, source.schema, target.schema)


def run(
    spark: SparkSession,
    manifest: DataFrame,
    read: Reader | None = None,
    jdbc: dict[str, dict] | None = None,
    workers: int = 4,
    folder: str | None = None,
    run_id: str | None = None,
) -> JobResult:
    """Check every pair of ``manifest``; with ``folder``, also append all reports there, under ``run_id`` (by
    default the time of the start).

    ``read`` may replace the way a side is read. Otherwise sources of a connection in ``jdbc`` compute their own
    metrics, so that no rows leave them for the checks.

    A manifest lists tables, and a pair returns a few rows per column, so both fit the driver. Pairs run side
    by side as Spark jobs of their own: one that fails is reported as ``Failed with Error``, the others go on.
    """
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S.%fZ")
    connections = {} if read else jdbc or {}
    read = read or default_reader(jdbc)
    pairs = manifest.select(*FIELDS).collect()

    def check_pair(number: int) -> dict[str, list[tuple]]:
        row = pairs[number]
        lead = (number, row["table"])
        try:
            source, target = read(spark, row, "source"), read(spark, row, "target")
            if row["connection"] in connections:
                compared = pushed_check_compare(spark, connections[row["connection"]], row, source, target)
            else:
                compared = check_compare(source, target)
            detail = [(*lead, *r) for r in compared.collect()]
            if row["keys"]:
                detail.append((*lead, *_data_check(source, target, row["keys"].split("|"))))
            sides = {"source": source, "target": target}
            return {
                "detail": detail,
                "metadata": [(*lead, k, *r) for k, df in sides.items() for r in column_rows(df.schema)],
                "queries": [
                    (*lead, k, check, text)
                    for k, df in sides.items()
                    for check, text in check_queries(
                        df.schema, _place(row, k), row[f"{k}_condition"] or "", _quote(connections.get(row["connection"], {}) if k == "source" else {})
                    ).items()
                ],
            }
        except Exception as error:  # whatever ends one pair must not end the job
            said = str(error).strip().splitlines() or ["no message"]
            return {"errors": [(number, f"{type(error).__name__}: {said[0]}")]}

    with ThreadPoolExecutor(max_workers=workers) as pool:
        results = list(pool.map(check_pair, range(len(pairs))))

    def gathered(name: str, schema: str) -> DataFrame:
        return spark.createDataFrame([x for r in results for x in r.get(name, [])], schema)

    detail, errors = gathered("detail", DETAIL), gathered("errors", ERRORS)
    numbered = spark.createDataFrame(
        [(i, *[r[f] for f in FIELDS]) for i, r in enumerate(pairs)],
        "job_row int, " + ", ".join(f"{f} string" for f in FIELDS),
    )
    summary = check_summary(detail, "job_row", "table")
    verdict = table_verdict(summary, "job_row")
    report = (
        numbered.join(verdict, "job_row", "left")
        .join(errors, "job_row", "left")
        .select(
            "job_row",
            *FIELDS,
            F.coalesce("Status", F.lit(FAILED_WITH_ERROR)).alias("Status"),
            F.coalesce("Remarks", "error", F.lit("no check applies")).alias("Remarks"),
        )
    )
    metadata = gathered("metadata", METADATA)
    drift = metadata_diff(metadata.where("side = 'source'"), metadata.where("side = 'target'"), ("job_row", "table"))
    result = JobResult(report, summary, detail, drift, metadata, gathered("queries", SQL_TEXTS), run_id)
    if folder:
        result.write(folder)
    return result


def _quote(options: dict) -> str:
    """The character that a connection's source takes around names."""
    return options.get("quote", '"')


def _place(row: Row, side: str) -> str:
    """What a side's SQL selects from."""
    return f"({row[f'{side}_query']}) a" if row[f"{side}_query"] else row[side]


def _data_check(source: DataFrame, target: DataFrame, keys: list[str]) -> tuple:
    """The ``Data`` check of a pair with keys, as one metric row."""
    counts = {r["status"]: r["n_rows"] for r in row_status_counts(source, target, keys).collect()}
    counts.pop(UNALIGNED, None)
    matched = counts.pop("match")
    bad = [f"{v} {k}" for k, v in counts.items() if v] + align(source, target).remarks
    remark = ", ".join(bad) or None
    status = NOT_MATCH if bad else MATCH
    total_s = matched + counts["mismatch"] + counts["source_only"]
    total_t = matched + counts["mismatch"] + counts["target_only"]
    return "Data", "*", "rows", str(total_s), str(total_t), status, remark
