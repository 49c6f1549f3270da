"""Compare the profiles of two sides and roll them up: metric, check, table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.types import common_type
from tallymark.operators.align import with_common_types
from tallymark.operators.profile import metrics, profile

# Statuses of checks and tables.
MATCH = "Match"
NOT_MATCH = "Not match"
FAILED = "Failed"
PASS = "Pass"
FAIL = "Fail"
FAILED_WITH_ERROR = "Failed with Error"
COUNT_MATCH = "Count Match"
COUNT_MISMATCH = "Count Mismatch"
DATA_MATCH = "Data Match"
DATA_MISMATCH = "Data Mismatch"


def compare_profiles(source: DataFrame, target: DataFrame) -> DataFrame:
    """Two long profiles side by side: ``(check, column, metric, source_value, target_value, status, remark)``.

    The profiles hold a few rows per column, so one small shuffle pairs them. Sums and dates are equal where
    they are the same number or time, whatever type each side has.
    """
    same = """(source_value <=> target_value
        OR check = 'Sum' AND try_cast(source_value AS decimal(38,12)) = try_cast(target_value AS decimal(38,12))
        OR check = 'Max' AND try_cast(source_value AS timestamp_ntz) = try_cast(target_value AS timestamp_ntz))"""
    tagged = source.withColumn("from_source", F.lit(True)).unionByName(target.withColumn("from_source", F.lit(False)))
    paired = tagged.groupBy("check", "column", "metric").agg(
        F.expr("max(value) filter (where from_source) as source_value"),
        F.expr("max(value) filter (where not from_source) as target_value"),
        F.expr("max(from_source) as has_source"),
        F.expr("max(not from_source) as has_target"),
        F.expr("min(ok) as ok"),
    )
    paired = paired.selectExpr("*", f"coalesce({same}, false) as same")
    return paired.selectExpr(
        "check",
        "column",
        "metric",
        "source_value",
        "target_value",
        f"""CASE WHEN NOT ok THEN '{FAILED}'
                 WHEN has_source AND has_target AND same THEN '{MATCH}'
                 ELSE '{NOT_MATCH}' END AS status""",
        """CASE WHEN NOT has_target THEN concat('Column ', lower(metric), ' not in Target')
                WHEN NOT has_source THEN concat('Column ', lower(metric), ' not in Source')
                WHEN NOT ok OR NOT same THEN lower(metric) END AS remark""",
    )


def check_compare(source: DataFrame, target: DataFrame, columns_per_pass: int | None = None) -> DataFrame:
    """Every metric of every check either side takes, from one scan per side.

    Shared columns are first cast to a common type, so ``1`` and ``1.0`` agree. The source's right-trimmed
    lengths are compared with the target's plain lengths. A metric of one side only does not match, and neither does
    a shared column without a common type.
    """
    source, target = with_common_types(source, target)
    taken = all_checks(source.schema, target.schema)
    compared = compare_profiles(
        profile(source, taken, columns_per_pass), target_profile(target, taken, columns_per_pass)
    )
    return with_retyped(compared, source.schema, target.schema)


def all_checks(source: T.StructType, target: T.StructType) -> list[str]:
    """The checks that apply on a side."""
    return sorted({m.check for m in metrics(source)} | {m.check for m in metrics(target)})


def with_retyped(compared: DataFrame, source: T.StructType, target: T.StructType) -> DataFrame:
    """Add a row to the check ``Null``, which every column takes, for each shared column without a common type."""
    left, right = ({f.name.lower(): f.dataType for f in side.fields} for side in (source, target))
    rows = [
        ("Null", c, f"type_{c}", left[c].simpleString(), right[c].simpleString(), NOT_MATCH, f"Column {c} of another type")
        for c in left
        if c in right and common_type(left[c], right[c]) is None
    ]
    return compared.unionByName(compared.sparkSession.createDataFrame(rows, compared.schema)) if rows else compared


def target_profile(target: DataFrame, checks: list[str], columns_per_pass: int | None = None) -> DataFrame:
    """The target's profile, its plain lengths also standing for the right-trimmed ones."""
    plain = profile(target, [c for c in checks if c != "RLength"], columns_per_pass)
    if "RLength" not in checks:
        return plain
    both = "explode(if(check = 'Length', array('Length', 'RLength'), array(check)))"
    return plain.withColumn("check", F.expr(both))


def check_summary(compared: DataFrame, *table: str) -> DataFrame:
    """One row per check: ``(TestCases, Status, Remarks)``; the remark lists what differs, or ``-``."""
    return compared.groupBy(*table, F.col("check").alias("TestCases")).agg(
        F.expr(f"""CASE WHEN bool_or(status = '{FAILED}') THEN '{FAILED}'
                        WHEN bool_and(status = '{MATCH}') THEN '{MATCH}' ELSE '{NOT_MATCH}' END AS Status"""),
        F.expr(f"""CASE WHEN bool_and(status = '{MATCH}') THEN '-'
                        ELSE array_join(sort_array(collect_list(remark)), ', ') END AS Remarks"""),
    )


def table_verdict(summary: DataFrame, *table: str) -> DataFrame:
    """``Pass`` where every check matches, else ``Fail`` with the checks that do not; no check is ``Failed``."""
    failing = f"collect_list(concat(TestCases, ': ', Status, ' ', Remarks)) FILTER (WHERE Status <> '{MATCH}')"
    return summary.groupBy(*table).agg(
        F.expr(f"""CASE bool_and(Status = '{MATCH}') WHEN true THEN '{PASS}' WHEN false THEN '{FAIL}'
                        ELSE '{FAILED}' END AS Status"""),
        F.expr(f"""CASE WHEN bool_and(Status = '{MATCH}') THEN '..'
                        ELSE array_join(sort_array({failing}), '; ') END AS Remarks"""),
    )


def row_count_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """``(count_source, count_target, status, remarks)`` in one row."""
    counts = source.selectExpr("1 as s", "0 as t").unionAll(target.selectExpr("0 as s", "1 as t"))
    return counts.selectExpr(
        "coalesce(sum(s), 0) as count_source", "coalesce(sum(t), 0) as count_target"
    ).selectExpr(
        "count_source",
        "count_target",
        f"if(count_source = count_target, '{COUNT_MATCH}', '{COUNT_MISMATCH}') as status",
        "concat(count_source, ' vs ', count_target) as remarks",
    )
