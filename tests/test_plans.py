"""Properties of the physical plans that decide how the operators behave on large data."""

import re

import pytest

from tallymark.operators.align import align
from tallymark.operators.checks import check_compare
from tallymark.operators.multiset import bag_diff, paired_counts, table_equality
from tallymark.operators.rows import keyed_diff, positional_diff, row_status_counts
from tallymark.queries import QUERIES
from tallymark.queries.fixtures import table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return table(spark, FOLDER, "orders")


@pytest.fixture(scope="module")
def changed(orders):
    return orders.selectExpr("o_orderkey", "o_custkey", "'X' as o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")  # noqa: E501


def test_checks_scan_each_side_once(orders, changed):
    text = plan(check_compare(orders, changed))
    assert text.count("FileScan") == 2
    assert "Join" not in text and "CartesianProduct" not in text


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    text = plan(QUERIES["source_scan"](spark, FOLDER))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PushedFilters: \[.*EqualTo\(event_type,purchase\), GreaterThan\(value,50.0\)", text)
    assert "props" not in text.split("ReadSchema")[1]


def test_pairing_is_one_shuffle_without_a_join(orders, changed):
    for df in (paired_counts(align(orders, changed)), bag_diff(orders, changed)):
        text = plan(df)
        assert text.count("Exchange hashpartitioning") == 1
        assert "Join" not in text and "SinglePartition" not in text


def test_totals_reach_one_task_only_when_aggregated(orders, changed):
    for df in (table_equality(orders, changed), row_status_counts(orders, changed, ["o_orderkey"])):
        text = plan(df)
        for before in re.findall(r"Exchange SinglePartition.*\n(.*)", text):
            assert "HashAggregate" in before and "partial_" in before


def test_aligned_rows_never_meet_in_one_task(orders, changed):
    for diff in (keyed_diff(orders, changed, ["o_orderkey"]), positional_diff(orders, changed)):
        text = plan(diff.cells())
        assert "NestedLoop" not in text and "CartesianProduct" not in text
        # Only the totals per range partition may be summed up in one place.
        for before in re.findall(r"Exchange SinglePartition.*\n(.*)", text):
            assert "HashAggregate" in before


def test_bucketed_tables_join_without_a_shuffle(spark, orders, changed, tmp_path):
    names = []
    for name, df in (("bucketed_source", orders), ("bucketed_target", changed)):
        writer = df.write.bucketBy(8, "o_orderkey").sortBy("o_orderkey").mode("overwrite")
        writer.option("path", f"{tmp_path}/{name}").saveAsTable(name)
        names.append(name)
    try:
        # Small tables would be broadcast, which hides the question.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        diff = keyed_diff(*[spark.table(n) for n in names], ["o_orderkey"], unique=True)
        assert "SortMergeJoin" in plan(diff.cells()) and "Exchange" not in plan(diff.cells())
        assert diff.rows.count() == keyed_diff(orders, changed, ["o_orderkey"]).rows.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"drop table {name}")
