import pytest

from tallymark.operators.sinks import preview, write_result
from tallymark.plans.job import default_reader, run
from tallymark.sources.manifest import normalise_manifest
from tallymark.sources.readers import read_files


@pytest.fixture
def manifest(spark, tmp_path):
    df = spark.sql("select id, id % 3 as v, concat('s', id) as s from range(30)")
    df.write.parquet(f"{tmp_path}/a")
    df.selectExpr("id", "if(id = 4, 7, v) as v", "s").write.parquet(f"{tmp_path}/b")
    rows = [
        ("same", f"{tmp_path}/a", f"{tmp_path}/a", None, None, None, None, "id"),
        ("changed", f"{tmp_path}/a", f"{tmp_path}/b", None, None, None, None, "id"),
        ("filtered", f"{tmp_path}/a", f"{tmp_path}/b", None, None, "where id <> 4", "id <> 4", None),
        ("gone", f"{tmp_path}/a", f"{tmp_path}/none", None, None, None, None, None),
        ("breaks", f"{tmp_path}/a", "x", None, "select assert_true(id > 5) as id, v, s from parquet.`%s/a`" % tmp_path, None, None, None),  # noqa: E501
        ("queries", "x", "y", f"select v from parquet.`{tmp_path}/a`", f"select v from parquet.`{tmp_path}/a`", None, None, None),  # noqa: E501
    ]
    return normalise_manifest(
        spark.createDataFrame(
            rows,
            "table string, source string, target string, source_query string, target_query string, "
            "source_condition string, target_condition string, keys string",
        )
    )


def test_job(spark, manifest, tmp_path):
    result = run(spark, manifest, folder=f"{tmp_path}/out")
    status = {r["table"]: r["Status"] for r in result.report.collect()}
    assert status == {
        "same": "Pass",
        "changed": "Fail",
        "filtered": "Pass",
        "gone": "Failed with Error",
        "breaks": "Failed with Error",
        "queries": "Pass",
    }
    remarks = {r["table"]: r["Remarks"] for r in result.report.collect()}
    assert remarks["same"] == ".."
    assert remarks["changed"] == "Data: Not match 1 mismatch; Sum: Not match sum_v"
    assert "none" in remarks["gone"]
    assert result.drift.count() == 0
    checks = {(r["table"], r["TestCases"]): r["Status"] for r in result.summary.collect()}
    assert checks[("changed", "Null")] == "Match" and checks[("changed", "Data")] == "Not match"
    assert read_files(spark, f"{tmp_path}/out/report").count() == 6
    assert read_files(spark, f"{tmp_path}/out/metadata").where("side = 'target' and `table` = 'same'").count() == 3
    texts = {(r["side"], r["check"]): r["query"] for r in result.queries.where("`table` = 'filtered'").collect()}
    assert texts[("source", "Count")].endswith("/a where id <> 4") and ("target", "RLength") in texts
    detail = read_files(spark, f"{tmp_path}/out/detail").where("`table` = 'changed' and status = 'Not match'")
    assert {r["metric"] for r in detail.collect()} == {"sum_v", "rows"}


def test_job_without_pairs(spark, manifest):
    assert run(spark, manifest.where("false")).report.count() == 0


def test_reader_picks_the_connection(spark, manifest, monkeypatch):
    seen = {}
    monkeypatch.setattr(
        "tallymark.plans.job.read_jdbc", lambda session, **request: seen.update(request) or session.range(4)
    )
    row = manifest.selectExpr("'dev' as connection", "*").drop(manifest["connection"]).where("`table` = 'filtered'").first()
    read = default_reader({"dev": {"url": "jdbc:x", "user": "u"}})
    assert read(spark, row, "source").count() == 4
    assert seen["url"] == "jdbc:x" and seen["table"] == row["source"]
    assert read(spark, row, "target").count() == 29


def test_a_jdbc_source_computes_its_own_metrics(spark, manifest, monkeypatch):
    """Stand-in for a JDBC source: it answers the metric query from a view."""
    asked = []

    def answer(session, url, table=None, query=None, **options):
        asked.append(query or table)
        view = session.sql("select id, id % 3 as v, concat('s', id) as s from range(30)")
        if query is None:
            return view
        return session.sql(query.replace("db.a", "{view}"), view=view)

    monkeypatch.setattr("tallymark.plans.job.read_jdbc", answer)
    pairs = manifest.where("`table` in ('same', 'changed')").selectExpr(
        "'dev' as connection", "`table`", "'db.a' as source", "target", "'where id < 20' as source_condition",
        "'id < 20' as target_condition",
    )
    result = run(spark, normalise_manifest(pairs), jdbc={"dev": {"url": "jdbc:x", "partition_column": "id"}})
    assert {r["table"]: r["Status"] for r in result.report.collect()} == {"same": "Pass", "changed": "Fail"}
    assert sorted({a.split(" ")[0] for a in asked}) == ["db.a", "select"]
    assert all(a.endswith("from db.a where id < 20") for a in asked if a != "db.a")


def test_sink_writes_everything(spark, tmp_path):
    write_result(spark.range(20000), f"{tmp_path}/all", "csv")
    assert read_files(spark, f"{tmp_path}/all", "csv").count() == 20000


def test_runs_append_under_their_own_id(spark, tmp_path):
    pair = spark.createDataFrame([("dev", "t", "select 1 as a", "select 1 as a")], "connection string, `table` string, source_query string, target_query string")
    for _ in range(2):
        run(spark, normalise_manifest(pair), folder=str(tmp_path))
    report = spark.read.parquet(f"{tmp_path}/report")
    assert report.count() == 2 and report.select("run_id").distinct().count() == 2


def test_an_error_without_text_is_one_failed_pair(spark):
    def broken(*_):
        raise RuntimeError

    pair = spark.createDataFrame([("dev", "t")], "connection string, `table` string")
    report = run(spark, normalise_manifest(pair), read=broken).report.collect()
    assert [(r["Status"], r["Remarks"]) for r in report] == [("Failed with Error", "RuntimeError: no message")]


@pytest.mark.parametrize("keys", [None, "k"])
@pytest.mark.parametrize(
    "target", ["int(1) as x", "true as x", "array(1) as x", "'a' as x", "1 as y", "date'2020-01-01' as x, 1 as y"]
)
def test_retyped_and_lost_columns_never_pass(spark, keys, target):
    for source in ("date'2020-01-01' as x", "array(true) as x"):
        pair = spark.createDataFrame(
            [("t", f"select 1 as k, {source}", f"select 1 as k, {target}", keys)],
            "`table` string, source_query string, target_query string, keys string",
        )
        assert run(spark, normalise_manifest(pair)).report.first()["Status"] != "Pass"


def test_preview(spark):
    got = preview(spark.sql("select if(id = 0, null, id) as a from range(2000)"), ["a"], 3)
    assert [r["a"] for r in got.collect()] == [1, 2, 3]
    assert preview(spark.range(2000), ["id"]).count() == 1000
