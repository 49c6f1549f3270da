import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check_oracles import compare, connect  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tallymark.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_against_oracle(spark, connection, name):
    assert compare(spark, connection, name, FOLDER) is None


def test_entry(spark):
    assert {r["TestCases"] for r in entry(spark).collect()} == {"Count", "Null", "Sum", "Max", "Length", "RLength"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
