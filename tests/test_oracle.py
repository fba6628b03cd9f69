"""Every query against its SQL on the smallest tables."""

import os

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry
from murmur.checks import ORACLE as SQL
from murmur.checks import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    names, rows = spark_rows(QUERIES[name](spark, SF))
    want_names, want = sql_rows(con, SQL[name])
    assert names == want_names
    assert len(rows) == len(want)
    assert rows == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["publish_date", "source", "rank", "keyword", "cnt"]
    assert df.count() > 0
