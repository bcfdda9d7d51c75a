"""Every registered query against its check SQL."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import assert_same, database

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert_same(df, con, sql)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
