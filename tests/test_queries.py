"""Every registered query with a SQL check, on the smallest tables."""

import os

import pytest
from check_queries import compare, duck

import __spark_entry__ as entry

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(con, entry.oracle_sql()[name], entry.queries()[name](spark, FOLDER)) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {"category", "total", "coverage", "avg_price"} <= set(rows[0].asDict()) and len(rows) == 6
