"""The registered queries against their SQL on the smallest test data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as driver  # noqa: E402
from orderdw.checks.compare import compare, duck  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_entry(spark):
    assert driver.entry(spark).count() == 1


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    same, told = compare(spark, con, FOLDER, QUERIES[name], ORACLE.get(name))
    assert same, told
