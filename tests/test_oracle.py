"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__
from compare import connect, difference
from shopmill.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert all(q.sql is not None for q in QUERIES.values())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, FOLDER, name) is None  # no rows on either side is a failure, too


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["year", "month", "monthly_sales", "monthly_orders", "monthly_quantity"]
    assert df.count() > 0
