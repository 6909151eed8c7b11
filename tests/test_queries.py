import sys

import pytest
from compare import connect, difference

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(driver.QUERIES) == set(driver.SQL)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(driver.queries()[name](spark, FOLDER), con, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 5
    assert "sensorweave" in sys.modules
