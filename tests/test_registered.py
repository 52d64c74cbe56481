"""Every registered query against its SQL."""

import re

import oracle
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF)


# Those of the optional subpackage have tests of their own.
QUERIES = [n for n in driver.queries() if not re.match(r"op\d+_|pipeline$", n)]


def test_every_query_has_sql():
    assert set(QUERIES) <= driver.oracle_sql().keys()


def test_entry(spark):
    assert 0 < driver.entry(spark).count() <= 50


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    got = oracle.spark_rows(driver.queries()[name](spark, SF))
    expected = oracle.duckdb_rows(connection, driver.oracle_sql()[name])
    assert got == expected and got[1]
