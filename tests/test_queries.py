"""Every query gives the rows of its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry
from workload.check import compare, views
from workload.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    views(connection, FOLDER)
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    found = entry(spark)
    assert found.count() > 0 and "delta_type" in found.columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    same, _, _, message = compare(spark, connection, name, QUERIES[name], ORACLES[name], FOLDER)
    assert same, message
