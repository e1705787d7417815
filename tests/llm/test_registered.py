"""Queries that have SQL give its rows; all others run."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from holdrift.llm.registry import ORACLES, QUERIES
from workload.check import compare, views

FOLDER = "/root/testdata/sf0.001"


def test_names():
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in QUERIES) == 1
    assert "pipeline" in QUERIES and set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    views(connection, FOLDER)
    same, rows, _, message = compare(spark, connection, name, QUERIES[name], ORACLES[name], FOLDER)
    assert same, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline"}))
def test_a_row_per_document(spark, name):
    table = "pages" if name == "page_languages" else "documents"
    assert QUERIES[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
