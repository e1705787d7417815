"""Queries of this package by name, and the SQL of those that SQL can express."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Registers a function (spark, folder) -> DataFrame and its SQL."""
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add
