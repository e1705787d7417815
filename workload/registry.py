"""Queries by name, each with the SQL that has to give the same rows."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Registers a function (spark, folder) -> DataFrame and its SQL."""
    def add(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add
