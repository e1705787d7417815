"""Columns that later expressions use many times."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: dict) -> DataFrame:
    """Adds columns that are computed exactly once per row.

    ``withColumns`` lets the optimizer put an expression in place of the column, and inside
    a function over an array that would compute it again for every element. A generator of
    one row keeps it apart, within the same stage and without a shuffle.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(values)))
