"""Join sides: small ones are broadcast after a check of their size, others shuffled."""

from collections.abc import Iterable, Sequence
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A broadcast side is held by every executor, so this must not grow with the data.
BROADCAST_BYTE_LIMIT = 64 * 1024 * 1024


def checkpoint_folder(spark: SparkSession) -> None:
    """Makes sure that a checkpoint folder is set; a cluster has to name a shared one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="holdrift-checkpoint-")
    context.setCheckpointDir(folder)


def settled(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def row_bytes(df: DataFrame):
    """Estimated bytes of one row in a broadcast table."""
    size = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        else:
            size = size + 16
    return size


def join_side(df: DataFrame, byte_limit: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """``df`` computed once, marked for broadcast only if its measured size allows it.

    A larger side carries no mark: the join then shuffles both sides, and adaptive
    execution splits the partitions of hot keys.
    """
    once = settled(df)
    measured = once.agg(F.sum(row_bytes(once).cast("long"))).first()[0] or 0
    return F.broadcast(once) if measured <= byte_limit else once


def local_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A table from configuration values; the optimizer knows its size."""
    names = schema.fieldNames()
    columns = [[row[i] for row in rows] for i in range(len(names))]
    arrow_schema = to_arrow_schema(schema)
    arrays = [pa.array(column, type=field.type) for column, field in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema)
