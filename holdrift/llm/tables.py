"""Intermediate tables in the folder that all executors share."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdrift.plans.joins import BROADCAST_BYTE_LIMIT, checkpoint_folder, row_bytes

_written = []


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (a local one for a local master)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        checkpoint_folder(spark)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: its lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Deletes what ``stored`` has written in this session; results that read it must be saved before."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


def small_side(df: DataFrame, byte_limit: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """A stored table, marked for broadcast only if its measured bytes are within the limit.

    Beyond the limit both sides of the join are shuffled; the rows are the same.
    """
    measured = df.agg(F.sum(row_bytes(df).cast("long"))).first()[0] or 0
    return F.broadcast(df) if measured <= byte_limit else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
