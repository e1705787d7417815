"""Ingest of documents as they land.

A stream reads what has landed, batch by batch, and keeps the parsed documents. When it has seen all
that is available, one run resolves and appends everything parsed since the last run. So the
rows stored do not depend on how documents fall into batches: an ISIN is looked up among all
documents of the run, and of two documents of one fund and date the same one is kept.

A replayed batch replaces its own files, and a run that was cut off is repeated: its dates
that are stored already are skipped.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from holdrift.plans.ingest import ingest_parsed
from holdrift.schemas import DOCUMENTS
from holdrift.sources import documents
from holdrift.sources.history import append_snapshots


def landing_stream(spark: SparkSession, folder: str, files_per_batch=1000) -> DataFrame:
    """Documents landing as Parquet files, a bounded number of files per batch."""
    return spark.readStream.schema(DOCUMENTS).option(
        "maxFilesPerTrigger", files_per_batch).parquet(folder)


def parse_stream(docs: DataFrame, work: str):
    """Starts parsing all documents available now; returns the streaming query."""
    def one_batch(batch: DataFrame, number: int) -> None:
        documents.read_documents(batch).write.mode("overwrite").parquet(f"{work}/parsed/batch={number}")

    return docs.writeStream.foreachBatch(one_batch).option(
        "checkpointLocation", f"{work}/progress").trigger(availableNow=True).start()


def _table(spark: SparkSession, folder: str):
    try:
        return spark.read.parquet(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def pending(spark: SparkSession, work: str):
    """Parsed documents that no finished run has seen, and the last batch of them; or None twice."""
    parsed, finished = _table(spark, f"{work}/parsed"), _table(spark, f"{work}/finished")
    if parsed is None:
        return None, None
    seen = -1 if finished is None else finished.agg(F.max("upto")).first()[0]
    parsed = parsed.where(F.col("batch") > seen)
    return parsed.drop("batch"), parsed.agg(F.max("batch")).first()[0]


def ingest_available(docs: DataFrame, universe: DataFrame, folder: str, work: str, run_date,
                     overrides=None, known=None, append=append_snapshots):
    """Ingests all landed documents of the stream ``docs``; returns their statuses, or None without news.

    ``work`` holds the parsed documents, the stream's progress, and the statuses per run.
    """
    spark = docs.sparkSession
    parse_stream(docs, work).awaitTermination()
    parsed, upto = pending(spark, work)
    if upto is None:
        return None
    status = ingest_parsed(parsed, universe, folder, run_date, overrides, known, append=append)
    # Funds without a document in this run have no news.
    status.where(F.col("path").isNotNull()).withColumn("upto", F.lit(upto).cast(T.LongType())).write.mode(
        "append").parquet(f"{work}/finished")
    return spark.read.parquet(f"{work}/finished").where(F.col("upto") == upto).drop("upto")
