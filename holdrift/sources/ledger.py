"""A history that is appended to in committed runs, with an index of its snapshot dates.

Every run writes its rows into a folder of its own, and beside them the run's part of the dates
index: (fund, source, date, rows). Neither counts before the run is committed, by one small file with the
run's number in the order of commits. Readers obey the commits: rows and dates of other runs do not exist.

- A run that is cut off anywhere before its commit leaves nothing to be seen, and is simply run again.
- Two runs at once both write; only one gets the next number. The other looks at what was committed meanwhile:
  if a date of its own is among it, the run is written anew without it, else it takes the number after.
- A retry finds its dates in the index and appends nothing.

So each (fund, date) is stored exactly once, and which dates are stored is told by the index
without reading the history. This rests on a rename that fails if the target exists, as HDFS has it.

Each run also keeps its crosswalk state, the smallest and largest ISIN per ticker and name key. Merged over the
committed runs they are the crosswalk of the whole history, which is not read for it.

Folders: ``rows/run=…/as_of_date=…``, ``dates/run=…``, ``keys/run=…``, ``commits/<number>``.
"""

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdrift.fixed_values import DEFAULT_SOURCE
from holdrift.operators.resolve import crosswalk_state, merged_states
from holdrift.plans.joins import join_side, settled
from holdrift.schemas import HISTORY
from holdrift.sources import history

RUN = T.StructField("run", T.StringType())
ROWS = T.StructType([*HISTORY.fields, RUN])
DATES = T.StructType([
    T.StructField("etf_ticker", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("as_of_date", T.DateType()), T.StructField("n_rows", T.LongType()), RUN])
KEYS = T.StructType([*(T.StructField(name, T.StringType()) for name in ("table", "key", "low", "high")), RUN])
COMMIT = "run string, n_dates long"
DAY = ["etf_ticker", "source", "as_of_date"]


class Ledger(NamedTuple):
    """What is committed; all tables are lazy."""

    rows: DataFrame   # the stored history
    dates: DataFrame  # etf_ticker, source, as_of_date, n_rows: the dates index
    keys: DataFrame   # table, key, low, high: the crosswalk state of the rows
    version: int      # number of the last commit, -1 before the first


class Staged(NamedTuple):
    """A run that is written but not committed."""

    spark: SparkSession
    folder: str
    batch: tuple
    judged: DataFrame
    run: str | None   # None: nothing was new
    version: int      # the commits it was judged by
    n_dates: int


def _read(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A table of several runs; an empty one before the first."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """version, run, n_dates of every commit."""
    number = F.col("_metadata.file_name").cast("long").alias("version")
    try:
        return spark.read.schema(COMMIT).json(f"{folder}/commits").select(number, "run", "n_dates")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], f"version long, {COMMIT}")
        raise


def read_ledger(spark: SparkSession, folder: str) -> Ledger:
    """The committed rows and dates. The driver learns one short line per run, to prune by run."""
    known = commits(spark, folder).collect()
    runs = F.col("run").isin([c.run for c in known])
    rows = _read(spark, f"{folder}/rows", ROWS).filter(runs)
    dates = _read(spark, f"{folder}/dates", DATES).filter(runs).drop("run")
    keys = merged_states(_read(spark, f"{folder}/keys", KEYS).filter(runs))
    return Ledger(history.with_history_columns(rows), dates, keys, max((c.version for c in known), default=-1))


def dates_of(rows: DataFrame, *more) -> DataFrame:
    """The dates index of rows: (fund, source, date, rows)."""
    return rows.groupBy(*more, *DAY).agg(F.count("*").alias("n_rows"))


def _file_context(spark: SparkSession, folder: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    return hadoop, path.getFileSystem(conf), hadoop.FileContext.getFileContext(path.getFileSystem(conf).getUri(), conf)


def _take_number(spark: SparkSession, folder: str, number: int, run: str, n_dates: int) -> bool:
    """Commits a run under a number, whole or not at all; False if the number is taken."""
    hadoop, files, context = _file_context(spark, folder)
    target = hadoop.Path(f"{folder}/commits/{number:012d}")
    staged = hadoop.Path(f"{folder}/commits/.{run}")
    out = files.create(staged, True)
    out.write(f'{{"run": "{run}", "n_dates": {n_dates}}}\n'.encode())
    out.close()
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(staged, target, options)
    except Exception:
        if not files.exists(target):
            raise
        files.delete(staged, False)
        return False
    return True


def missing_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Runs whose part of the dates index has not the number of dates that was committed."""
    indexed = _read(spark, f"{folder}/dates", DATES).groupBy("run").agg(F.count("*").alias("indexed"))
    return commits(spark, folder).join(indexed, "run", "left").filter(
        F.coalesce("indexed", F.lit(0)) != F.col("n_dates"))


def _whole_index(spark: SparkSession, folder: str) -> None:
    if not missing_dates(spark, folder).isEmpty():
        raise ValueError(f"the dates index of {folder} is incomplete: repair_dates first")


def staged_run(rows: DataFrame, folder: str, run_date, batch=("etf_ticker",), source=DEFAULT_SOURCE) -> Staged:
    """Judges the batches by the dates index and writes the new ones, without committing them."""
    spark = rows.sparkSession
    _whole_index(spark, folder)
    ledger = read_ledger(spark, folder)
    judged = settled(history.judged_heads(history.batch_heads(rows, batch), ledger.dates, run_date, batch))
    if judged.filter("status = 'ingested'").isEmpty():
        return Staged(spark, folder, batch, judged, None, ledger.version, 0)
    run = uuid.uuid4().hex
    n_dates = write_run(history.new_rows(rows, judged, batch, source), folder, run, history.ingested_per_date(judged))
    return Staged(spark, folder, batch, judged, run, ledger.version, n_dates)


def _without(staged: Staged, taken: DataFrame, version: int) -> Staged:
    """A staged run written anew without dates that others have stored since it was judged.

    Stored dates only become more, so nothing else is judged otherwise. What remains is copied from the rows the
    run has written; its source is not read again.
    """
    spark, folder = staged.spark, staged.folder
    _whole_index(spark, folder)
    judged = settled(history.with_taken_dates(staged.judged, taken))
    kept = judged.filter("status = 'ingested'").select("etf_ticker", "as_of_date")
    if kept.isEmpty():
        return staged._replace(judged=judged, run=None, version=version, n_dates=0)
    written = spark.read.schema(HISTORY).parquet(f"{folder}/rows/run={staged.run}")
    run = uuid.uuid4().hex
    rows = written.join(join_side(kept), ["etf_ticker", "as_of_date"], "left_semi")
    n_dates = write_run(history.with_history_columns(rows), folder, run, history.ingested_per_date(judged))
    return staged._replace(judged=judged, run=run, version=version, n_dates=n_dates)


def write_run(rows: DataFrame, folder: str, run: str, per_date: DataFrame | None = None) -> int:
    """Writes rows, dates and keys of an uncommitted run; returns the number of its dates.

    The dates are counted in many tasks; rebalancing joins those of a small run into one file.
    """
    spark = rows.sparkSession
    history.write_history(rows, f"{folder}/rows/run={run}", mode="errorifexists", per_date=per_date)
    written = spark.read.schema(HISTORY).parquet(f"{folder}/rows/run={run}")
    dates_of(written).hint("rebalance").write.parquet(f"{folder}/dates/run={run}")
    crosswalk_state(written).write.parquet(f"{folder}/keys/run={run}")
    return spark.read.parquet(f"{folder}/dates/run={run}").count()


def committed(staged: Staged) -> DataFrame:
    """Commits a staged run, anew judged if another run was faster; returns the status per batch."""
    spark, folder = staged.spark, staged.folder
    while staged.run is not None:
        if _take_number(spark, folder, staged.version + 1, staged.run, staged.n_dates):
            break
        newer = read_ledger(spark, folder)
        own = staged.judged.filter("status = 'ingested'").select("etf_ticker", "as_of_date")
        taken = settled(newer.dates.select(*own.columns).join(join_side(own), own.columns, "left_semi").distinct())
        if taken.isEmpty():
            staged = staged._replace(version=newer.version)
        else:
            staged = _without(staged, taken, newer.version)
    return history.status_rows(staged.judged, staged.batch)


def append_run(rows: DataFrame, folder: str, run_date, batch=("etf_ticker",), source=DEFAULT_SOURCE) -> DataFrame:
    """Appends the batches whose date is new in one committed run, and returns the status of each."""
    return committed(staged_run(rows, folder, run_date, batch, source))


def import_history(rows: DataFrame, folder: str) -> None:
    """Commits a whole existing history, of any sources, as the first run of a new ledger."""
    run = uuid.uuid4().hex
    n_dates = write_run(history.with_history_columns(rows), folder, run)
    if not _take_number(rows.sparkSession, folder, 0, run, n_dates):
        raise ValueError(f"{folder} holds a history already")


def date_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Where index and history of a committed run differ: run, fund, source, date, both numbers of rows."""
    runs = commits(spark, folder).select("run")
    counted = dates_of(_read(spark, f"{folder}/rows", ROWS).join(F.broadcast(runs), "run", "left_semi"), "run")
    indexed = _read(spark, f"{folder}/dates", DATES).join(F.broadcast(runs), "run", "left_semi")
    keys = ["run", *DAY]
    left, right = counted.alias("c"), indexed.alias("i")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys]
    return left.join(right, same, "full_outer").filter(~F.col("c.n_rows").eqNullSafe(F.col("i.n_rows"))).select(
        *[F.coalesce(f"c.{k}", f"i.{k}").alias(k) for k in keys],
        F.col("i.n_rows").alias("indexed"), F.col("c.n_rows").alias("counted"))


def repair_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Writes the index of wrong runs anew from their rows; returns what differed.

    This reads the whole history once. A run whose rows are gone keeps its index and stays reported.
    """
    differing = settled(date_differences(spark, folder))
    wrong = differing.select("run").distinct()
    rows = _read(spark, f"{folder}/rows", ROWS).join(F.broadcast(wrong), "run", "left_semi")
    dates_of(rows, "run").select(*DATES.fieldNames()).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{folder}/dates")
    return differing


def rebuild_keys(spark: SparkSession, folder: str) -> None:
    """Writes the crosswalk states of all committed runs anew from their rows, as for a history that kept none."""
    for commit in commits(spark, folder).collect():
        rows = spark.read.schema(HISTORY).parquet(f"{folder}/rows/run={commit.run}")
        crosswalk_state(rows).write.mode("overwrite").parquet(f"{folder}/keys/run={commit.run}")


def remove_abandoned(spark: SparkSession, folder: str, older_than_seconds: float) -> list:
    """Deletes runs that were not committed and have not been written to for so long; returns their names."""
    hadoop, files, _ = _file_context(spark, folder)
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    old = set()
    for table in ("rows", "dates", "keys"):
        path = hadoop.Path(f"{folder}/{table}")
        for found in files.listStatus(path) if files.exists(path) else []:
            if now - found.getModificationTime() >= 1000 * older_than_seconds and found.getPath().getName().startswith("run="):
                old.add(found.getPath().getName()[4:])
    # Commits are read after the listing, so that a run committed meanwhile is not taken for abandoned.
    gone = sorted(old - {c.run for c in commits(spark, folder).collect()})
    for run in gone:
        for table in ("keys", "dates", "rows"):
            files.delete(hadoop.Path(f"{folder}/{table}/run={run}"), True)
    return gone
