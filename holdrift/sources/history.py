"""The snapshot history: reading, appending, exporting, re-stamping."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from holdrift.fixed_values import DEFAULT_SOURCE, HISTORY_COLUMNS
from holdrift.functions.classify import with_instrument_type
from holdrift.functions.text import blank_to_null
from holdrift.operators.coverage import rows_and_dates, rows_per_type
from holdrift.plans.joins import join_side, settled
from holdrift.schemas import HISTORY

# A date of more rows is written in several parts of about so many.
PART_ROWS = 250_000


def with_history_columns(rows: DataFrame) -> DataFrame:
    """The stored columns in their order and types; missing ones are NULL."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in HISTORY.fields])


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HISTORY)


def read_history(spark: SparkSession, folder: str) -> DataFrame:
    """The stored history; an empty one of the same types before the first run."""
    try:
        return with_history_columns(spark.read.parquet(folder))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return empty_history(spark)
        raise


def csv_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """Files per header line, and whether their records hold line breaks; one pass over the text.

    The first line of a file is its header, whatever it says. A line with an odd number of quotes
    begins or ends a record of several lines.
    """
    lines = spark.read.text(folder).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"),
        (F.col("_metadata.file_block_start") == 0).alias("first_block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    files = lines.groupBy("file").agg(
        F.min_by("value", F.when(F.col("first_block"), F.col("at"))).alias("header"),
        F.bool_or(quotes % 2 == 1).alias("broken"))
    return files.select(F.rtrim("header").alias("header"), "broken", "file").groupBy("header", "broken").agg(
        F.collect_list("file").alias("files"))


def read_csv_history(spark: SparkSession, folder: str) -> DataFrame:
    """A history kept as delimited files; columns are matched by name, not by place.

    Empty text, quoted or not, is a missing value, and so is a column a file lacks. Files whose
    records stay on one line are split over tasks.
    The driver only learns the file names per header, as it does to plan any scan.
    """
    tables = []
    for layout in csv_layouts(spark, folder).orderBy("header", "broken").collect():
        names = [name.strip().strip('"') for name in layout.header.lstrip("\ufeff").split(",")]
        types = {f.name: f.dataType for f in HISTORY.fields}
        schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
        part = spark.read.schema(schema).csv(
            sorted(layout.files), header=True, multiLine=layout.broken, escape='"')
        filled = part.select(*[
            blank_to_null(c).alias(c) if t == "string" else F.col(c) for c, t in part.dtypes])
        tables.append(with_history_columns(filled))
    if not tables:
        return empty_history(spark)
    whole = tables[0]
    for part in tables[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def stored_dates(history: DataFrame) -> DataFrame:
    return history.select("etf_ticker", "as_of_date").filter(
        F.col("as_of_date").isNotNull()).distinct()


def batch_heads(rows: DataFrame, batch=("etf_ticker",)) -> DataFrame:
    """One row per batch: its newest date, which stands for all its rows, and its size."""
    return rows.groupBy(*batch).agg(
        F.max("as_of_date").alias("as_of_date"), F.count(F.lit(1)).alias("n_rows"))


def judged_heads(heads: DataFrame, history: DataFrame, run_date, batch=("etf_ticker",)):
    """Adds ``status`` to batch heads: no_data, future_date, skipped or ingested.

    A fund's date that is stored already is skipped; so is a second batch of one run with
    the same fund and date. Only the history's partitions of the incoming dates are read.
    """
    heads = settled(heads)
    wanted = join_side(heads.filter(F.col("as_of_date") <= F.lit(run_date).cast("date")).select(
        "etf_ticker", "as_of_date")).filter(F.col("as_of_date").isNotNull())
    known = history.select("etf_ticker", "as_of_date").join(
        wanted, ["etf_ticker", "as_of_date"], "left_semi").distinct().withColumn(
        "stored", F.lit(True))
    same_day = Window.partitionBy("etf_ticker", "as_of_date").orderBy(*batch)
    date = F.col("as_of_date")
    status = (
        F.when(date.isNull(), "no_data")
        .when(date > F.lit(run_date).cast("date"), "future_date")
        .when(F.col("stored") | (F.col("turn") > 1), "skipped")
        .otherwise("ingested")
    )
    judged = heads.join(known, ["etf_ticker", "as_of_date"], "left").withColumn(
        "turn", F.row_number().over(same_day))
    return judged.withColumn("status", status).drop("stored", "turn")


def with_taken_dates(judged: DataFrame, taken: DataFrame) -> DataFrame:
    """Judged heads after more dates, distinct ones of (fund, date), have been stored: these are skipped."""
    stored = taken.withColumn("stored", F.lit(True))
    gone = (F.col("status") == "ingested") & F.col("stored")
    return judged.join(stored, ["etf_ticker", "as_of_date"], "left").select(*[
        F.when(gone, "skipped").otherwise(F.col(c)).alias(c) if c == "status" else c for c in judged.columns])


def new_rows(rows: DataFrame, judged: DataFrame, batch=("etf_ticker",), source=DEFAULT_SOURCE):
    """The rows of ingested batches, stamped with the batch's date, fund and source."""
    accepted = judged.filter("status = 'ingested'").select(
        *batch, F.col("as_of_date").alias("_date"))
    kept = rows.join(join_side(accepted), list(batch))
    return with_history_columns(kept.withColumns({
        "as_of_date": F.col("_date"), "source": F.lit(source)}))


def status_rows(judged: DataFrame, batch=("etf_ticker",)) -> DataFrame:
    ingested = F.col("status") == "ingested"
    dated = F.col("status").isin("ingested", "skipped")
    return judged.select(
        *batch, "status", F.when(dated, F.col("as_of_date")).alias("as_of_date"),
        F.when(ingested, F.col("n_rows")).otherwise(0).cast("long").alias("n_today"))


def ingested_per_date(judged: DataFrame) -> DataFrame:
    """as_of_date, n_rows of what judged batches bring."""
    return judged.filter("status = 'ingested'").groupBy("as_of_date").agg(F.sum("n_rows").alias("n_rows"))


def balanced(rows: DataFrame, per_date: DataFrame | None = None) -> DataFrame:
    """The same rows, those of a large date dealt into parts by position; rebalancing then joins small dates and parts.

    Rebalancing alone splits a date only between the tasks that read it, so a source read by one task would
    bring whole dates into the sort of one write task. Rows per date are counted if they are not given.
    """
    if per_date is None:
        per_date = rows.groupBy("as_of_date").agg(F.count("*").alias("n_rows"))
    large = join_side(per_date.filter(F.col("n_rows") > PART_ROWS).select(
        F.col("as_of_date").alias("_date"), F.ceil(F.col("n_rows") / PART_ROWS).alias("_parts")))
    position = F.xxhash64("etf_ticker", "constituent_ticker", "constituent_name", "isin")
    dealt = rows.join(large, F.col("as_of_date").eqNullSafe(F.col("_date")), "left").withColumn(
        "_part", F.pmod(position, F.coalesce("_parts", F.lit(1))))
    return dealt.hint("rebalance", "as_of_date", "_part").drop("_part", "_date", "_parts")


def write_history(rows: DataFrame, folder: str, mode="append", per_date: DataFrame | None = None) -> None:
    """Writes rows by date; a large date takes several files, small ones are written by one task."""
    whole = balanced(rows, per_date).sortWithinPartitions("etf_ticker")
    whole.write.mode(mode).partitionBy("as_of_date").parquet(folder)


def append_snapshots(rows: DataFrame, folder: str, run_date, batch=("etf_ticker",),
                     source=DEFAULT_SOURCE) -> DataFrame:
    """Appends the batches whose date is new, and returns the status of each.

    Running it again with the same rows changes nothing.
    """
    history = read_history(rows.sparkSession, folder)
    judged = settled(judged_heads(batch_heads(rows, batch), history, run_date, batch))
    write_history(new_rows(rows, judged, batch, source), folder, per_date=ingested_per_date(judged))
    return status_rows(judged, batch)


def exported(history: DataFrame, funds: DataFrame, source=DEFAULT_SOURCE) -> DataFrame:
    """Stored columns of one source and the listed funds."""
    listed = funds.select("etf_ticker").distinct()
    return with_history_columns(history.filter(F.col("source") == source)).join(
        listed, "etf_ticker", "left_semi").select(*HISTORY_COLUMNS)


def export_history(history: DataFrame, funds: DataFrame, folder: str,
                   source=DEFAULT_SOURCE) -> DataFrame:
    """Writes the export per fund, ordered by date and ticker; returns rows and dates per fund."""
    rows = exported(history, funds, source)
    rows.hint("rebalance", "etf_ticker").sortWithinPartitions(
        "etf_ticker", "as_of_date", "constituent_ticker"
    ).write.mode("overwrite").partitionBy("etf_ticker").parquet(folder)
    return rows_and_dates(with_history_columns(history.sparkSession.read.parquet(folder)))


def restamped(history: DataFrame) -> DataFrame:
    """All rows classified anew; an empty label falls back to the sector as hint."""
    hint = F.coalesce(blank_to_null("asset_class"), blank_to_null("sector"))
    return with_history_columns(with_instrument_type(with_history_columns(history), label=hint))


def restamp_history(history: DataFrame, folder: str) -> DataFrame:
    """Writes the re-stamped history to a new folder; returns rows per type and fund."""
    write_history(restamped(history), folder, mode="errorifexists")
    return rows_per_type(read_history(history.sparkSession, folder))
