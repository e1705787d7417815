"""Positions stored in buckets, so that comparing snapshots needs no shuffle.

The tracked rows of a history lie in a table that is bucketed by (fund, source, delta key) and sorted by
those and the date. All dates of a position are in one bucket: lots are summed, and a position is set
beside its neighbours in time, by the task that reads the bucket. Appending adds files to the buckets.

The number of buckets is fixed when the table is made: a bucket should fit a task (some 100 MB
of Parquet), so 100 TB want about a million of them, or a table per range of funds.
"""

from pyspark.sql import DataFrame, SparkSession

from holdrift.fixed_values import DEFAULT_SOURCE
from holdrift.operators import deltas, snapshots
from holdrift.operators.snapshots import FUND
from holdrift.plans.joins import join_side

KEYS = [*FUND, "delta_key"]
ORDER = [*KEYS, "as_of_date"]


def write_positions(history: DataFrame, table: str, folder: str, buckets: int, mode="errorifexists") -> DataFrame:
    """Writes (or with mode ``append`` adds) the tracked rows of a history to a table of positions.

    Rows are dealt by the same hash as the buckets, so that each write makes one file per bucket.
    """
    placed = deltas.tracked_positions(history).repartition(buckets, *KEYS)
    placed.write.format("parquet").mode(mode).bucketBy(buckets, *KEYS).sortBy(*ORDER).option("path", folder).saveAsTable(table)
    return history.sparkSession.table(table)


def open_positions(spark: SparkSession, table: str, folder: str, buckets: int, like: DataFrame) -> DataFrame:
    """Names the positions that lie in a folder as a table of this session's catalog."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in deltas.tracked_positions(like).schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({', '.join(KEYS)}) "
              f"SORTED BY ({', '.join(ORDER)}) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return spark.table(table)


def history_deltas(positions: DataFrame, universe, dates, source=DEFAULT_SOURCE) -> DataFrame:
    """``views.history_deltas`` of a table of positions. ``dates``: the snapshot dates of the whole history.

    Dates on which a fund holds nothing that is tracked are snapshots too, so they do not come from here.
    """
    following = join_side(snapshots.neighbouring_dates(snapshots.snapshot_dates(dates, source)))
    return deltas.deltas_of_positions(positions, following, universe, laid_out=True)


def daily_deltas(positions: DataFrame, universe, dates, source=DEFAULT_SOURCE, as_of=None) -> DataFrame:
    """``views.daily_deltas`` of a table of positions."""
    pairs = snapshots.latest_pairs(snapshots.snapshot_dates(dates, source, as_of))
    return deltas.deltas_of_paired(positions, pairs, universe).drop("pair_date")
