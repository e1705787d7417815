"""Snapshot dates of each fund, and which two snapshots are compared."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdrift.plans.joins import join_side

FUND = ["etf_ticker", "source"]
CURRENT, PREVIOUS = 1, 0


def snapshot_dates(history: DataFrame, source=None, as_of=None) -> DataFrame:
    """Distinct (fund, source, date) of a history, optionally of one source and up to a date.

    All rows count, tracked or not: a date on which a fund only held cash is a snapshot.
    """
    rows = history
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    if as_of is not None:
        as_of = as_of if hasattr(as_of, "cast") else F.lit(as_of)
        rows = rows.filter(F.col("as_of_date") <= as_of.cast("date"))
    return rows.select(*FUND, "as_of_date").distinct()


def ranked_dates(dates: DataFrame) -> DataFrame:
    """Dates with ``date_rank``: 1 is a fund's newest snapshot, 2 the one before."""
    newest_first = Window.partitionBy(*FUND).orderBy(F.desc("as_of_date"))
    return dates.withColumn("date_rank", F.dense_rank().over(newest_first))


def latest_pairs(dates: DataFrame) -> DataFrame:
    """Each fund's newest snapshot as current side and the one before as previous side."""
    recent = ranked_dates(dates).filter("date_rank <= 2")
    newest = F.max("as_of_date").over(Window.partitionBy(*FUND))
    return recent.select(
        *FUND, "as_of_date",
        newest.alias("pair_date"),
        F.when(F.col("date_rank") == 1, CURRENT).otherwise(PREVIOUS).alias("side"),
    )


def consecutive_pairs(dates: DataFrame) -> DataFrame:
    """Every snapshot paired with the one before it, over the whole history."""
    following = F.lead("as_of_date").over(Window.partitionBy(*FUND).orderBy("as_of_date"))
    roles = F.array(
        F.struct(F.col("as_of_date").alias("pair_date"), F.lit(CURRENT).alias("side")),
        F.struct(following.alias("pair_date"), F.lit(PREVIOUS).alias("side")),
    )
    both = dates.select(*FUND, "as_of_date", roles.alias("roles"))
    return both.select(*FUND, "as_of_date", F.inline("roles")).filter(
        F.col("pair_date").isNotNull())


def neighbouring_dates(dates: DataFrame) -> DataFrame:
    """Every snapshot date of a fund with the fund's ``previous_date`` and ``next_date``."""
    in_time = Window.partitionBy(*FUND).orderBy("as_of_date")
    return dates.select(
        *FUND, "as_of_date", F.lag("as_of_date").over(in_time).alias("previous_date"),
        F.lead("as_of_date").over(in_time).alias("next_date"))


def rows_of_pairs(history: DataFrame, pairs: DataFrame) -> DataFrame:
    """History rows of the compared snapshots; a row is repeated per pair it belongs to.

    The pair table has two rows per fund and compared date. If it is small, which is
    measured, the history is read without any shuffle.
    """
    # After the pairs are settled, this filter (which keeps all of them) still tells the
    # optimizer that they are selective, so that it prunes the history by date.
    side = join_side(pairs).filter(F.col("side") >= PREVIOUS)
    return history.join(side, [*FUND, "as_of_date"])


def latest_date_per_fund(dates: DataFrame) -> DataFrame:
    return dates.groupBy("etf_ticker").agg(F.max("as_of_date").alias("latest_stored"))


def aligned_date(latest: DataFrame, paused: DataFrame | None = None) -> DataFrame:
    """One row: the newest date that every active fund has reached."""
    active = latest if paused is None else latest.join(paused, "etf_ticker", "left_anti")
    return active.agg(F.min("latest_stored").alias("aligned_date"))
