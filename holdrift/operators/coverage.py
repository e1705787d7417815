"""Counts, freshness and status tables about a run."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdrift.operators.deltas import ADDITION, CHANGE, REMOVAL


def view_dates(deltas: DataFrame) -> DataFrame:
    """One row: the newest current and the newest previous date among the deltas."""
    return deltas.agg(F.max("curr_as_of_date").alias("as_of_date"),
                      F.max("prev_as_of_date").alias("previous_date"))


def move_summary(moves: DataFrame) -> DataFrame:
    """One row: listed additions, removals, changes and the funds they belong to."""
    return moves.agg(
        F.count_if(F.col("delta_type") == ADDITION).alias("total_additions"),
        F.count_if(F.col("delta_type") == REMOVAL).alias("total_removals"),
        F.count_if(F.col("delta_type") == CHANGE).alias("total_significant_changes"),
        F.count_distinct("etf_ticker").alias("etfs_processed"),
    )


def run_summary(deltas: DataFrame, moves: DataFrame) -> DataFrame:
    """The counts of a run before it is scoped: its moves, and the funds with any delta at all."""
    funds = deltas.agg(F.count_distinct("etf_ticker").alias("etfs_processed"))
    return move_summary(moves).withColumn("etfs_processed", funds.scalar())


def has_moves(moves: DataFrame) -> DataFrame:
    """One row telling whether anything is left to report."""
    return moves.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_moves"))


def rows_per_type(rows: DataFrame) -> DataFrame:
    """Rows per fund and instrument type, with totals: NULL stands for all."""
    return rows.rollup("instrument_type", "etf_ticker").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.grouping("instrument_type").alias("all_types"),
        F.grouping("etf_ticker").alias("all_funds"))


def rows_and_dates(rows: DataFrame) -> DataFrame:
    """Rows and distinct dates per fund.

    Counted per (fund, date) first, so that one large fund is spread over many tasks.
    """
    per_date = rows.groupBy("etf_ticker", "as_of_date").agg(F.count(F.lit(1)).alias("n"))
    return per_date.groupBy("etf_ticker").agg(
        F.sum("n").alias("n_rows"), F.count("as_of_date").alias("n_dates"))


def coverage(status: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: tracked funds, and how many were ingested, skipped, failed or external."""
    listed = universe.select("etf_ticker", F.coalesce("enabled", F.lit(True)).alias("active"))
    state = F.col("status")
    return listed.join(status.select("etf_ticker", "status"), "etf_ticker", "full_outer").agg(
        # A fund with several documents has several statuses but is tracked once.
        F.count_distinct(F.when(F.col("active"), F.col("etf_ticker"))).alias("tracked"),
        F.count_if(state == "ingested").alias("ingested"),
        F.count_if(state == "skipped").alias("skipped"),
        F.count_if(state.isin("failed", "no_data", "future_date")).alias("failed"),
        F.count_if(state == "external").alias("external"),
    )


def paused(universe: DataFrame) -> DataFrame:
    return universe.filter(~F.coalesce(F.col("enabled"), F.lit(True))).select("etf_ticker")


def freshness(status: DataFrame, latest: DataFrame, universe: DataFrame) -> DataFrame:
    """Status per fund with its newest stored date; paused funds have none."""
    active = latest.join(paused(universe), "etf_ticker", "left_anti")
    return status.join(active, "etf_ticker", "left").orderBy("etf_ticker")


def stale_funds(status: DataFrame, dates: DataFrame) -> DataFrame:
    """Funds whose own date lies before the view's previous date (``view_dates``)."""
    own = status.select("etf_ticker", F.coalesce("as_of_date", "latest_stored").alias("fund_date"))
    return own.filter(F.col("fund_date") < dates.select("previous_date").scalar())


def sort_key(c, number=True, size_only=False) -> Column:
    """Key of a sortable table: numbers (or their size) with NULL lowest, text in any case."""
    value = F.col(c) if isinstance(c, str) else c
    if number:
        value = F.abs(value) if size_only else value
        return F.coalesce(value.cast("double"), F.lit(float("-inf")))
    return F.lower(F.coalesce(value.cast("string"), F.lit("")))


def sorted_table(rows: DataFrame, c, descending=True, number=True, size_only=False,
                 then=()) -> DataFrame:
    key = sort_key(c, number, size_only)
    return rows.orderBy(key.desc() if descending else key.asc(), *then)
