"""Signals across funds: which securities several funds moved.

Three tables: ``details`` has one row per security and voting fund, ``signals`` one row
per security, and ``nested_details`` packs details into arrays of bounded length.
A security held by very many funds is thus never gathered in one row or task.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdrift.fixed_values import CASH_ISIN
from holdrift.functions.text import blank_to_null
from holdrift.operators.deltas import ADDITION, CHANGE, EXACT, REMOVAL
from holdrift.plans.joins import join_side, local_table

_LISTINGS = T.StructType([
    T.StructField("group_no", T.IntegerType()),
    T.StructField("group_key", T.StringType()),
    T.StructField("place", T.IntegerType()),
    T.StructField("etf_ticker", T.StringType()),
])

DETAIL_COLUMNS = [
    "isin", "group_key", "etf_ticker", "constituent_ticker", "constituent_name",
    "delta_type", "delta_weight_pct", "delta_shares", "delta_market_value",
]


def group_table(spark: SparkSession, groups) -> DataFrame:
    """Listings of one fund on several exchanges: (etf_ticker, group_key, group_rank).

    A group is named by its first listing, and a fund belongs to the last group that lists it. Its
    rank is its place in the last group of that name, or 0 if it is not listed there.
    """
    listings = local_table(spark, [
        (number, listed[0], place, fund)
        for number, listed in enumerate(groups or []) for place, fund in enumerate(listed)], _LISTINGS)
    belongs = listings.groupBy("etf_ticker").agg(F.max_by("group_key", "group_no").alias("group_key"))
    latest = listings.groupBy("group_key").agg(F.max("group_no").alias("group_no"))
    ranks = listings.join(latest, ["group_key", "group_no"]).groupBy("group_key", "etf_ticker").agg(
        F.min("place").alias("group_rank"))
    return belongs.join(ranks, ["group_key", "etf_ticker"], "left").select(
        "etf_ticker", "group_key", F.coalesce("group_rank", F.lit(0)).alias("group_rank"))


def with_group(rows: DataFrame, groups) -> DataFrame:
    """Adds ``group_key`` and ``group_rank``; a fund in no group is its own group."""
    table = group_table(rows.sparkSession, groups)
    joined = rows.join(table, "etf_ticker", "left")
    return joined.withColumns({
        "group_key": F.coalesce("group_key", "etf_ticker"),
        "group_rank": F.coalesce("group_rank", F.lit(0)),
    })


def _first_of_group(rows: DataFrame, *key) -> DataFrame:
    """The row of the first listed fund per group and key."""
    best_first = Window.partitionBy("group_key", *key).orderBy(
        "group_rank", "etf_ticker", "delta_type", F.desc("delta_market_value"))
    return rows.withColumn("_place", F.row_number().over(best_first)).filter(
        F.col("_place") == 1).drop("_place")


def collapse_moves(moves: DataFrame, groups) -> DataFrame:
    """One row per group and security in each list of moves."""
    if not groups:
        return moves
    security = F.coalesce(blank_to_null("isin"), F.col("constituent_ticker"))
    grouped = with_group(moves, groups).withColumn("_security", security)
    return _first_of_group(grouped, "delta_type", "_security").drop(
        "_security", "group_key", "group_rank")


def is_joinable_isin(c="isin") -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin("", CASH_ISIN)


def details(deltas: DataFrame, groups=None, moved_only=False) -> DataFrame:
    """The votes: one delta per security and group of listings.

    All deltas vote, so a fund that merely holds a security on either date counts too;
    ``moved_only`` leaves out positions without any difference.
    """
    votes = deltas.filter(is_joinable_isin())
    if moved_only:
        still = (F.col("delta_type") == CHANGE) & (F.col("delta_shares") == 0) & (
            F.col("delta_weight_pct") == 0)
        votes = votes.filter(~F.coalesce(still, F.lit(False)))
    votes = with_group(votes, groups)
    if groups:
        votes = _first_of_group(votes, "isin")
    return votes.select(*DETAIL_COLUMNS)


def _first_named(c) -> Column:
    """The text of the first fund that states one."""
    empty = F.when(F.col(c) == "", 1).otherwise(0)
    place = F.struct(empty, F.col("etf_ticker"), F.col(c))
    return F.min(F.when(F.col(c).isNotNull(), place))[c].alias(c)


def _value_sum(rows: DataFrame, value: Column) -> Column:
    """Sum of value differences; of stored doubles as decimals, so that it does not depend on an order."""
    if rows.schema["delta_market_value"].dataType.typeName() == "double":
        value = value.try_cast(EXACT)
        return F.sum(value).cast("double").alias("total_delta_market_value")
    return F.sum(value).alias("total_delta_market_value")


def signals(details: DataFrame) -> DataFrame:
    """One row per security: voting funds, directions, and the summed value difference."""
    moved = F.coalesce(F.col("delta_weight_pct"), F.lit(0))
    value = F.coalesce(F.col("delta_market_value"), F.lit(0))
    return details.groupBy("isin").agg(
        _first_named("constituent_name"),
        _first_named("constituent_ticker"),
        F.count_distinct("group_key").alias("n_etfs"),
        F.count_if(moved > 0).alias("n_etfs_weight_up"),
        F.count_if(moved < 0).alias("n_etfs_weight_down"),
        F.count_if(F.col("delta_type") == ADDITION).alias("n_etfs_added"),
        F.count_if(F.col("delta_type") == REMOVAL).alias("n_etfs_removed"),
        _value_sum(details, value),
    )


def _plain_votes(deltas: DataFrame) -> DataFrame:
    return deltas.filter(F.col("isin").isNotNull() & (F.col("isin") != CASH_ISIN))


def plain_nested_votes(deltas: DataFrame, min_funds=2, per_part=1000) -> DataFrame:
    """The votes behind ``plain_signals`` as arrays of bounded length: (isin, part, etf_details)."""
    return nested_details(details_of(plain_signals(deltas, min_funds), _plain_votes(deltas)), per_part)


def plain_signals(deltas: DataFrame, min_funds=2) -> DataFrame:
    """The variant without listing groups that keeps sums of only NULLs NULL; see ``by_value`` for its order."""
    rows = _plain_votes(deltas)
    found = rows.groupBy("isin").agg(
        F.max("constituent_name").alias("constituent_name"),
        F.count_distinct("etf_ticker").alias("n_etfs"),
        F.count_if(F.col("delta_weight_pct") > 0).alias("n_etfs_weight_up"),
        F.count_if(F.col("delta_weight_pct") < 0).alias("n_etfs_weight_down"),
        F.count_if(F.col("delta_type") == ADDITION).alias("n_etfs_added"),
        F.count_if(F.col("delta_type") == REMOVAL).alias("n_etfs_removed"),
        _value_sum(rows, F.col("delta_market_value")),
    )
    return found.filter(F.col("n_etfs") >= min_funds)


def converging(signals: DataFrame, min_funds=2) -> DataFrame:
    return signals.filter(F.col("n_etfs") >= min_funds)


def by_value(signals: DataFrame) -> DataFrame:
    """Signals by size of the summed value difference, largest first."""
    size = F.abs(F.coalesce(F.col("total_delta_market_value"), F.lit(0)))
    return signals.orderBy(size.desc(), "isin")


def details_of(signals: DataFrame, details: DataFrame) -> DataFrame:
    return details.join(signals.select("isin"), "isin", "left_semi")


def in_parts(rows: DataFrame, per_part=1000) -> DataFrame:
    """Adds ``part`` so that each (isin, part) has about ``per_part`` funds.

    A security with few funds has one part; one with many has as many as it needs, and
    they are spread over tasks.
    """
    sizes = rows.groupBy("isin").agg(
        F.ceil(F.count(F.lit(1)) / per_part).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("etf_ticker"), F.col("_parts")).cast("int")
    return rows.join(join_side(sizes), "isin").withColumn("part", part).drop("_parts")


def nested_details(details: DataFrame, per_part=1000) -> DataFrame:
    """Details as arrays of bounded length: (isin, part, etf_details)."""
    entry = F.struct(
        "etf_ticker", "delta_type", "delta_weight_pct", "delta_shares", "delta_market_value")
    return in_parts(details, per_part).groupBy("isin", "part").agg(
        F.sort_array(F.collect_list(entry)).alias("etf_details"))


def rescope(signals: DataFrame, details: DataFrame, wanted: Column):
    """Signals and details of a subset of funds; fewer than two funds are no signal."""
    kept = details_of(signals, details.filter(wanted))
    counted = kept.groupBy("isin").agg(F.count_distinct("etf_ticker").alias("n_etfs"))
    counted = counted.filter(F.col("n_etfs") >= 2)
    scoped = signals.drop("n_etfs").join(counted, "isin")
    return scoped, details_of(counted, kept)


def unit_directions(details: DataFrame) -> DataFrame:
    """Per security the changes with more and with fewer shares: real buying and selling."""
    changed = F.col("delta_type") == CHANGE
    shares = F.coalesce(F.col("delta_shares"), F.lit(0))
    return details.groupBy("isin").agg(
        F.count_if(changed & (shares > 0)).alias("units_up"),
        F.count_if(changed & (shares < 0)).alias("units_down"),
    )


def votes_up() -> Column:
    moved = F.coalesce(F.col("delta_weight_pct"), F.lit(0))
    return (moved > 0) | (F.col("delta_type") == ADDITION)


def votes_down() -> Column:
    moved = F.coalesce(F.col("delta_weight_pct"), F.lit(0))
    return (moved < 0) | (F.col("delta_type") == REMOVAL)


def direction_votes(details: DataFrame) -> DataFrame:
    """Per security the funds for up and down; a tie points up."""
    counted = details.groupBy("isin").agg(
        F.count_if(votes_up()).alias("up_votes"), F.count_if(votes_down()).alias("down_votes"))
    return counted.withColumn(
        "arrow", F.when(F.col("up_votes") >= F.col("down_votes"), "↑").otherwise("↓"))


def funds_of_winning_side(details: DataFrame, votes: DataFrame) -> DataFrame:
    """One row per security and fund that voted in the winning direction."""
    winning = F.when(F.col("arrow") == "↑", votes_up()).otherwise(votes_down())
    return details.join(votes.select("isin", "arrow"), "isin").filter(winning).select(
        "isin", "arrow", "etf_ticker")
