"""The digest of a view: the largest moves and signals as lines of text."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdrift.fixed_values import DIGEST_LIMITS
from holdrift.functions.display import day, fixed, label, short_shares
from holdrift.operators import consensus
from holdrift.operators.deltas import ADDITION, CHANGE, REMOVAL

_LIMIT_OF = {ADDITION: "additions", REMOVAL: "removals", CHANGE: "major_moves"}


def move_size() -> Column:
    """What ranks a move in its section: weight gained or lost, or the size of the change."""
    size = (
        F.when(F.col("delta_type") == ADDITION, F.col("curr_weight_pct"))
        .when(F.col("delta_type") == REMOVAL, F.col("prev_weight_pct"))
        .otherwise(F.abs("delta_weight_pct"))
    )
    return F.coalesce(size, F.lit(0)).cast("double")


def top_moves(moves: DataFrame, limits=None) -> DataFrame:
    """The largest moves per section with their ``place``, the section's total and the rest.

    Only the top rows of each task are shuffled, so a long section costs no more.
    """
    limits = {**DIGEST_LIMITS, **(limits or {})}
    largest = Window.partitionBy("delta_type").orderBy(
        move_size().desc(), "etf_ticker", "isin", "constituent_ticker")
    most = max(limits[name] for name in _LIMIT_OF.values())
    placed = moves.withColumn("place", F.row_number().over(largest)).filter(
        F.col("place") <= most)
    shown = F.lit(False)
    for kind, name in _LIMIT_OF.items():
        shown = shown | ((F.col("delta_type") == kind) & (F.col("place") <= limits[name]))
    totals = moves.groupBy("delta_type").agg(F.count(F.lit(1)).alias("total"))
    listed = placed.filter(shown).join(F.broadcast(totals), "delta_type")  # three kinds at most
    last = F.max("place").over(Window.partitionBy("delta_type"))
    return listed.withColumn("hidden", F.col("total") - last)


def _left(text, width) -> Column:
    return F.when(F.length(text) < width, F.rpad(text, width, " ")).otherwise(text)


def _right(text, width) -> Column:
    return F.when(F.length(text) < width, F.lpad(text, F.lit(width), F.lit(" "))).otherwise(text)


def move_lines(top: DataFrame) -> DataFrame:
    """A line of text per listed move: fund, label, weight and shares in aligned columns."""
    kind = F.col("delta_type")
    mark = F.when(kind == ADDITION, "+").when(kind == REMOVAL, "-").otherwise("")
    weight = F.coalesce(
        F.when(kind == ADDITION, F.col("curr_weight_pct"))
        .when(kind == REMOVAL, F.col("prev_weight_pct"))
        .otherwise(F.col("delta_weight_pct")).cast("double"), F.lit(0.0)) + 0.0
    moved = F.concat(F.when(weight >= 0, "+").otherwise(""), fixed(weight, 2), F.lit("% wt"))
    held = F.concat(_right(fixed(weight, 1), 4), F.lit("% wt"))
    shares = F.concat(short_shares("delta_shares"), F.lit(" shr"))
    figures = (
        F.when(kind == ADDITION, held)
        .when(kind == REMOVAL, F.concat(F.lit("was "), held))
        .otherwise(F.concat(_right(moved, 10), F.lit("  "), _right(shares, 9)))
    )
    section = Window.partitionBy("delta_type")  # holds the listed rows only
    lines = top.withColumns({
        "shown_label": F.concat(mark, label("constituent_name", "constituent_ticker")),
        "figures": figures,
    }).withColumns({
        "fund_width": F.max(F.length("etf_ticker")).over(section),
        "label_width": F.max(F.length("shown_label")).over(section),
    })
    text = F.concat(
        _left(F.col("etf_ticker"), F.col("fund_width")), F.lit("  "),
        _left(F.col("shown_label"), F.col("label_width")), F.lit("  "), F.col("figures"))
    return lines.select(
        F.col("delta_type").alias("section"), "place", "total", "hidden", text.alias("line"))


def top_signals(signals: DataFrame, limits=None) -> DataFrame:
    """The signals with the most funds."""
    limits = {**DIGEST_LIMITS, **(limits or {})}
    return signals.orderBy(F.desc("n_etfs"), "isin").limit(limits["signals"])


def signal_lines(signals: DataFrame, details: DataFrame, limits=None, per_part=1000) -> DataFrame:
    """A line per listed signal: its label, the winning direction, and the funds voting so.

    The funds of a signal that very many funds share continue on lines of further parts.
    """
    listed = top_signals(signals, limits)
    votes = consensus.details_of(listed, details)
    winners = consensus.funds_of_winning_side(votes, consensus.direction_votes(votes))
    funds = consensus.in_parts(winners, per_part).groupBy("isin", "arrow", "part").agg(
        F.array_join(F.sort_array(F.collect_list("etf_ticker")), ", ").alias("funds"))
    named = listed.select(
        "isin", "n_etfs", label("constituent_name", "constituent_ticker").alias("shown_label"))
    line = F.concat(F.col("shown_label"), F.lit(": wt "), F.col("arrow"), F.lit(" in "),
                    F.col("funds"))
    return named.join(funds, "isin").select("isin", "n_etfs", "part", line.alias("line"))


def header(summary: DataFrame, dates: DataFrame) -> DataFrame:
    """One row: the digest's title line, the line about what is compared, and the counts."""
    def count(name, mark):
        return F.when(F.col(name) > 0, F.concat(F.col(name).cast("string"), F.lit(mark)))

    newer = dates.select(day("as_of_date").alias("d")).scalar()
    older = dates.select(day("previous_date").alias("d")).scalar()
    return summary.select(
        newer.alias("as_of_day"), older.alias("previous_day"),
        F.concat(F.col("etfs_processed").cast("string"), F.lit(" ETFs")).alias("funds"),
        F.concat_ws(" · ",
                    count("total_additions", " add"), count("total_removals", " rm"),
                    count("total_significant_changes", " moves"),
                    count("total_cross_etf_signals", " cross-ETF")).alias("counts"),
    )
