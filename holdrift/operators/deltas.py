"""Position deltas between two snapshots of a fund."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdrift.fixed_values import WEIGHT_NOISE
from holdrift.functions.classify import is_trackable
from holdrift.operators.snapshots import CURRENT, FUND, PREVIOUS, rows_of_pairs

ADDITION, REMOVAL, CHANGE = "addition", "removal", "change"

_INPUT = [
    *FUND, "as_of_date", "constituent_ticker", "constituent_name", "isin",
    "shares_held", "market_value", "weight_pct", "instrument_type",
]
_MEASURES = ["shares_held", "market_value", "weight_pct"]
_LABELS = ["constituent_ticker", "constituent_name"]
EXACT = "decimal(28,6)"


def compared_rows(history: DataFrame, pairs: DataFrame) -> DataFrame:
    """Tracked rows of the compared snapshots with their ``delta_key``."""
    return rows_of_pairs(tracked_positions(history), pairs)


def _rollup(only: Column | None = None, prefix="") -> list[Column]:
    """Aggregates that sum up all lots of a position, over the rows where ``only`` holds."""
    def kept(value, also=None):
        tests = [t for t in (only, also) if t is not None]
        for test in tests:
            value = F.when(test, value)
        return value

    columns = [F.max(kept(F.col("as_of_date"))).alias(f"{prefix}as_of_date"),
               F.max(kept(F.col("isin"))).alias(f"{prefix}isin")]
    size = F.coalesce(F.col("market_value"), F.lit(0)).alias("size")
    for name in _LABELS:  # of the largest lot; lots of equal value are settled by the label
        largest = F.max(kept(F.struct(size, F.col(name)), also=F.col(name).isNotNull()))
        columns.append(largest[name].alias(prefix + name))
    for name in _MEASURES:
        columns.append(F.sum(kept(F.col(name))).alias(prefix + name))
    return columns


def exact_measures(rows: DataFrame) -> DataFrame:
    """Measures stored as doubles as decimals of six places, whose sums do not depend on an order.

    What a decimal of 28 digits cannot hold (infinite, not a number) is missing.
    """
    floating = [f.name for f in rows.schema.fields if f.name in _MEASURES and f.dataType.typeName() == "double"]
    return rows.withColumns({name: F.col(name).try_cast(EXACT) for name in floating})


def as_stored(deltas: DataFrame, like: DataFrame) -> DataFrame:
    """Measures and their differences as doubles where ``like`` stores doubles."""
    doubles = {f.name for f in like.schema.fields if f.dataType.typeName() == "double"}
    shown = {"shares_held": "shares", "market_value": "market_value", "weight_pct": "weight_pct"}
    return deltas.withColumns({
        prefix + name: F.col(prefix + name).cast("double") for stored, name in shown.items() if stored in doubles
        for prefix in ("prev_", "curr_", "delta_")})


def position_rollup(rows: DataFrame) -> DataFrame:
    """One row per position and snapshot side: lots of one security are summed first.

    Comparing single lots would report moves that never happened.
    """
    return rows.groupBy(*FUND, "pair_date", "side", "delta_key").agg(*_rollup())


def paired_positions(rows: DataFrame) -> DataFrame:
    """Both sides of each position in one row, from one pass and one shuffle.

    Positions without any key match nothing on the other side, so they stay apart by side.
    """
    apart = F.when(F.col("delta_key").isNull(), F.col("side"))
    return rows.groupBy(*FUND, "pair_date", "delta_key", apart.alias("apart")).agg(
        *_rollup(F.col("side") == CURRENT, "curr_"),
        *_rollup(F.col("side") == PREVIOUS, "prev_"),
    ).drop("apart")


def paired_positions_by_join(rows: DataFrame) -> DataFrame:
    """The same as ``paired_positions`` written as a full outer join of the two sides."""
    keys = [*FUND, "pair_date", "delta_key"]

    def one_side(side, prefix):
        rolled = position_rollup(rows.filter(F.col("side") == side)).drop("side")
        return rolled.select(
            *keys, *[F.col(c).alias(prefix + c) for c in rolled.columns if c not in keys])

    return one_side(CURRENT, "curr_").join(one_side(PREVIOUS, "prev_"), keys, "full_outer")


_MEASURED = ["as_of_date", "isin", *_LABELS, *_MEASURES]


def tracked_positions(history: DataFrame) -> DataFrame:
    """Tracked rows with their ``delta_key``, and only the columns that deltas need."""
    return history.select(*_INPUT).filter(is_trackable()).withColumn(
        "delta_key", F.coalesce("isin", "constituent_ticker"))


def consecutive_positions(rows: DataFrame, following: DataFrame, laid_out=False) -> DataFrame:
    """Every position of every snapshot beside the one before, from one shuffle of the rows.

    With ``laid_out`` the rows lie in buckets of positions already (``sources.layout``) and are not shuffled.

    ``rows`` have their ``delta_key``; ``following`` tells, per fund and date, the fund's ``previous_date``
    and ``next_date``. Lots are summed per position and date; the neighbours of a position in
    time tell whether the snapshots next to it hold it too. Positions without any key match nothing.
    """
    dated = rows.join(following, [*FUND, "as_of_date"])
    dated = dated if laid_out else dated.repartition(*FUND, "delta_key")
    placed = dated.groupBy(
        *FUND, "delta_key", F.col("as_of_date").alias("pair_date"), "previous_date", "next_date").agg(*_rollup())
    own = F.struct(*_MEASURED)
    in_time = Window.partitionBy(*FUND, "delta_key").orderBy("pair_date")
    keyed = F.col("delta_key").isNotNull()
    before, after = F.lag(own).over(in_time), F.lead("pair_date").over(in_time)
    placed = placed.withColumns({"own": own, "before": before, "after": after})
    held = keyed & (F.col("before.as_of_date") == F.col("previous_date"))
    none = F.lit(None).cast(placed.schema["own"].dataType)
    gone = F.col("next_date").isNotNull() & ~F.coalesce(keyed & (F.col("after") == F.col("next_date")), F.lit(False))
    sides = F.array(
        F.struct(F.col("pair_date"), F.col("own").alias("curr"), F.when(held, F.col("before")).alias("prev")),
        F.when(gone, F.struct(F.col("next_date").alias("pair_date"), none.alias("curr"), F.col("own").alias("prev"))))
    spread = placed.select(*FUND, "delta_key", F.explode(F.filter(sides, lambda side: side.isNotNull())).alias("side"))
    return spread.select(*FUND, "side.pair_date", "delta_key", *[
        F.col(f"side.{side}.{name}").alias(f"{side}_{name}") for side in ("curr", "prev") for name in _MEASURED])


def consecutive_deltas(history: DataFrame, following: DataFrame, universe: DataFrame) -> DataFrame:
    """Additions, removals and changes between all consecutive snapshots of every fund."""
    return deltas_of_positions(tracked_positions(history), following, universe)


def deltas_of_positions(positions: DataFrame, following: DataFrame, universe: DataFrame, laid_out=False) -> DataFrame:
    """The same for tracked rows that have their ``delta_key``."""
    paired = consecutive_positions(exact_measures(positions), following, laid_out)
    return with_vertical(as_stored(delta_rows(paired), positions), universe)


def delta_type() -> Column:
    return (
        F.when(F.col("prev_as_of_date").isNull(), ADDITION)
        .when(F.col("curr_as_of_date").isNull(), REMOVAL)
        .otherwise(CHANGE)
    )


def _difference(name) -> Column:
    return F.coalesce(F.col(f"curr_{name}"), F.lit(0)) - F.coalesce(
        F.col(f"prev_{name}"), F.lit(0))


def pct_change(current, previous) -> Column:
    """Percent change, only where the previous value is positive."""
    now, before = F.col(current).cast("double"), F.col(previous).cast("double")
    return F.when(before > 0, (now - before) / before * 100)


def delta_rows(paired: DataFrame) -> DataFrame:
    """Previous, current and difference of every measure, with the kind of delta."""
    return paired.select(
        *FUND, "pair_date",
        *[F.coalesce(f"curr_{c}", f"prev_{c}").alias(c) for c in [*_LABELS, "isin"]],
        "curr_as_of_date", "prev_as_of_date",
        delta_type().alias("delta_type"),
        "prev_weight_pct", "curr_weight_pct", _difference("weight_pct").alias("delta_weight_pct"),
        F.col("prev_shares_held").alias("prev_shares"),
        F.col("curr_shares_held").alias("curr_shares"),
        _difference("shares_held").alias("delta_shares"),
        pct_change("curr_shares_held", "prev_shares_held").alias("pct_change_shares"),
        "prev_market_value", "curr_market_value",
        _difference("market_value").alias("delta_market_value"),
    )


def with_vertical(deltas: DataFrame, universe: DataFrame) -> DataFrame:
    """Adds each fund's vertical; Spark broadcasts the dimension if its table is small."""
    return deltas.join(universe.select("etf_ticker", "commodity_vertical"), "etf_ticker", "left")


def position_deltas(history: DataFrame, pairs: DataFrame, universe: DataFrame) -> DataFrame:
    """Additions, removals and changes of every position between the paired snapshots."""
    return deltas_of_paired(tracked_positions(history), pairs, universe)


def deltas_of_paired(positions: DataFrame, pairs: DataFrame, universe: DataFrame) -> DataFrame:
    """The same for tracked rows that have their ``delta_key``; those in buckets of positions are not shuffled."""
    paired = paired_positions(exact_measures(rows_of_pairs(positions, pairs)))
    return with_vertical(as_stored(delta_rows(paired), positions), universe)


def is_material() -> Column:
    """A change moves shares, or weight beyond noise; a re-priced value alone is none."""
    shares = F.coalesce(F.col("delta_shares"), F.lit(0))
    moved = F.coalesce(F.col("delta_weight_pct"), F.lit(0)).cast("double")
    return (shares != 0) | (F.abs(moved) > WEIGHT_NOISE)


def moves(deltas: DataFrame) -> DataFrame:
    """Deltas worth listing: all additions and removals, and the material changes."""
    return deltas.filter((F.col("delta_type") != CHANGE) | is_material())
