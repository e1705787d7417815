"""Which changes are large enough to report."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdrift.fixed_values import DEFAULT_CONFIG
from holdrift.operators.deltas import CHANGE
from holdrift.plans.joins import local_table

BANDS = ["min_weight_delta_bps", "min_share_pct_change", "min_value_delta_usd"]

_BAND_TABLE = T.StructType(
    [T.StructField("commodity_vertical", T.StringType())]
    + [T.StructField(band, T.DoubleType()) for band in BANDS]
)


def default_bands(config=None) -> dict:
    return (DEFAULT_CONFIG if config is None else config).get("defaults") or {}


def threshold_table(spark: SparkSession, config=None) -> DataFrame:
    """Bands of every vertical with settings of its own, defaults filled in.

    A band that is set nowhere is NULL, and no change reaches it.
    """
    config = DEFAULT_CONFIG if config is None else config
    rows = []
    for vertical, own in (config.get("overrides_by_vertical") or {}).items():
        bands = {**default_bands(config), **own}
        rows.append([vertical, *[None if bands.get(b) is None else float(bands[b]) for b in BANDS]])
    return local_table(spark, rows, _BAND_TABLE)


def min_converging(config=None) -> int:
    config = DEFAULT_CONFIG if config is None else config
    return (config.get("cross_etf") or {}).get("min_converging_etfs", 2)


def with_bands(deltas: DataFrame, config=None) -> DataFrame:
    """Adds the bands of each row's vertical, the defaults where it has none of its own."""
    own = threshold_table(deltas.sparkSession, config).withColumn("_own", F.lit(True))
    joined = deltas.join(own, "commodity_vertical", "left")
    usual = default_bands(config)
    picked = {
        band: F.when(F.col("_own"), F.col(band)).otherwise(F.lit(usual.get(band)).cast("double"))
        for band in BANDS
    }
    return joined.withColumns(picked).drop("_own")


def passes_bands() -> Column:
    """A change passes if its weight, share or value move reaches any band."""
    def size(name):
        return F.abs(F.coalesce(F.col(name).cast("double"), F.lit(0.0)))

    reached = (
        F.coalesce(size("delta_weight_pct") * 100 >= F.col(BANDS[0]), F.lit(False))
        | F.coalesce(size("pct_change_shares") >= F.col(BANDS[1]), F.lit(False))
        | F.coalesce(size("delta_market_value") >= F.col(BANDS[2]), F.lit(False))
    )
    return reached


def reportable(moves: DataFrame, config=None) -> DataFrame:
    """All additions and removals, and the changes that pass their bands."""
    kept = with_bands(moves, config).filter((F.col("delta_type") != CHANGE) | passes_bands())
    return kept.drop(*BANDS)
