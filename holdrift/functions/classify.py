"""What kind of instrument a holdings row is, and whether it is followed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdrift.fixed_values import (
    CASH, CASH_ISIN, CASH_WORDS, CURRENCY_CODES, CURRENCY_PAIR_PATTERN, CURRENCY_WORDS,
    DERIVATIVE, DERIVATIVE_WORDS, EQUITY, FX, LABEL_RULES, RESIDUAL, TRACKED_TYPES,
    UNTYPED_ROW_CURRENCY_CODES,
)
from holdrift.functions.text import blank_to_null, bound, contains_any, strip, strip_plain


def _label_rule(label) -> Column:
    """The type of the first rule whose text a stripped, lower-case label holds."""
    return F.coalesce(*[F.when(F.contains(label, F.lit(part)), kind) for part, kind in LABEL_RULES])


def label_type(c) -> Column:
    """Instrument type told by a provider's asset-class label, else NULL."""
    return bound(F.lower(strip(c)), _label_rule)


def with_instrument_type(df: DataFrame, label="asset_class") -> DataFrame:
    """Adds ``instrument_type``: the provider's label decides, else name, ticker and size."""
    label = F.col(label) if isinstance(label, str) else label
    ticker = F.coalesce(F.col("constituent_ticker"), F.lit(""))
    prepared = df.withColumn("_label", F.lower(strip_plain(label))).withColumns({
        "_by_label": _label_rule(F.col("_label")),
        "_words": F.lower(F.concat(
            F.coalesce(F.col("constituent_name"), F.lit("")), F.lit(" "), ticker)),
        "_code": F.upper(strip_plain(ticker)),
        "_has_isin": F.coalesce(blank_to_null("isin") != CASH_ISIN, F.lit(False)),
    })
    words, code, has_isin = F.col("_words"), F.col("_code"), F.col("_has_isin")
    no_size = (F.coalesce(F.col("weight_pct"), F.lit(0)) == 0) & (
        F.coalesce(F.col("market_value"), F.lit(0)) == 0)
    kind = (
        F.when(F.col("_by_label").isNotNull(), F.col("_by_label"))
        .when(contains_any(words, CASH_WORDS), CASH)
        .when(contains_any(words, DERIVATIVE_WORDS), DERIVATIVE)
        .when(~has_isin & (code.isin(CURRENCY_CODES) | contains_any(words, CURRENCY_WORDS)), FX)
        .when(~has_isin & (code == ""), RESIDUAL)
        .when(no_size, DERIVATIVE)
        .otherwise(EQUITY)
    )
    return prepared.withColumn("instrument_type", kind).drop(
        "_label", "_by_label", "_words", "_code", "_has_isin")


def is_tracked_type(c="instrument_type") -> Column:
    return F.coalesce(F.col(c).isin(TRACKED_TYPES), F.lit(False))


def is_currency_pair_name(c="constituent_name") -> Column:
    """A name such as ``EUR/USD``: a currency forward, never a holding."""
    return F.upper(F.trim(F.coalesce(F.col(c), F.lit("")))).rlike(CURRENCY_PAIR_PATTERN)


def is_tracked_untyped() -> Column:
    """The test for stored rows without a type: has a key, is no cash or currency, has size."""
    key = F.coalesce("isin", "constituent_ticker")
    bare_currency = F.col("isin").isNull() & F.upper(F.trim("constituent_ticker")).isin(
        UNTYPED_ROW_CURRENCY_CODES)
    no_size = (F.coalesce(F.col("weight_pct"), F.lit(0)) == 0) & (
        F.coalesce(F.col("market_value"), F.lit(0)) == 0)
    return F.coalesce(key.isNotNull() & (key != CASH_ISIN) & ~bare_currency & ~no_size,
                      F.lit(False))


def is_trackable() -> Column:
    """Whether a stored row takes part in deltas."""
    by_type = F.when(F.col("instrument_type").isNotNull(), is_tracked_type()).otherwise(
        is_tracked_untyped())
    return by_type & ~is_currency_pair_name()
