"""From raw provider rows to typed, classified holdings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdrift.fixed_values import CASH, CASH_ISIN, RAW_FIELDS
from holdrift.functions.classify import with_instrument_type
from holdrift.functions.text import (
    blank_to_null, bound, joined_digits, known_isin, known_text, signed_number, stated_date, strip_plain, without_signs,
)
from holdrift.operators.resolve import fill_isins
from holdrift.plans.joins import join_side

_TEXTS = ["constituent_ticker", "constituent_name", "sedol", "currency", "sector", "country",
          "asset_class"]
_APART = "currency"
_NUMBERS = ["shares_held", "market_value", "weight_pct"]


def canonical_columns(raw: DataFrame, keep=()) -> DataFrame:
    """Exactly the raw fields (after the columns to keep); missing ones are NULL text."""
    return raw.select(*keep, *[
        F.col(name) if name in raw.columns else F.lit(None).cast("string").alias(name)
        for name in RAW_FIELDS])


def cleaned(raw: DataFrame, batch, default_date=None) -> DataFrame:
    """Texts stripped, numbers and dates parsed, ISINs checked.

    Every step is a projection that names the values of the one before, so each value is computed once.
    In three of them one light column is computed by a higher-order function. Spark then compiles
    the other columns in small methods; within a whole stage they would make one method, too long
    for the JVM to compile. What a higher-order function holds is interpreted, so it holds little.
    """
    rows = canonical_columns(raw, batch)
    stated = {name for name in RAW_FIELDS if rows.schema[name].dataType.typeName() == "string"}
    bare = {name: f"_bare_{name}" for name in _NUMBERS if name in stated}

    def texts(value):
        return {name: bound(F.col(name), value) if name == _APART else value(F.col(name)) for name in _TEXTS}

    def stripped(text):
        return strip_plain(text.cast("string"))

    others = ["isin", *bare, *(["as_of_date"] if "as_of_date" in stated else [])]
    rows = rows.withColumns({**texts(stripped), **{name: stripped(F.col(name)) for name in others}})
    rows = rows.withColumns({
        **texts(known_text), "isin": F.upper(F.col("isin")),
        **{b: without_signs(F.col(name)) for name, b in bare.items()}})
    rows = rows.withColumns({b: strip_plain(F.col(b)) for b in bare.values()})
    rows = rows.withColumns({b: joined_digits(F.col(b)) for b in bare.values()})
    date = stated_date(F.col("as_of_date")) if "as_of_date" in stated else F.col("as_of_date")
    rows = rows.withColumns({
        **{name: signed_number(F.col(name), F.col(bare[name])) if name in bare else _number(name) for name in _NUMBERS},
        "isin": bound(F.col("isin"), known_isin),
        "as_of_date": F.coalesce(date, F.lit(default_date).cast("date"))})
    return rows.drop(*bare.values())


def _number(name) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def fractional_batches(rows: DataFrame, batch) -> DataFrame:
    """Batches whose weights are on a scale of 0 to 1 instead of 0 to 100."""
    totals = rows.groupBy(*batch).agg(
        F.sum("weight_pct").alias("total"), F.max("weight_pct").alias("largest"))
    return totals.filter(
        (F.col("total") > 0) & (F.col("total") <= 1.5) & (F.col("largest") <= 1.0)
    ).select(*batch)


def scaled_weights(rows: DataFrame, batch, stated: DataFrame | None = None) -> DataFrame:
    """Weights on the scale of 0 to 100.

    The scale is found by aggregation (over ``stated``, the same rows, if given), so that
    the rows of one large batch need not meet in one task; the few fractional batches then
    join back.
    """
    found = fractional_batches(rows if stated is None else stated, batch)
    marks = join_side(found).withColumn("_fraction", F.lit(True))
    marked = rows.join(marks, list(batch), "left")
    weight = F.when(F.col("_fraction"), F.col("weight_pct") * 100.0).otherwise(F.col("weight_pct"))
    return marked.withColumn("weight_pct", weight).drop("_fraction")


def has_identity() -> Column:
    return F.col("constituent_ticker").isNotNull() | F.col("isin").isNotNull()


def has_quantity() -> Column:
    return (F.col("weight_pct").isNotNull() | F.col("shares_held").isNotNull()
            | F.col("market_value").isNotNull())


def tag_cash(rows: DataFrame) -> DataFrame:
    """Cash rows without an ISIN get the cash mark as ISIN."""
    untagged = (F.col("instrument_type") == CASH) & blank_to_null("isin").isNull()
    return rows.withColumn("isin", F.when(untagged, CASH_ISIN).otherwise(F.col("isin")))


def normalised(raw: DataFrame, batch=("etf_ticker",), default_date=None, lookup=None,
               resolve_first=False) -> DataFrame:
    """Typed holdings with ``instrument_type`` and ``partial_row``.

    A batch is what one provider document holds. ``lookup`` (see ``isin_lookup``) fills
    missing ISINs, after classification or, with ``resolve_first``, before it.
    """
    # Documents differ in size by far, and cleaning a row costs much more than moving it. The
    # scale needs only the weights, which are read where they are.
    rows = cleaned(raw.hint("rebalance"), batch, default_date)
    if lookup is not None and resolve_first:
        rows = fill_isins(rows, lookup)
    rows = scaled_weights(rows, batch, stated=cleaned(raw, batch))
    rows = rows.filter(has_identity() | has_quantity())
    rows = rows.withColumn("partial_row", ~has_identity())
    rows = tag_cash(with_instrument_type(rows))
    if lookup is not None and not resolve_first:
        rows = fill_isins(rows, lookup)
    return rows
