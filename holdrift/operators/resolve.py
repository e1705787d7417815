"""Missing ISINs, found by ticker or name among rows that state one.

A key counts only if all rows that carry it agree on the ISIN.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdrift.fixed_values import CASH_ISIN
from holdrift.functions.text import (
    base_ticker, is_isin, normal_country, normal_name, normal_ticker, strip,
)
from holdrift.plans.joins import join_side, local_table

FULL, PAIR, BASE, NAME = "full", "pair", "base", "name"
FORCED_PAIR, FORCED_TICKER, FORCED_NAME = "forced_pair", "forced_ticker", "forced_name"

# In order of trial: which table, which key of the row, and the name of the method.
_TRIALS = [
    (FORCED_PAIR, "_pair", "override_ticker_country"),
    (FORCED_TICKER, "_full", "override_ticker"),
    (FORCED_TICKER, "_base", "override_ticker"),
    (FORCED_NAME, "_name", "override_name"),
    (FULL, "_full", "ticker_full"),
    (PAIR, "_pair", "ticker_base_country"),
    (BASE, "_base", "ticker_base"),
    (NAME, "_name", "name"),
]

_IDENTITY = ["_full", "_name", "_country"]
_SPREAD = 1024

_OVERRIDES = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("isin", T.StringType()),
    T.StructField("place", T.IntegerType()),
])


def override_table(spark: SparkSession, config=None) -> DataFrame:
    """Operator settings ``by_ticker`` and ``by_name`` as rows; later ones win."""
    config = config or {}
    rows = [(kind, str(key), isin, place)
            for kind in ("by_ticker", "by_name")
            for place, (key, isin) in enumerate((config.get(kind) or {}).items())]
    return local_table(spark, rows, _OVERRIDES)


def _pair(base, country) -> Column:
    return F.concat(base, F.lit(":"), country)


def _keyed(*pairs) -> Column:
    return F.inline(F.array(*[
        F.struct(F.lit(table).alias("table"), key.alias("key")) for table, key in pairs]))


def forced_keys(overrides: DataFrame) -> DataFrame:
    """Lookup rows of the operator settings.

    ``TICKER:COUNTRY`` also holds for the whole key and for its root without country.
    """
    key = F.col("key")
    country = F.upper(strip(F.substring_index(key, ":", -1)))
    before = F.expr("left(key, length(key) - length(substring_index(key, ':', -1)) - 1)")
    with_country = F.when(key.contains(":"), _pair(normal_ticker(before), country))
    tickers = overrides.filter("kind = 'by_ticker'").select(
        "isin", "place", _keyed((FORCED_PAIR, with_country),
                                (FORCED_TICKER, base_ticker("key")),
                                (FORCED_TICKER, normal_ticker("key"))))
    names = overrides.filter("kind = 'by_name'").select(
        "isin", "place", _keyed((FORCED_NAME, normal_name("key"))))
    return tickers.unionByName(names).filter(F.col("key").isNotNull()).groupBy(
        "table", "key").agg(F.max_by("isin", "place").alias("isin"))


def crosswalk_state(rows: DataFrame) -> DataFrame:
    """Per key of holdings that state an ISIN the smallest and largest one: (table, key, low, high).

    Holdings name the same securities date after date: each distinct (ticker, name, country, ISIN) is
    taken once, combined before the shuffle, and all four kinds of key are built from it in one
    pass. So sorting for the smallest text grows with the securities, not with the rows.
    States of parts of the rows can be merged.
    """
    base, country = base_ticker("constituent_ticker"), normal_country("country")
    known = rows.filter(is_isin("isin") & (F.col("isin") != CASH_ISIN))
    distinct = known.select("constituent_ticker", "constituent_name", "country", "isin").distinct()
    keys = distinct.select("isin", _keyed(
        (FULL, normal_ticker("constituent_ticker")), (PAIR, _pair(base, country)), (BASE, base),
        (NAME, normal_name("constituent_name"))))
    return keys.filter(F.col("key").isNotNull()).groupBy("table", "key").agg(
        F.min("isin").alias("low"), F.max("isin").alias("high"))


def merged_states(states: DataFrame) -> DataFrame:
    """One state of the rows of several: the state of all of them, without reading them again."""
    return states.groupBy("table", "key").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def crosswalk_of(state: DataFrame) -> DataFrame:
    """Lookup rows of a state: (table, key, isin); ISIN NULL if the rows of a key disagree."""
    return state.select("table", "key", F.when(F.col("low") == F.col("high"), F.col("low")).alias("isin"))


def crosswalk(rows: DataFrame) -> DataFrame:
    """Lookup rows from holdings that state an ISIN: (table, key, isin); ISIN NULL if ambiguous."""
    return crosswalk_of(crosswalk_state(rows))


def isin_lookup(rows: DataFrame, overrides: DataFrame | None = None, state: DataFrame | None = None) -> DataFrame:
    """All lookup rows: operator settings and the crosswalk of the given holdings.

    ``state``: a kept crosswalk state of other holdings, which count as if they were given too.
    """
    own = crosswalk_state(rows)
    found = crosswalk_of(own if state is None else merged_states(own.unionByName(state)))
    return found if overrides is None else found.unionByName(forced_keys(overrides))


def _with_identity(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "_full": F.coalesce(normal_ticker("constituent_ticker"), F.lit("")),
        "_name": F.coalesce(normal_name("constituent_name"), F.lit("")),
        "_country": F.coalesce(normal_country("country"), F.lit("")),
    })


def answers(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """What the lookup says about each distinct (ticker, name, country) of the rows.

    Adds ``found_isin``, ``method`` and ``ambiguous``, the number of keys skipped on the
    way because their ISINs disagree.
    """
    identities = _with_identity(rows).select(*_IDENTITY).distinct()
    base = F.coalesce(base_ticker("_full"), F.lit(""))
    keys = identities.withColumns({
        "_base": base,
        "_pair": F.when((base != "") & (F.col("_country") != ""), _pair(base, F.col("_country"))),
    })
    trials = F.array(*[
        F.struct(F.lit(i).alias("trial"), F.lit(table).alias("table"), F.col(key).alias("key"),
                 F.lit(method).alias("method"))
        for i, (table, key, method) in enumerate(_TRIALS)])
    asked = keys.select(*_IDENTITY, F.inline(trials)).filter(F.coalesce("key", F.lit("")) != "")
    hits = asked.join(lookup, ["table", "key"])
    first = F.min(F.when(F.col("isin").isNotNull(), F.struct("trial", "isin", "method")))
    skipped = F.sort_array(F.collect_list(F.when(F.col("isin").isNull(), F.col("trial"))))
    best = hits.groupBy(*_IDENTITY).agg(first.alias("first"), skipped.alias("skipped"))
    before = F.filter("skipped", lambda t: F.col("first").isNull() | (t < F.col("first.trial")))
    return best.select(
        *_IDENTITY, F.col("first.isin").alias("found_isin"), F.col("first.method").alias("method"),
        F.size(before).alias("ambiguous"))


def resolved(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds ``found_isin``, ``method`` and ``ambiguous`` to rows that lack an ISIN.

    Each distinct identity is looked up once. Rows that need nothing get a spread key, so
    they do not pile up in one task when the join back has to shuffle.
    """
    needs = F.col("isin").isNull() & (
        (F.coalesce("constituent_ticker", F.lit("")) != "")
        | (F.coalesce("constituent_name", F.lit("")) != ""))
    marked = rows.withColumn("_needs", needs)
    told = join_side(answers(marked.filter("_needs"), lookup)).withColumn("_spread", F.lit(-1))
    spread = F.when(F.col("_needs"), -1).otherwise(
        F.pmod(F.xxhash64(*rows.columns), F.lit(_SPREAD)).cast("int"))
    keyed = _with_identity(marked).withColumn("_spread", spread)
    joined = keyed.join(told, [*_IDENTITY, "_spread"], "left")
    return joined.drop(*_IDENTITY, "_spread").withColumnRenamed("_needs", "needed")


def fill_isins(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    filled = resolved(rows, lookup).withColumn("isin", F.coalesce("isin", "found_isin"))
    return filled.drop("found_isin", "method", "ambiguous", "needed")


def resolution_counts(resolved_rows: DataFrame) -> DataFrame:
    """One row per outcome: each method, plus ``resolved``, ``unresolved``, ``ambiguous``."""
    asked = resolved_rows.filter("needed")
    outcome = F.inline(F.array(
        F.struct(F.coalesce("method", F.lit("unresolved")).alias("outcome"),
                 F.lit(1).alias("n")),
        F.struct(F.when(F.col("method").isNotNull(), "resolved").alias("outcome"),
                 F.lit(1).alias("n")),
        F.struct(F.when(F.col("ambiguous") > 0, "ambiguous").alias("outcome"),
                 F.col("ambiguous").alias("n")),
    ))
    return asked.select("method", "ambiguous", outcome).filter(
        F.col("outcome").isNotNull()).groupBy("outcome").agg(F.sum("n").cast("long").alias("n_rows"))
