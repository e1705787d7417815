import re

from pyspark.sql import functions as F

from holdrift.functions.text import clean_isin, clean_text, parse_date, parse_number
from holdrift.operators import normalise, resolve
from tests.build import rows

_RAW = ("etf_ticker string, constituent_ticker string, constituent_name string, isin string, "
        "weight_pct string, shares_held string, market_value string, country string, "
        "asset_class string, as_of_date string")


def raw(spark, given):
    names = [c.split()[0] for c in _RAW.split(", ")]
    return spark.createDataFrame([tuple(g.get(n) for n in names) for g in given], _RAW)


def test_batch(spark):
    found = normalise.normalised(raw(spark, [
        dict(etf_ticker="A", constituent_ticker=" bhp ", constituent_name="BHP", weight_pct="0.6", isin="au000000bhp4"),
        dict(etf_ticker="A", constituent_name="USD CASH", weight_pct="0.4", as_of_date="06/12/2026"),
        dict(etf_ticker="A", constituent_name="Disclaimer"),
        dict(etf_ticker="A", constituent_name="Vault", shares_held="5"),
        dict(etf_ticker="B", constituent_ticker="X", weight_pct="1.0", isin="bad"),
        dict(etf_ticker="B", constituent_ticker="Y", weight_pct="0.6"),
        dict(etf_ticker="C", constituent_ticker="NA", weight_pct="(2)"),
        dict(etf_ticker="D", constituent_ticker="Z", weight_pct="0"),
    ]))
    assert rows(found, "etf_ticker", "constituent_ticker", "isin", "weight_pct", "instrument_type",
                "partial_row") == sorted([
        ("A", "bhp", "AU000000BHP4", 60.0, "equity", False),
        ("A", None, "CASH", 40.0, "cash", True),
        ("A", None, None, None, "residual", True),
        ("B", "X", None, 1.0, "equity", False), ("B", "Y", None, 0.6, "equity", False),
        ("C", None, None, -2.0, "residual", True), ("D", "Z", None, 0.0, "derivative", False),
    ], key=repr)


def test_missing_columns_and_default_date(spark):
    table = spark.createDataFrame([("A", "X", 5.0, float("nan"))],
                                  "etf_ticker string, constituent_ticker string, weight_pct double, market_value double")
    [row] = normalise.normalised(table, default_date="2026-06-01").collect()
    assert (str(row.as_of_date), row.sedol, row.market_value, row.weight_pct) == (
        "2026-06-01", None, None, 5.0)


def test_order_of_resolving_and_classifying(spark):
    known = spark.createDataFrame(
        [("EUR", None, None, "AU0000EUR123")],
        "constituent_ticker string, constituent_name string, country string, isin string")
    given = raw(spark, [dict(etf_ticker="A", constituent_ticker="EUR", weight_pct="2")])
    lookup = resolve.isin_lookup(known)
    late = normalise.normalised(given, lookup=lookup)
    early = normalise.normalised(given, lookup=lookup, resolve_first=True)
    assert rows(late, "isin", "instrument_type") == [("AU0000EUR123", "fx")]
    assert rows(early, "isin", "instrument_type") == [("AU0000EUR123", "equity")]


_KNOWN = "constituent_ticker string, constituent_name string, country string, isin string"


def answers(spark, known, asked, overrides=None):
    known = spark.createDataFrame(known, _KNOWN)
    asked = spark.createDataFrame([(i, *a, None) for i, a in enumerate(asked)], "i int, " + _KNOWN)
    table = resolve.override_table(spark, overrides) if overrides else None
    found = resolve.resolved(asked, resolve.isin_lookup(known, table)).orderBy("i").collect()
    return [(r.found_isin, r.method, r.ambiguous or 0) for r in found], found


def test_cascade(spark):
    a, b, c = "US0000000011", "US0000000022", "US0000000033"
    got, _ = answers(spark, [
        ("FCX US", "Freeport Inc", "US", a), ("BHP.AX", "BHP Group", "AU", b), ("BHP LN", "BHP Group", "GB", c),
        ("X", "Same", None, a), ("Y", "Same", None, b), ("Z", None, None, "CASH"), ("Q", None, None, "bad"),
    ], [
        ("fcx us", None, None), ("FCX CN", None, None), ("BHP", None, "au "), ("BHP", None, None),
        (None, "freeport LTD.", None), ("BHP", "Freeport", None), (None, "SAME", None), ("Z", None, None),
        ("Q", None, None), (None, None, "US")])
    assert got == [
        (a, "ticker_full", 0), (a, "ticker_base", 0), (b, "ticker_base_country", 0), (None, None, 1),
        (a, "name", 0), (a, "name", 1), (None, None, 1), (None, None, 0), (None, None, 0), (None, None, 0)]


def test_overrides_come_first_and_later_ones_win(spark):
    a, b, c = "AU0000242318", "US0000000022", "US0000000033"
    overrides = {"by_ticker": {"SFR:AU": a, "BVR AU": b, "BVR": c, "TWO WORDS:AU": a},
                 "by_name": {"Bellavista Resources Ltd": c}}
    got, _ = answers(spark, [("SFR", None, "AU", b)], [
        ("SFR", None, "AU"), ("SFR", None, "CA"), ("BVR AU", None, None), ("BVR XX", None, None),
        (None, "BELLAVISTA resources", None), ("TWO", None, "AU")], overrides)
    assert got == [(a, "override_ticker_country", 0), (b, "ticker_full", 0), (b, "override_ticker", 0),
                   (c, "override_ticker", 0), (c, "override_name", 0), (a, "override_ticker", 0)]


def test_counts(spark):
    known = spark.createDataFrame([("A", None, None, "US0000000011"), ("B X", None, None, "US0000000022"),
                                   ("B Y", None, None, "US0000000033")], _KNOWN)
    asked = spark.createDataFrame([("A", None, None, None), ("B", None, None, None), ("A", None, None, "x"),
                                   (None, None, None, None)], _KNOWN)
    found = resolve.resolution_counts(resolve.resolved(asked, resolve.isin_lookup(known)))
    assert rows(found) == [("ambiguous", 1), ("resolved", 1), ("ticker_full", 1), ("unresolved", 1)]


def test_numbers_are_parsed_outside_of_higher_order_functions(spark):
    """What a higher-order function holds is interpreted for every row, which takes most of the time."""
    found = normalise.cleaned(raw(spark, [{"weight_pct": "5%"}]), ["etf_ticker"])
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"RLIKE\(_bare_(?:weight_pct|market_value|shares_held)#", text)) >= 3
    assert not re.search(r"RLIKE\(lambda x_\d+#\d+, \^\\d", text)


def test_cleaned_rows_equal_the_functions_of_single_texts(spark):
    spaces = [" ", "\t", "\n", "\u3000", "\xa0", "\x00", "\u2009 ", ""]
    cores = ["5", "$1,234.5%", "(3.5)", "( 7 )", "(-2", ")7", "51(", "1_000", "1__0", "nan", "-nan", "$inf", "1d", "0x1p3", "1e400", "\u0665",
             "N/A", "-", "none", "", "\u00e9t\u00e9", "us0378331005", "cash", "2/30/2026", "30/2/2026", "2026-06-01", "15 Jun 2026", "15-jun-69"]
    texts = [before + core + after for core in cores for before in spaces for after in spaces] + [None]
    table = spark.createDataFrame([("F", i, *[t] * 6) for i, t in enumerate(texts)], "etf_ticker string, i int, " + ", ".join(
        f"{name} string" for name in ["constituent_ticker", "currency", "isin", "weight_pct", "shares_held", "as_of_date"]))
    found = normalise.cleaned(table, ["i"])
    wanted = table.select("i", *[function(name).alias(name) for name, function in {
        "constituent_ticker": clean_text, "currency": clean_text, "isin": clean_isin, "weight_pct": parse_number,
        "shares_held": parse_number, "as_of_date": parse_date}.items()])
    assert rows(found, *wanted.columns) == rows(wanted)
    odd = found.join(table.select("i", F.col("weight_pct").alias("text")), "i").filter(F.col("text").isin(")7", "51(", "(3.5)"))
    assert rows(odd.distinct(), "text", "weight_pct") == [("(3.5)", -3.5), (")7", 7.0), ("51(", 51.0)]
