from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdrift.functions import display, text


def values(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("r")).collect()]


def test_clean_text(spark):
    got = values(spark, text.clean_text, [" a b ", "-", "N/A", "nan", " ", None, "NULL", " x "])
    assert got == ["a b", None, None, None, None, None, None, "x"]


def test_parse_number(spark):
    told = {"1,234.5": 1234.5, "$5": 5.0, "12%": 12.0, "(3.5)": -3.5, "1e3": 1000.0, "-": None,
            "N/A": None, "nan": None, "": None, "1d": None, "abc": None, "1_000": 1000.0,
            "($1,000)": -1000.0, " 7 ": 7.0, "-2.": -2.0, ".5": 0.5, "1__0": None, "()": None,
            "+4": 4.0, "1 2": None}
    assert values(spark, text.parse_number, list(told)) == list(told.values())
    assert values(spark, text.parse_number, [None]) == [None]


def test_parse_date(spark):
    told = {"2026-06-12": date(2026, 6, 12), "03/04/2026": date(2026, 3, 4),
            "15/06/2026": date(2026, 6, 15), "12-Jun-2026": date(2026, 6, 12),
            "15-jun-26": date(2026, 6, 15), "31 May 2026": date(2026, 5, 31),
            "Jun 2, 2026": date(2026, 6, 2), "20260612": date(2026, 6, 12),
            "June 12, 2026": None, "2026-02-30": None, "12/Jun/2026": None, "": None,
            "1-Jan-70": date(1970, 1, 1), "2026-6-1": date(2026, 6, 1), "Jun 12 2026": None}
    assert values(spark, text.parse_date, list(told)) == list(told.values())


_FORMATS = ["%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%d-%b-%Y", "%d-%b-%y", "%d %b %Y", "%b %d, %Y",
            "%Y%m%d"]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.dates(date(1970, 1, 1), date(2068, 12, 31)),
                          st.sampled_from(_FORMATS)), min_size=50, max_size=80))
def test_parse_date_as_first_fitting_format(spark, stated):
    texts = [day.strftime(form) for day, form in stated]

    def expected(value):
        for form in _FORMATS:
            try:
                return datetime.strptime(value, form).date()
            except ValueError:
                pass

    assert values(spark, text.parse_date, texts) == [expected(t) for t in texts]


def test_isins(spark):
    got = values(spark, text.clean_isin, ["us6516391066", "CASH", "cash", "US123", "-", None])
    assert got == ["US6516391066", "CASH", "CASH", None, None, None]


def test_tickers_and_names(spark):
    assert values(spark, text.base_ticker, ["FCX US", "bhp.ax", " eur au ", "", None, ".X", "A\tB"]) == [
        "FCX", "BHP", "EUR", None, None, None, "A"]
    assert values(spark, text.normal_name, ["Harbour Mills Corp.", "AB Co-Ltd S.A.", "Ltd", None]) == [
        "HARBOUR MILLS", "S A", None, None]


def test_search(spark):
    df = spark.createDataFrame([("ALP", None, "Harbour"), ("BET", "HBM", "Freeborn")],
                               "a string, b string, c string")
    assert df.filter(text.search("  harb", ["a", "b", "c"])).count() == 1
    assert df.filter(text.search("alp  harb", ["a", "b", "c"])).count() == 1
    assert df.filter(text.search("", ["a"])).count() == 2


def test_short_shares(spark):
    told = {1.26e9: "+1.3B", -2.5e6: "-2.5M", 12.5e6: "+12M", 13.5e6: "+14M", 1500.0: "+2K",
            2500.0: "+2K", 999.0: "+999", 0.0: "+0", -0.5: "-0"}
    assert values(spark, display.short_shares, list(told), "double") == list(told.values())
    assert values(spark, display.short_shares, [None], "double") == ["—"]


def test_halves_go_to_even_or_away(spark):
    numbers = [0.125, 0.375, -0.125, 2.5, 1.005, 2.675]
    assert values(spark, lambda c: display.fixed(c, 2), numbers, "double") == [
        f"{n:.2f}" for n in numbers]
    assert values(spark, lambda c: display.fixed_away(c, 2), numbers, "double") == [
        "0.13", "0.38", "-0.13", "2.50", "1.00", "2.67"]
    assert values(spark, lambda c: display.fixed_away(c, 0), [0.5, 1.5, 2.5], "double") == [
        "1", "2", "3"]


def test_shown(spark):
    assert values(spark, display.money, [1.25e6, -999.5, 2e9, 1500.0, None], "double") == [
        "+$1.25M", "−$1000", "+$2.00B", "+$1.5k", "—"]
    assert values(spark, display.signed_percent, [1.25, -0.5, None], "double") == [
        "+1.250%", "-0.500%", "—"]
    assert values(spark, lambda c: display.clip(c, 5), ["abcdef", "abcde", None]) == [
        "abcd…", "abcde", ""]
    assert values(spark, lambda c: display.label(c, F.lit("T")), [" A ", None]) == ["A (T)", " (T)"]
    assert values(spark, lambda c: display.label(c, F.lit(None)), ["A", None]) == ["A", "—"]
    assert values(spark, display.sign_class, [1.0, 0.0, -1.0, None], "double") == [
        "pos", "dim", "neg", "dim"]
