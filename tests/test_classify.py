from holdrift.fixed_values import (
    CASH, CASH_WORDS, CURRENCY_CODES, CURRENCY_WORDS, DERIVATIVE, DERIVATIVE_WORDS, EQUITY, FIXED_INCOME, FX,
    LABEL_RULES, RESIDUAL,
)
from holdrift.functions.classify import is_trackable, is_tracked_type, with_instrument_type

_SCHEMA = ("i int, constituent_ticker string, constituent_name string, isin string, "
           "weight_pct double, market_value double, asset_class string, instrument_type string")


def table(spark, rows):
    names = ["constituent_ticker", "constituent_name", "isin", "weight_pct", "market_value",
             "asset_class", "instrument_type"]
    return spark.createDataFrame(
        [(i, *[row.get(n) for n in names]) for i, row in enumerate(rows)], _SCHEMA)


SIZE = dict(weight_pct=2.0, market_value=50.0)


def types(spark, given):
    got = with_instrument_type(table(spark, given)).orderBy("i").collect()
    return [r.instrument_type for r in got]


def test_every_label_rule_and_the_first_of_several(spark):
    given = [dict(asset_class=f" Xx {text.upper()} yy", constituent_name="cash") for text, _ in LABEL_RULES]
    wanted = [next(kind for word, kind in LABEL_RULES if word in f"xx {text} yy") for text, _ in LABEL_RULES]
    pairs = [(LABEL_RULES[i], LABEL_RULES[j]) for i in range(len(LABEL_RULES)) for j in range(i)]
    given += [dict(asset_class=f"{later[0]} / {first[0]}") for later, first in pairs]
    wanted += [next(kind for word, kind in LABEL_RULES if word in f"{later[0]} / {first[0]}")
               for later, first in pairs]
    assert types(spark, given) == wanted


def test_every_word_of_a_name(spark):
    """Cash words come before derivative words, and those before currencies."""
    def kind(name):
        found = f"{name} ".lower()
        for words, told in ((CASH_WORDS, CASH), (DERIVATIVE_WORDS, DERIVATIVE), (CURRENCY_WORDS, FX)):
            if any(word in found for word in words):
                return told
        return EQUITY

    names = [f"Zz {word} Zz" for word in CASH_WORDS + DERIVATIVE_WORDS + CURRENCY_WORDS]
    names += [f"{a} {b}" for a in CURRENCY_WORDS[:5] for b in DERIVATIVE_WORDS + CASH_WORDS]
    given = [dict(constituent_name=name, constituent_ticker="", isin=None, **SIZE) for name in names]
    assert types(spark, given) == [kind(name) for name in names]


def test_currency_needs_a_row_without_isin(spark):
    isin = "XX0000000019"
    given = [dict(constituent_ticker=f" {code.lower()} ", **SIZE) for code in CURRENCY_CODES]
    given += [dict(constituent_ticker=code, isin=isin, **SIZE) for code in CURRENCY_CODES]
    given += [dict(constituent_ticker=CURRENCY_CODES[0], isin=value, **SIZE) for value in ("", "CASH")]
    n = len(CURRENCY_CODES)
    assert types(spark, given) == [FX] * n + [EQUITY] * n + [FX, FX]


def test_rows_told_by_key_and_size(spark):
    isin = "XX0000000019"
    given = [
        dict(constituent_name="Quiet Harbour", **SIZE),                          # neither ISIN nor ticker
        dict(constituent_name="Quiet Harbour", isin=isin, **SIZE),
        dict(constituent_ticker="QHB"), dict(constituent_ticker="QHB", weight_pct=0.0, market_value=0.0),
        dict(constituent_ticker="QHB", weight_pct=0.1), dict(constituent_ticker="QHB", market_value=-1.0),
        dict(asset_class="unheard of", constituent_ticker="QHB", **SIZE),
    ]
    assert types(spark, given) == [RESIDUAL, EQUITY, DERIVATIVE, DERIVATIVE, EQUITY, EQUITY, EQUITY]


def test_only_equities_are_tracked(spark):
    kinds = [EQUITY, CASH, FX, DERIVATIVE, FIXED_INCOME, RESIDUAL, None]
    got = table(spark, [dict(instrument_type=kind) for kind in kinds]).orderBy("i").select(is_tracked_type())
    assert [r[0] for r in got.collect()] == [True] + [False] * 6


def test_stored_rows_without_type(spark):
    rows = [
        (dict(constituent_ticker="QHB", weight_pct=1.0), True),
        (dict(constituent_ticker="QHB"), False),                                # no size
        (dict(constituent_ticker="QAR", weight_pct=1.0), False),                # currency
        (dict(constituent_ticker="QAR", isin="XX0000000019", weight_pct=1.0), True),
        (dict(isin="CASH", weight_pct=1.0), False),
        (dict(constituent_name="x", weight_pct=1.0), False),                    # no key
        (dict(constituent_ticker="A", constituent_name=" eur/usd ", weight_pct=1.0), False),
        (dict(constituent_ticker="A", constituent_name="EUR/USD", instrument_type="equity"), False),
        (dict(instrument_type="equity"), True),
        (dict(constituent_ticker="A", weight_pct=1.0, instrument_type="cash"), False),
    ]
    got = table(spark, [row for row, _ in rows]).orderBy("i").select(is_trackable()).collect()
    assert [r[0] for r in got] == [kept for _, kept in rows]
