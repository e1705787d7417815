"""Kept views after appends, restatements and pauses are those of a full run."""

import pytest

from holdrift.plans import incremental_views as kept
from holdrift.plans import views
from holdrift.sources.ledger import dates_of
from tests.build import DAY, history, position, rows, universe

CONFIG = {"defaults": {"min_weight_delta_bps": 1, "min_share_pct_change": 5.0, "min_value_delta_usd": 10},
          "cross_etf": {"min_converging_etfs": 2, "equivalent_etf_groups": [["A", "A2"]]}}
X, Y, Z = "US0000000011", "US0000000029", "US0000000037"
START = [
    position("A", 1, "X", 1, isin=X), position("A", 2, "X", 2, 300.0, isin=X), position("A", 2, "Y", 1, isin=Y),
    position("A2", 1, "X", 1, isin=X), position("A2", 2, "X", 5, 900.0, isin=X),
    position("B", 1, "X", 1, isin=X), position("B", 2, "X", 4, 100.0, 3.0, isin=X), position("B", 2, "Z", 4, isin=Z),
    position("C", 1, "Y", 1, isin=Y), position("C", 2, "Y", 7, 10.0, 0.5, isin=Y), position("C", 2, "Z", 7, isin=Z)]
FUNDS = [("A", "gold"), ("A2", "gold"), ("B", "copper"), ("C", "gold"), ("P", "gold", False)]


@pytest.fixture(autouse=True)
def few_tasks(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def same(spark, view, table, funds, pinned, tables=("moves", "signals")):
    whole = (views.aligned_view if pinned else views.latest_view)(table, funds, CONFIG)
    found = kept.flow(view, funds, CONFIG)
    for name in tables:
        assert rows(getattr(found, name), *getattr(whole, name).columns) == rows(getattr(whole, name)), name
    return whole


@pytest.mark.parametrize("pinned", [False, True])
def test_adds_restatements_and_pauses(spark, tmp_path, pinned):
    table, funds = history(spark, START), universe(spark, FUNDS)
    view = kept.kept_view(table, funds, dates_of(table), CONFIG, pinned=pinned)
    kept.write_view(view, str(tmp_path), 0)
    view = kept.read_view(spark, str(tmp_path), 0)

    # One fund adds a date: only it is computed, and only securities of its votes.
    more = START + [position("B", 3, "X", 9, 100.0, 3.0, isin=X), position("B", 3, "N", 1)]
    table = history(spark, more)
    update = kept.updated(view, table, funds, dates_of(table), CONFIG, pinned=pinned)
    assert rows(update.funds) == ([] if pinned else [("B",)])
    assert rows(update.isins) == ([] if pinned else [(X,), (Z,)])

    # A member of a listing group adds a date: the other member may vote now. Rows of a fund are
    # restated at the same date, another fund's rows are gone, and a fund is paused.
    more = more + [position("A", 4, "Y", 1, isin=Y), position("C", 4, "Y", 7, 10.0, 0.5, isin=Y)]
    table = history(spark, [dict(p, shares_held=50.0) if p["etf_ticker"] == "C" else p for p in more if p["etf_ticker"] != "A2"])
    paused = universe(spark, [("B", "copper", False)] + [f for f in FUNDS if f[0] != "B"])
    update = kept.updated(update.view, table, paused, dates_of(table), CONFIG, pinned=pinned,
                          restated=spark.createDataFrame([("C",)], "etf_ticker string"))
    assert ("C",) in rows(update.funds) and ("A2",) in rows(update.funds)
    same(spark, update.view, table, paused, pinned)

    # It is resumed; and where nothing is new, nothing is computed.
    update = kept.updated(update.view, table, funds, dates_of(table), CONFIG, pinned=pinned)
    same(spark, update.view, table, funds, pinned, views.Flow._fields)
    again = kept.updated(update.view, table, funds, dates_of(table), CONFIG, pinned=pinned)
    assert again.funds.count() == 0 and again.isins.count() == 0


def test_from_an_empty_history(spark):
    funds, empty = universe(spark, FUNDS), history(spark, [])
    view = kept.kept_view(empty, funds, dates_of(empty), CONFIG)
    assert rows(kept.flow(view, funds, CONFIG).signals) == []
    table = history(spark, START)
    update = kept.updated(view, table, funds, dates_of(table), CONFIG)
    assert update.funds.count() == 4
    same(spark, update.view, table, funds, False)


def test_only_changed_funds_are_read(spark):
    """The deltas of other funds stay, whatever the history says of them by now."""
    table, funds = history(spark, START), universe(spark, FUNDS)
    view = kept.kept_view(table, funds, dates_of(table), CONFIG)
    tampered = history(spark, [dict(p, shares_held=1000.0) for p in START] + [position("B", 3, "X", 9, isin=X)])
    update = kept.updated(view, tampered, funds, dates_of(tampered), CONFIG)
    assert rows(update.view.deltas.filter("etf_ticker <> 'B'")) == rows(view.deltas.filter("etf_ticker <> 'B'"))
    assert rows(update.view.deltas.filter("etf_ticker = 'B' AND curr_as_of_date IS NOT NULL"), "curr_as_of_date") == [(DAY[3],)]
