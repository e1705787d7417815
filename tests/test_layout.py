"""Positions in buckets: the same deltas, without a shuffle of the rows."""

from pyspark.sql import functions as F

from holdrift.plans import views
from holdrift.sources import history as store
from holdrift.sources import layout, ledger
from tests.build import DAY, history, position, rows, universe
from workload import tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [line for line in plan(df).split("\n") if "Exchange" in line and "BroadcastExchange" not in line]


def test_no_exchange_of_stored_positions(spark, tmp_path):
    table, funds = store.with_history_columns(tables.holdings(spark, FOLDER)), tables.universe(spark, FOLDER)
    positions, dates = layout.write_positions(table, "positions_plain", str(tmp_path / "p"), 7), ledger.dates_of(table)
    whole, daily = layout.history_deltas(positions, funds, dates), layout.daily_deltas(positions, funds, dates)
    assert "Window" in plan(whole) and exchanges(whole) == [] and exchanges(daily) == []
    assert rows(whole) == rows(views.history_deltas(table, funds))
    assert rows(daily) == rows(views.daily_deltas(table, funds))


def test_append_and_reopen(spark, tmp_path):
    funds, folder = universe(spark, [("A", "gold")]), str(tmp_path / "p")
    first = history(spark, [position("A", 1, "X", 1, isin="US0000000011"), position("A", 1, None, 2), position("A", 1, "C", 1, kind="cash")])
    later = history(spark, [position("A", 2, "X", 3, isin="US0000000011"), position("A", 3, "C", 1, kind="cash")])
    layout.write_positions(first, "positions_appended", folder, 3)
    layout.write_positions(later, "positions_appended", folder, 3, mode="append")
    spark.sql("DROP TABLE positions_appended")  # the folder stays
    positions = layout.open_positions(spark, "positions_again", folder, 3, first)
    whole = first.unionByName(later)
    found = layout.history_deltas(positions, F.broadcast(funds), ledger.dates_of(whole))
    assert exchanges(found) == []
    # On day 3 the fund holds only cash: everything is removed.
    assert (DAY[3], "removal") in rows(found, "pair_date", "delta_type")
    assert rows(found) == rows(views.history_deltas(whole, funds))


def test_empty(spark, tmp_path):
    empty = store.empty_history(spark)
    positions = layout.write_positions(empty, "positions_empty", str(tmp_path / "p"), 3)
    assert rows(layout.history_deltas(positions, universe(spark, []), ledger.dates_of(empty))) == []
