from pyspark.sql import functions as F

from holdrift.operators import deltas, snapshots, thresholds
from holdrift.plans import joins, views
from tests.build import DAY, history, position, rows, universe
from workload import tables

_SHOWN = ["etf_ticker", "constituent_ticker", "delta_type", "prev_shares", "curr_shares", "delta_shares"]


def sample(spark):
    return history(spark, [
        position("A", 1, "X", 10), position("A", 1, "Y", 5), position("A", 1, "OLD", 5),
        position("A", 3, "X", 7, isin="US0000000011"), position("A", 3, "X2", 8, isin="US0000000011", value=900.0),
        position("A", 3, "Y", 6),
        position("B", 2, "X", 4),
        position("A", 2, "X", 1, isin="US0000000011"), position("A", 2, "Y", 6, weight=3.0),
        position("A", 3, "CASHY", 6, kind="cash"),
    ])


def test_latest_two_snapshots_are_compared(spark):
    found = views.daily_deltas(sample(spark), universe(spark, [("A", "gold"), ("B", "copper")]))
    assert rows(found, *_SHOWN) == sorted([
        ("A", "X2", "change", 1.0, 15.0, 14.0),   # two lots are one position, the larger names it
        ("A", "Y", "change", 6.0, 6.0, 0.0),
        ("B", "X", "addition", None, 4.0, 4.0),   # a single snapshot is all additions
    ], key=repr)
    verticals = {r.etf_ticker: r.commodity_vertical for r in found.collect()}
    assert verticals == {"A": "gold", "B": "copper"}


def test_as_of_compares_earlier_snapshots(spark):
    found = views.daily_deltas(sample(spark), universe(spark, []), as_of=DAY[2])
    assert rows(found.filter("etf_ticker = 'A'"), "constituent_ticker", "delta_type") == sorted([
        ("OLD", "removal"), ("X", "addition"), ("X", "removal"), ("Y", "change")], key=repr)


def test_a_date_with_only_cash_is_a_snapshot(spark):
    table = history(spark, [position("A", 1, "X", 1), position("A", 2, "C", 1, kind="cash")])
    found = views.daily_deltas(table, universe(spark, []))
    assert rows(found, "constituent_ticker", "delta_type") == [("X", "removal")]


def test_positions_without_key_stay_apart(spark):
    table = history(spark, [position("A", 1, None, 1), position("A", 2, None, 1)])
    found = views.daily_deltas(table, universe(spark, []))
    assert rows(found, "delta_type") == [("addition",), ("removal",)]


def test_single_pass_equals_outer_join(spark):
    table = tables.holdings(spark, "/root/testdata/sf0.001")
    for make in (snapshots.latest_pairs, snapshots.consecutive_pairs):
        compared = deltas.compared_rows(table, make(snapshots.snapshot_dates(table)))
        one = deltas.delta_rows(deltas.paired_positions(compared))
        two = deltas.delta_rows(deltas.paired_positions_by_join(compared))
        assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_differences_and_kinds(spark):
    folder = "/root/testdata/sf0.001"
    found = views.history_deltas(tables.holdings(spark, folder), tables.universe(spark, folder))
    wrong = found.filter(
        (F.coalesce("curr_shares", F.lit(0)) - F.coalesce("prev_shares", F.lit(0)) != F.col("delta_shares"))
        | ((F.col("delta_type") == "addition") != F.col("prev_as_of_date").isNull())
        | ((F.col("delta_type") == "removal") != F.col("curr_as_of_date").isNull()))
    assert wrong.isEmpty()


def test_last_pair_of_history_is_the_latest_view(spark):
    folder = "/root/testdata/sf0.001"
    table, funds = tables.holdings(spark, folder), tables.universe(spark, folder)
    whole = views.history_deltas(table, funds)
    newest = snapshots.snapshot_dates(table, "web_csv").groupBy("etf_ticker").agg(
        F.max("as_of_date").alias("pair_date"))
    last = whole.join(newest, ["etf_ticker", "pair_date"], "left_semi").drop("pair_date")
    latest = views.daily_deltas(table, funds).select(*last.columns)
    assert latest.exceptAll(last).isEmpty() and last.exceptAll(latest).isEmpty()


def test_swapped_snapshots_swap_additions_and_removals(spark):
    table = tables.holdings(spark, "/root/testdata/sf0.001")
    pairs = joins.settled(snapshots.latest_pairs(snapshots.snapshot_dates(table)))
    swapped = pairs.withColumn("side", 1 - F.col("side"))

    def counts(pairs):
        found = deltas.delta_rows(deltas.paired_positions(deltas.compared_rows(table, pairs)))
        return {r[0]: r[1] for r in found.groupBy("delta_type").count().collect()}

    there, back = counts(pairs), counts(swapped)
    assert there["addition"] == back["removal"] and there["removal"] == back["addition"]
    assert there["change"] == back["change"]


def test_material_moves_and_bands(spark):
    table = history(spark, [
        position("A", 1, "STILL", 10, weight=1.0), position("A", 2, "STILL", 10, weight=1.0005, value=5e6),
        position("A", 1, "SMALL", 100, weight=1.0), position("A", 2, "SMALL", 101, weight=1.1),
        position("A", 1, "WEIGHT", 100, weight=1.0), position("A", 2, "WEIGHT", 101, weight=1.35),
        position("A", 1, "SHARES", 100, weight=1.0), position("A", 2, "SHARES", 106, weight=1.0),
        position("A", 1, "VALUE", 100, weight=1.0, value=0.0), position("A", 2, "VALUE", 101, weight=1.0, value=1e6),
        position("A", 1, "GOLD", 100, weight=1.0), position("A", 2, "GOLD", 101, weight=1.27),
        position("A", 2, "NEW", 1),
    ])
    config = {"defaults": {"min_weight_delta_bps": 25, "min_share_pct_change": 5.0,
                           "min_value_delta_usd": 1000000},
              "overrides_by_vertical": {"gold": {"min_weight_delta_bps": 30}}}
    found = deltas.moves(views.daily_deltas(table, universe(spark, [("A", "gold")])))
    assert "STILL" not in {r.constituent_ticker for r in found.collect()}
    kept = {r.constituent_ticker for r in thresholds.reportable(found, config).collect()}
    assert kept == {"WEIGHT", "SHARES", "VALUE", "NEW"}
    silver = found.withColumn("commodity_vertical", F.lit(None).cast("string"))
    kept = {r.constituent_ticker for r in thresholds.reportable(silver, config).collect()}
    assert kept == {"WEIGHT", "SHARES", "VALUE", "GOLD", "NEW"}
    assert rows(thresholds.reportable(found, {}), "constituent_ticker") == [("NEW",)]
