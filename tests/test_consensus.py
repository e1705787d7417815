import random

import pytest

from holdrift.operators import consensus, digest
from tests.build import delta, deltas, rows

GROUPS = [["ALP", "ALP.X", "ALP.Y"], ["BET", "BET.X"], ["GAM.X", "GAM"]]
FUNDS = [fund for group in GROUPS for fund in group] + ["DEL", "EPS"]
ISIN = "XX0000000019"


def one(spark, given, groups=GROUPS):
    votes = consensus.details(deltas(spark, given), groups)
    return consensus.signals(votes).collect(), [r.etf_ticker for r in votes.collect()]


@pytest.mark.parametrize("groups", [GROUPS, None])
def test_votes_and_signals_of_random_deltas(spark, groups):
    """One vote per security and group, that of the listing named first; counted by hand."""
    rng = random.Random(11)
    isins = [f"XX00000000{k}7" for k in range(10, 30)]
    given = [delta(fund, isin, rng.choice([-0.5, 0.0, 0.5]), rng.choice(["change", "addition", "removal"]),
                   value=float(rng.randrange(-9, 9)))
             for isin in isins for fund in FUNDS if rng.random() < 0.4]
    votes = {}
    for row in given:
        group = next((g for g in groups or [] if row[0] in g), [row[0]])
        key, place = (row[1], group[0]), group.index(row[0])
        if key not in votes or place < votes[key][0]:
            votes[key] = (place, row)
    chosen = [row for _, row in votes.values()]
    details = consensus.details(deltas(spark, given), groups)
    assert rows(details, "isin", "etf_ticker") == sorted([(r[1], r[0]) for r in chosen], key=repr)
    wanted = []
    for isin in sorted({r[1] for r in chosen}):
        of = [r for r in chosen if r[1] == isin]
        wanted.append((isin, len(of), sum(r[5] > 0 for r in of), sum(r[5] < 0 for r in of),
                       sum(r[4] == "addition" for r in of), sum(r[4] == "removal" for r in of),
                       sum(r[7] for r in of)))
    signals = consensus.signals(details)
    assert rows(signals, "isin", "n_etfs", "n_etfs_weight_up", "n_etfs_weight_down", "n_etfs_added",
                "n_etfs_removed", "total_delta_market_value") == wanted
    for least in (1, 2, 4):
        assert consensus.converging(signals, least).count() == sum(w[1] >= least for w in wanted)


def test_groups_as_a_table(spark):
    """The last group of a fund decides, and its rank is its place there."""
    groups = [["A", "B", "C"], ["D", "B"], ["A", "E", "C"], [], ["F"]]
    assert rows(consensus.group_table(spark, groups)) == [
        ("A", "A", 0), ("B", "D", 1), ("C", "A", 2), ("D", "D", 0), ("E", "A", 1), ("F", "F", 0)]
    assert rows(consensus.group_table(spark, None)) == []


def test_rows_that_cannot_be_joined_do_not_vote(spark):
    signals, funds = one(spark, [delta("A", None), delta("A", ""), delta("A", "CASH")])
    assert signals == [] and funds == []


def test_counts_and_names(spark):
    [signal], _ = one(spark, [
        delta("A", ISIN, 0.5, "addition", name=None, value=None),
        delta("B", ISIN, -0.5, "removal", name="", value=-10.0),
        delta("C", ISIN, None, name="Second", value=4.0), delta("D", ISIN, 1.0, name="Third", value=1.0)])
    assert (signal.n_etfs, signal.n_etfs_added, signal.n_etfs_removed, signal.n_etfs_weight_up,
            signal.n_etfs_weight_down) == (4, 1, 1, 2, 1)
    assert signal.constituent_name == "Second" and signal.total_delta_market_value == -5.0


def test_collapsed_moves_stay_apart_by_kind(spark):
    from pyspark.sql import functions as F
    moves = deltas(spark, [
        delta("ALP.Y", ISIN, kind="addition"), delta("ALP", ISIN, kind="change"),
        delta("ALP.X", ISIN, kind="change"), delta("ALP", None, ticker="T"),
        delta("ALP.Y", "", ticker="T"), delta("DEL", None, ticker="T")]).withColumn(
        "source", F.lit("web_csv"))
    found = consensus.collapse_moves(moves, GROUPS)
    assert rows(found, "etf_ticker", "delta_type", "constituent_ticker") == sorted([
        ("ALP.Y", "addition", "HBM"), ("ALP", "change", "HBM"), ("ALP", "change", "T"),
        ("DEL", "change", "T")], key=repr)


def test_rescoped_signals_are_counted_again(spark):
    votes = consensus.details(deltas(spark, [
        delta(f, ISIN) for f in "ABC"] + [delta(f, "US0000000011") for f in "AB"]))
    signals = consensus.signals(votes)
    from pyspark.sql import functions as F
    scoped, kept = consensus.rescope(signals, votes, ~F.col("etf_ticker").isin("B"))
    assert rows(scoped, "isin", "n_etfs") == [(ISIN, 2)]
    assert rows(kept, "isin", "etf_ticker") == [(ISIN, "A"), (ISIN, "C")]


def test_directions(spark):
    votes = consensus.details(deltas(spark, [
        delta("A", ISIN, 1.0, shares=-5.0), delta("B", ISIN, -1.0, shares=5.0),
        delta("C", "US0000000011", -1.0, "addition", shares=5.0),
        delta("D", "US0000000011", -1.0, shares=0.0)]))
    assert rows(consensus.unit_directions(votes)) == [("US0000000011", 0, 0), (ISIN, 1, 1)]
    assert rows(consensus.direction_votes(votes)) == [("US0000000011", 1, 2, "↓"), (ISIN, 1, 1, "↑")]


def test_totals_equal_the_votes_behind_them(spark):
    from pyspark.sql import functions as F
    from workload import tables
    from holdrift.plans import views
    folder = "/root/testdata/sf0.001"
    found = views.daily_deltas(tables.holdings(spark, folder), tables.universe(spark, folder))
    votes = consensus.details(found, tables.CONFIG["cross_etf"]["equivalent_etf_groups"])
    summed = votes.groupBy("isin").agg(F.sum("delta_market_value").alias("v"), F.count("*").alias("n"))
    both = consensus.signals(votes).join(summed, "isin")
    assert both.filter("v <> total_delta_market_value OR n <> n_etfs").isEmpty()


def test_nested_votes_of_a_hot_security_are_split_and_whole(spark):
    given = [delta(f"F{i:04}", ISIN) for i in range(500)] + [delta("Z", "US0000000011")]
    votes = consensus.details(deltas(spark, given))
    nested = consensus.nested_details(votes, per_part=50).collect()
    hot = [r for r in nested if r.isin == ISIN]
    assert len(hot) == 10 and max(len(r.etf_details) for r in hot) < 100
    assert sorted(d.etf_ticker for r in hot for d in r.etf_details) == [f"F{i:04}" for i in range(500)]
    assert [len(r.etf_details) for r in nested if r.isin != ISIN] == [1]


def test_signal_lines(spark):
    votes = consensus.details(deltas(spark, [
        delta("A", ISIN, 1.0), delta("B", ISIN, 1.0), delta("C", ISIN, -1.0)]))
    [line] = digest.signal_lines(consensus.signals(votes), votes).collect()
    assert line.line == "Harbour Mills (HBM): wt ↑ in A, B"
