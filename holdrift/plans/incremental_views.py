"""Views kept up to date: after an append only what it changes is computed.

A kept view holds what a full run would compute, in tables: which snapshots are compared, the deltas of every
fund, the votes, the signals, and the listed moves. An update finds the funds whose compared
snapshots differ from those kept. Their old deltas go out and new ones come in, read from the
history for these funds and dates alone. The votes and listed moves of their listing groups are retracted and
made anew, as a group shows one of its funds. Signals are computed again only for the securities
in whose votes anything was retracted or added.

A fund that is paused or resumed keeps its place in the kept view; it is left out when the view is read
(``flow``), as in a full run. In the aligned view it may move the pinned date, which changes the
compared snapshots of other funds, and those are updated.

Kept views are written as a new version, and the version a reader has stays whole.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdrift.fixed_values import DEFAULT_SOURCE
from holdrift.operators import consensus, coverage, deltas, snapshots, thresholds
from holdrift.operators.snapshots import FUND
from holdrift.plans import views
from holdrift.plans.joins import join_side, settled


class KeptView(NamedTuple):
    pairs: DataFrame    # etf_ticker, source, as_of_date, pair_date, side: the compared snapshots
    deltas: DataFrame   # every compared position
    votes: DataFrame    # one vote per security and listing group
    signals: DataFrame  # one row per security with votes
    moves: DataFrame    # listed moves, one per group


class Update(NamedTuple):
    view: KeptView
    funds: DataFrame    # etf_ticker: whose deltas were computed
    isins: DataFrame    # isin: whose signals were computed


def _pairs(dates: DataFrame, source, pinned: bool, universe) -> DataFrame:
    """Which snapshots a view compares: the latest, or those up to the date all active funds have reached."""
    known = snapshots.snapshot_dates(dates, source)
    if pinned:
        latest = snapshots.latest_date_per_fund(known)
        known = views.dates_up_to(known, snapshots.aligned_date(latest, coverage.paused(universe)))
    return snapshots.latest_pairs(known)


def _groups(config):
    return ((config or {}).get("cross_etf") or {}).get("equivalent_etf_groups")


def _listed(found: DataFrame, config) -> DataFrame:
    return consensus.collapse_moves(thresholds.reportable(deltas.moves(found), config), _groups(config))


def kept_view(history, universe, dates, config=None, source=DEFAULT_SOURCE, pinned=False) -> KeptView:
    """A view computed in full. ``dates``: the dates index of the history; ``pinned``: the aligned view."""
    pairs = settled(_pairs(dates, source, pinned, universe))
    found = settled(deltas.position_deltas(history, pairs, universe).drop("pair_date"))
    votes = settled(consensus.details(found, _groups(config)))
    return KeptView(pairs, found, votes, settled(consensus.signals(votes)), settled(_listed(found, config)))


def changed_funds(kept: DataFrame, pairs: DataFrame, restated: DataFrame | None = None) -> DataFrame:
    """Funds of which the kept and the present compared snapshots differ, and those restated: etf_ticker."""
    columns = [*FUND, "as_of_date", "pair_date", "side"]
    both = kept.select(*columns, F.lit(1).alias("n")).unionByName(pairs.select(*columns, F.lit(-1).alias("n")))
    differing = both.groupBy(*columns).agg(F.sum("n").alias("n")).filter(F.col("n") != 0).select("etf_ticker")
    if restated is not None:
        differing = differing.unionByName(restated.select("etf_ticker"))
    return differing.distinct()


def updated(kept: KeptView, history, universe, dates, config=None, source=DEFAULT_SOURCE, pinned=False,
            restated: DataFrame | None = None) -> Update:
    """A kept view after the history has changed.

    ``restated``: funds (etf_ticker) whose stored rows or whose entry in the universe have changed
    without a new date.
    """
    groups = _groups(config)
    pairs = settled(_pairs(dates, source, pinned, universe))
    funds = join_side(changed_funds(kept.pairs, pairs, restated))
    fresh = settled(deltas.position_deltas(history, pairs.join(funds, "etf_ticker", "left_semi"), universe).drop("pair_date"))
    found = settled(kept.deltas.join(funds, "etf_ticker", "left_anti").unionByName(fresh))

    touched_groups = join_side(consensus.with_group(funds, groups).select("group_key").distinct())
    members = consensus.with_group(found, groups).join(touched_groups, "group_key", "left_semi").select(found.columns)
    retracted = kept.votes.join(touched_groups, "group_key", "left_semi")
    added = settled(consensus.details(members, groups))
    votes = settled(kept.votes.join(touched_groups, "group_key", "left_anti").unionByName(added))

    isins = join_side(_changed_isins(retracted, added))
    counted = consensus.signals(votes.join(isins, "isin", "left_semi"))
    signals = settled(kept.signals.join(isins, "isin", "left_anti").unionByName(counted))
    others = consensus.with_group(kept.moves, groups).join(touched_groups, "group_key", "left_anti").select(kept.moves.columns)
    moves = settled(others.unionByName(_listed(members, config)))
    return Update(KeptView(pairs, found, votes, signals, moves), funds, isins)


def _changed_isins(retracted: DataFrame, added: DataFrame) -> DataFrame:
    """Securities with a vote that was retracted and not added again just the same, or the other way round."""
    columns = consensus.DETAIL_COLUMNS
    both = retracted.select(*columns, F.lit(1).alias("n")).unionByName(added.select(*columns, F.lit(-1).alias("n")))
    return both.groupBy(*columns).agg(F.sum("n").alias("n")).filter(F.col("n") != 0).select("isin").distinct()


def flow(kept: KeptView, universe, config=None) -> views.Flow:
    """The kept view as a full run reports it: with thresholds and without paused funds."""
    signals = consensus.converging(kept.signals, thresholds.min_converging(config))
    whole = views.Flow(kept.deltas, kept.moves, signals, consensus.details_of(signals, kept.votes))
    return views.scoped(whole, drop=coverage.paused(universe))


def write_view(kept: KeptView, folder: str, version: int) -> None:
    """Writes all tables of a kept view as one version; a version is written once."""
    for name, table in kept._asdict().items():
        table.write.mode("errorifexists").parquet(f"{folder}/version={version}/{name}")


def read_view(spark: SparkSession, folder: str, version: int) -> KeptView:
    return KeptView(*(spark.read.parquet(f"{folder}/version={version}/{name}") for name in KeptView._fields))
