"""The views of a history: latest, aligned, or all consecutive snapshots."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdrift.fixed_values import DEFAULT_SOURCE
from holdrift.operators import consensus, coverage, deltas, snapshots, thresholds
from holdrift.plans.joins import join_side, settled


class Flow(NamedTuple):
    """What one view reports; every table is lazy."""

    deltas: DataFrame   # every compared position
    moves: DataFrame    # additions, removals and reported changes
    signals: DataFrame  # one row per security that several funds moved
    details: DataFrame  # the votes behind the signals

    def section(self, kind) -> DataFrame:
        return self.moves.filter(F.col("delta_type") == kind)

    def dates(self) -> DataFrame:
        return coverage.view_dates(self.deltas)

    def summary(self) -> DataFrame:
        """One row of counts over what is listed."""
        counts = coverage.move_summary(self.moves)
        total = self.signals.agg(F.count(F.lit(1)).alias("n"))
        return counts.withColumn("total_cross_etf_signals", total.scalar())


def _known_dates(history, dates, source, as_of=None) -> DataFrame:
    """Snapshot dates from a dates index, or else from a scan of the history."""
    return snapshots.snapshot_dates(history if dates is None else dates, source, as_of)


def daily_deltas(history, universe, source=DEFAULT_SOURCE, as_of=None, dates=None) -> DataFrame:
    """Deltas of every fund's two newest snapshots of a source, optionally up to a date.

    ``dates``: a dates index of the history (``sources.ledger``); without it the history is scanned for them.
    """
    dates = _known_dates(history, dates, source, as_of)
    found = deltas.position_deltas(history, snapshots.latest_pairs(dates), universe)
    return found.drop("pair_date")


def history_deltas(history, universe, source=DEFAULT_SOURCE, dates=None) -> DataFrame:
    """Deltas of all consecutive snapshots in one job; ``pair_date`` is the newer date."""
    dates = _known_dates(history, dates, source)
    return deltas.consecutive_deltas(history, join_side(snapshots.neighbouring_dates(dates)), universe)


def _groups(config):
    return ((config or {}).get("cross_etf") or {}).get("equivalent_etf_groups")


def computed(found: DataFrame, config=None) -> Flow:
    """Splits deltas into moves and signals, before any threshold."""
    votes = consensus.details(found, _groups(config))
    return Flow(found, deltas.moves(found), consensus.signals(votes), votes)


def with_thresholds(flow: Flow, config=None) -> Flow:
    kept = consensus.converging(flow.signals, thresholds.min_converging(config))
    return flow._replace(
        moves=thresholds.reportable(flow.moves, config),
        signals=kept,
        details=consensus.details_of(kept, flow.details),
    )


def reported(found: DataFrame, config=None, apply_thresholds=True) -> Flow:
    """The full run over deltas: moves, signals, thresholds, one row per listing group."""
    flow = computed(found, config)
    if apply_thresholds:
        flow = with_thresholds(flow, config)
    return flow._replace(moves=consensus.collapse_moves(flow.moves, _groups(config)))


def scoped(flow: Flow, keep=None, drop=None) -> Flow:
    """A flow of some funds only: those to keep, or all but those to drop (fund tables)."""
    kind, funds = ("left_semi", keep) if keep is not None else ("left_anti", drop)
    if funds is None:
        return flow
    funds = funds.select("etf_ticker")
    kept = flow.details.join(funds, "etf_ticker", kind)
    signals, details = consensus.rescope(flow.signals, kept, F.lit(True))
    return flow._replace(
        moves=flow.moves.join(funds, "etf_ticker", kind), signals=signals, details=details)


class Views(NamedTuple):
    latest: Flow
    aligned: Flow
    latest_stored: DataFrame
    aligned_date: DataFrame


def latest_view(history, universe, config=None, source=DEFAULT_SOURCE, dates=None) -> Flow:
    found = daily_deltas(history, universe, source, dates=dates)
    return scoped(reported(found, config), drop=coverage.paused(universe))


def _view(history, universe, config, dates, paused, keep) -> Flow:
    found = deltas.position_deltas(history, snapshots.latest_pairs(dates), universe).drop("pair_date")
    return scoped(reported(settled(found) if keep else found, config), drop=paused)


def dates_up_to(dates: DataFrame, pinned: DataFrame) -> DataFrame:
    limit = F.coalesce(pinned.scalar(), F.lit("9999-12-31").cast("date"))
    return dates.filter(F.col("as_of_date") <= limit)


def aligned_view(history, universe, config=None, source=DEFAULT_SOURCE, keep=False, dates=None) -> Flow:
    """The view in which every fund is pinned to a date all have reached."""
    dates, paused = settled(_known_dates(history, dates, source)), coverage.paused(universe)
    pinned = snapshots.aligned_date(snapshots.latest_date_per_fund(dates), paused)
    return _view(history, universe, config, dates_up_to(dates, pinned), paused, keep)


def both_views(history, universe, config=None, source=DEFAULT_SOURCE, keep=False, dates=None) -> Views:
    """Latest view, and the one in which every fund is pinned to a date all have reached.

    The snapshot dates are read once for both, from the dates index if one is given. Without any date the
    aligned view compares what the latest one does. With ``keep`` the deltas of each view are
    computed once and stored, for callers that use several of its tables.
    """
    dates = settled(_known_dates(history, dates, source))
    paused = coverage.paused(universe)
    latest_stored = snapshots.latest_date_per_fund(dates)
    pinned = snapshots.aligned_date(latest_stored, paused)
    return Views(
        latest=_view(history, universe, config, dates, paused, keep),
        aligned=_view(history, universe, config, dates_up_to(dates, pinned), paused, keep),
        latest_stored=latest_stored,
        aligned_date=pinned,
    )


def marked_votes(flow: Flow, stale: DataFrame) -> DataFrame:
    """(isin, etf_ticker, shown) of every voting fund; stale ones are shown with a star."""
    marks = stale.select("etf_ticker", F.lit("*").alias("mark"))
    return flow.details.join(marks, "etf_ticker", "left").select(
        "isin", "etf_ticker", F.concat("etf_ticker", F.coalesce("mark", F.lit(""))).alias("shown"))


def read_signals(flow: Flow, stale: DataFrame) -> DataFrame:
    """The consensus table for reading: counts, real unit directions, and stale votes."""
    marked = flow.details.join(
        stale.select("etf_ticker", F.lit(True).alias("stale")), "etf_ticker", "left")
    stale_votes = marked.groupBy("isin").agg(F.count_if("stale").alias("stale_funds"))
    units = consensus.unit_directions(flow.details)
    shown = F.coalesce(F.nullif("constituent_name", F.lit("")), "constituent_ticker")
    table = flow.signals.join(units, "isin").join(stale_votes, "isin")
    return coverage.sorted_table(table.withColumn("shown_name", shown), "n_etfs", then=["isin"])
