"""Queries about deltas, consensus and views."""

from datetime import date

from pyspark.sql import functions as F

from holdrift.functions.classify import is_trackable
from holdrift.functions.text import search
from holdrift.operators import consensus, coverage, deltas, digest, snapshots, thresholds
from holdrift.plans import publish, views
from holdrift.sources.history import with_history_columns
from workload.registry import query
from workload.sql import MATERIAL, band, short_shares_sql, sql
from workload.tables import CONFIG, as_doubles, holdings, in_order, universe

GROUPS = CONFIG["cross_etf"]["equivalent_etf_groups"]
SOURCE = "web_csv"


def _dates(spark, folder):
    return snapshots.snapshot_dates(holdings(spark, folder), SOURCE)


def _deltas(spark, folder):
    return views.daily_deltas(holdings(spark, folder), universe(spark, folder))


def _aligned(spark, folder):
    return views.aligned_view(holdings(spark, folder), universe(spark, folder), CONFIG)


def _flow(spark, folder):
    return views.latest_view(holdings(spark, folder), universe(spark, folder), CONFIG)


def _views(spark, folder):
    return views.both_views(holdings(spark, folder), universe(spark, folder), CONFIG)


# --- snapshots ------------------------------------------------------------------------

@query("snapshot_dates", sql("SELECT etf_ticker, source, as_of_date FROM dates"))
def snapshot_dates(spark, folder):
    return _dates(spark, folder)


@query("ranked_snapshot_dates", sql("""
SELECT etf_ticker, source, as_of_date, dense_rank() OVER (PARTITION BY etf_ticker, source
       ORDER BY as_of_date DESC) AS date_rank FROM dates"""))
def ranked_snapshot_dates(spark, folder):
    return snapshots.ranked_dates(_dates(spark, folder))


@query("latest_pairs", sql("SELECT etf_ticker, source, as_of_date, pair_date, side FROM deltas_pairs"))
def latest_pairs(spark, folder):
    return snapshots.latest_pairs(_dates(spark, folder))


@query("consecutive_pairs",
       sql("SELECT etf_ticker, source, as_of_date, pair_date, side FROM deltas_all_pairs"))
def consecutive_pairs(spark, folder):
    return snapshots.consecutive_pairs(_dates(spark, folder))


@query("rows_of_latest_pairs", sql("""
SELECT h.etf_ticker, h.source, h.as_of_date, p.pair_date, p.side, h.constituent_ticker, h.isin,
       h.sedol, CAST(h.shares_held AS DOUBLE) AS shares_held
FROM holdings h JOIN deltas_pairs p USING (etf_ticker, source, as_of_date)"""))
def rows_of_latest_pairs(spark, folder):
    rows = snapshots.rows_of_pairs(
        holdings(spark, folder), snapshots.latest_pairs(_dates(spark, folder)))
    return as_doubles(rows.select(
        "etf_ticker", "source", "as_of_date", "pair_date", "side", "constituent_ticker", "isin",
        "sedol", "shares_held"))


@query("latest_date_per_fund", sql("SELECT etf_ticker, latest_stored FROM latest_stored"))
def latest_date_per_fund(spark, folder):
    return snapshots.latest_date_per_fund(_dates(spark, folder))


@query("aligned_date", sql("SELECT aligned_date FROM aligned"))
def aligned_date(spark, folder):
    latest = snapshots.latest_date_per_fund(_dates(spark, folder))
    return snapshots.aligned_date(latest, coverage.paused(universe(spark, folder)))


# --- deltas ---------------------------------------------------------------------------

@query("trackable_rows", sql("""
SELECT etf_ticker, as_of_date, constituent_ticker, constituent_name, isin, sedol, instrument_type
FROM tracked"""))
def trackable_rows(spark, folder):
    return holdings(spark, folder).filter(is_trackable()).select(
        "etf_ticker", "as_of_date", "constituent_ticker", "constituent_name", "isin", "sedol",
        "instrument_type")


@query("position_rollup", sql(
    "SELECT * REPLACE (CAST(shares_held AS DOUBLE) AS shares_held, CAST(market_value AS DOUBLE) "
    "AS market_value, CAST(weight_pct AS DOUBLE) AS weight_pct), 1 AS side FROM deltas_cur "
    "UNION ALL SELECT * REPLACE (CAST(shares_held AS DOUBLE) AS shares_held, CAST(market_value "
    "AS DOUBLE) AS market_value, CAST(weight_pct AS DOUBLE) AS weight_pct), 0 FROM deltas_prev"))
def position_rollup(spark, folder):
    rows = deltas.compared_rows(
        holdings(spark, folder), snapshots.latest_pairs(_dates(spark, folder)))
    return as_doubles(deltas.position_rollup(rows))


_ALL_BUT_PAIR = "SELECT * EXCLUDE (pair_date) FROM"


@query("daily_deltas", sql(f"{_ALL_BUT_PAIR} deltas"))
def daily_deltas(spark, folder):
    return as_doubles(_deltas(spark, folder))


@query("daily_deltas_of_stored_types", sql(f"{_ALL_BUT_PAIR} deltas"))
def daily_deltas_of_stored_types(spark, folder):
    """The same deltas from the types a history is stored in; double sums must not depend on an order."""
    return views.daily_deltas(with_history_columns(holdings(spark, folder)), universe(spark, folder))


@query("daily_deltas_as_of", sql(f"{_ALL_BUT_PAIR} deltas_2000"))
def daily_deltas_as_of(spark, folder):
    return as_doubles(views.daily_deltas(
        holdings(spark, folder), universe(spark, folder), as_of=date(2000, 5, 15)))


@query("daily_deltas_by_outer_join", sql(f"{_ALL_BUT_PAIR} deltas"))
def daily_deltas_by_outer_join(spark, folder):
    rows = deltas.compared_rows(
        holdings(spark, folder), snapshots.latest_pairs(_dates(spark, folder)))
    found = deltas.delta_rows(deltas.paired_positions_by_join(rows))
    return as_doubles(
        deltas.with_vertical(found, universe(spark, folder)).drop("pair_date"))


@query("history_deltas", sql("SELECT * FROM deltas_all"))
def history_deltas(spark, folder):
    return as_doubles(views.history_deltas(holdings(spark, folder), universe(spark, folder)))


_MOVE = "etf_ticker, delta_type, isin, constituent_ticker, delta_shares, delta_weight_pct"
_MOVE_COLUMNS = _MOVE.split(", ")


@query("material_moves", sql(
    f"SELECT {_MOVE} FROM deltas WHERE delta_type <> 'change' OR {MATERIAL}"))
def material_moves(spark, folder):
    return as_doubles(deltas.moves(_deltas(spark, folder)).select(*_MOVE_COLUMNS))


@query("threshold_bands", sql(
    "SELECT etf_ticker, commodity_vertical, " + ", ".join(
        f"{band(b)} AS {b}" for b in thresholds.BANDS) + " FROM universe"))
def threshold_bands(spark, folder):
    funds = universe(spark, folder).select("etf_ticker", "commodity_vertical")
    return thresholds.with_bands(funds, CONFIG)


@query("threshold_moves", sql(f"SELECT {_MOVE} FROM deltas_kept"))
def threshold_moves(spark, folder):
    kept = thresholds.reportable(deltas.moves(_deltas(spark, folder)), CONFIG)
    return as_doubles(kept.select(*_MOVE_COLUMNS))


@query("collapsed_moves", sql(f"SELECT {_MOVE} FROM deltas_listed"))
def collapsed_moves(spark, folder):
    flow = views.reported(_deltas(spark, folder), CONFIG)
    return as_doubles(flow.moves.select(*_MOVE_COLUMNS))


@query("view_dates", sql("SELECT max(curr_as_of_date) AS as_of_date, "
                         "max(prev_as_of_date) AS previous_date FROM deltas"))
def view_dates(spark, folder):
    return coverage.view_dates(_deltas(spark, folder))


_SUMMARY = """
SELECT count(*) FILTER (WHERE delta_type = 'addition') AS total_additions,
       count(*) FILTER (WHERE delta_type = 'removal') AS total_removals,
       count(*) FILTER (WHERE delta_type = 'change') AS total_significant_changes,
       count(DISTINCT etf_ticker) AS etfs_processed,
       (SELECT count(*) FROM {0}_scoped) AS total_cross_etf_signals FROM {0}_moves"""


@query("latest_summary", sql(_SUMMARY.format("deltas")))
def latest_summary(spark, folder):
    return _flow(spark, folder).summary()


@query("run_summary", sql(f"""
SELECT count(*) FILTER (WHERE delta_type = 'addition') AS total_additions,
       count(*) FILTER (WHERE delta_type = 'removal') AS total_removals,
       count(*) FILTER (WHERE delta_type = 'change' AND {MATERIAL}) AS total_significant_changes,
       count(DISTINCT etf_ticker) AS etfs_processed FROM deltas"""))
def run_summary(spark, folder):
    found = _deltas(spark, folder)
    return coverage.run_summary(found, deltas.moves(found))


@query("aligned_summary", sql(_SUMMARY.format("deltas_aligned")))
def aligned_summary(spark, folder):
    return _views(spark, folder).aligned.summary()


# --- consensus ------------------------------------------------------------------------

@query("listing_groups", sql("""
SELECT etf_ticker, coalesce(group_key, etf_ticker) AS group_key,
       coalesce(group_rank, 0) AS group_rank FROM universe LEFT JOIN listing USING (etf_ticker)"""))
def listing_groups(spark, folder):
    return consensus.with_group(universe(spark, folder).select("etf_ticker"), GROUPS)


_VOTE = ("isin, group_key, etf_ticker, constituent_ticker, constituent_name, delta_type, "
         "delta_weight_pct, delta_shares, delta_market_value")


@query("plain_signals_in_order", sql("""
SELECT isin, total_delta_market_value, row_number() OVER (
  ORDER BY abs(coalesce(total_delta_market_value, 0)) DESC, isin) AS place
FROM (SELECT isin, CAST(sum(CAST(delta_market_value AS DECIMAL(38,2))) AS DOUBLE) AS total_delta_market_value
      FROM deltas WHERE isin IS NOT NULL AND isin <> 'CASH' GROUP BY isin HAVING count(DISTINCT etf_ticker) >= 2)"""))
def plain_signals_in_order(spark, folder):
    found = consensus.by_value(consensus.plain_signals(_deltas(spark, folder)))
    return as_doubles(in_order(found)).select("isin", "total_delta_market_value", "place")


@query("plain_nested_votes", sql("""
SELECT isin, etf_ticker, delta_type, delta_weight_pct, delta_shares, delta_market_value FROM deltas
WHERE isin IN (SELECT isin FROM deltas WHERE isin <> 'CASH' GROUP BY isin HAVING count(DISTINCT etf_ticker) >= 2)"""))
def plain_nested_votes(spark, folder):
    nested = consensus.plain_nested_votes(_deltas(spark, folder), per_part=20)
    return as_doubles(nested.select("isin", F.inline("etf_details")))


@query("signal_votes", sql(f"SELECT {_VOTE} FROM deltas_votes"))
def signal_votes(spark, folder):
    return as_doubles(consensus.details(_deltas(spark, folder), GROUPS))


@query("signals", sql("SELECT * FROM deltas_signals"))
def signals(spark, folder):
    votes = consensus.details(_deltas(spark, folder), GROUPS)
    return as_doubles(consensus.signals(votes))


@query("signals_in_order", sql("""
SELECT isin, total_delta_market_value, row_number() OVER (
  ORDER BY abs(coalesce(total_delta_market_value, 0)) DESC, isin) AS place FROM deltas_signals"""))
def signals_in_order(spark, folder):
    votes = consensus.details(_deltas(spark, folder), GROUPS)
    return as_doubles(in_order(consensus.by_value(consensus.signals(votes)))).select(
        "isin", "total_delta_market_value", "place")


@query("signals_without_groups", sql("""
SELECT isin, min({'e': etf_ticker, 'l': constituent_name})['l'] AS constituent_name,
       min({'e': etf_ticker, 'l': constituent_ticker})
           FILTER (WHERE constituent_ticker IS NOT NULL)['l'] AS constituent_ticker,
       count(DISTINCT etf_ticker) AS n_etfs,
       count(*) FILTER (WHERE delta_weight_pct > 0) AS n_etfs_weight_up,
       count(*) FILTER (WHERE delta_weight_pct < 0) AS n_etfs_weight_down,
       count(*) FILTER (WHERE delta_type = 'addition') AS n_etfs_added,
       count(*) FILTER (WHERE delta_type = 'removal') AS n_etfs_removed,
       CAST(sum(CAST(delta_market_value AS DECIMAL(38,2))) AS DOUBLE) AS total_delta_market_value
FROM deltas WHERE isin IS NOT NULL AND isin NOT IN ('', 'CASH') GROUP BY isin"""))
def signals_without_groups(spark, folder):
    return as_doubles(consensus.signals(consensus.details(_deltas(spark, folder))))


@query("plain_signals", sql("""
SELECT isin, max(constituent_name) AS constituent_name, count(DISTINCT etf_ticker) AS n_etfs,
       count(*) FILTER (WHERE delta_weight_pct > 0) AS n_etfs_weight_up,
       count(*) FILTER (WHERE delta_weight_pct < 0) AS n_etfs_weight_down,
       count(*) FILTER (WHERE delta_type = 'addition') AS n_etfs_added,
       count(*) FILTER (WHERE delta_type = 'removal') AS n_etfs_removed,
       CAST(sum(CAST(delta_market_value AS DECIMAL(38,2))) AS DOUBLE) AS total_delta_market_value
FROM deltas WHERE isin <> 'CASH' GROUP BY isin HAVING count(DISTINCT etf_ticker) >= 2"""))
def plain_signals(spark, folder):
    return as_doubles(consensus.plain_signals(_deltas(spark, folder)))


@query("converging_signals", sql(
    "SELECT isin, n_etfs, total_delta_market_value FROM deltas_signals WHERE n_etfs >= 2"))
def converging_signals(spark, folder):
    flow = views.with_thresholds(views.computed(_deltas(spark, folder), CONFIG), CONFIG)
    return as_doubles(flow.signals.select("isin", "n_etfs", "total_delta_market_value"))


@query("moved_only_votes", sql(f"""
SELECT {_VOTE} FROM (SELECT d.*, etf_ticker AS group_key FROM deltas d)
WHERE isin IS NOT NULL AND isin NOT IN ('', 'CASH')
  AND NOT (delta_type = 'change' AND delta_shares = 0 AND delta_weight_pct = 0)"""))
def moved_only_votes(spark, folder):
    return as_doubles(consensus.details(_deltas(spark, folder), moved_only=True))


@query("nested_votes", sql("""
SELECT isin, count(*) AS n_votes,
       string_agg(etf_ticker || ':' || delta_type || ':' || CAST(delta_shares AS BIGINT), ' '
                  ORDER BY etf_ticker) AS votes FROM deltas_votes GROUP BY isin"""))
def nested_votes(spark, folder):
    nested = consensus.nested_details(
        consensus.details(_deltas(spark, folder), GROUPS), per_part=1_000_000)
    shown = F.transform("etf_details", lambda d: F.concat_ws(
        ":", d["etf_ticker"], d["delta_type"], d["delta_shares"].cast("bigint").cast("string")))
    return nested.select("isin", F.size("etf_details").cast("long").alias("n_votes"),
                         F.array_join(shown, " ").alias("votes"))


@query("nested_votes_in_parts", sql("""
SELECT isin, count(*) AS n_votes, min(etf_ticker) AS first_fund, max(etf_ticker) AS last_fund
FROM deltas_votes GROUP BY isin"""))
def nested_votes_in_parts(spark, folder):
    nested = consensus.nested_details(
        consensus.details(_deltas(spark, folder), GROUPS), per_part=8)
    funds = F.transform("etf_details", lambda d: d["etf_ticker"])
    return nested.groupBy("isin").agg(
        F.sum(F.size("etf_details")).alias("n_votes"),
        F.min(F.array_min(funds)).alias("first_fund"), F.max(F.array_max(funds)).alias("last_fund"))


@query("unit_directions", sql("""
SELECT isin, count(*) FILTER (WHERE delta_type = 'change' AND delta_shares > 0) AS units_up,
       count(*) FILTER (WHERE delta_type = 'change' AND delta_shares < 0) AS units_down
FROM deltas_votes GROUP BY isin"""))
def unit_directions(spark, folder):
    return consensus.unit_directions(consensus.details(_deltas(spark, folder), GROUPS))


_UP = "(delta_weight_pct > 0 OR delta_type = 'addition')"
_DOWN = "(delta_weight_pct < 0 OR delta_type = 'removal')"
_VOTED = f"""
SELECT isin, count(*) FILTER (WHERE {_UP}) AS up_votes, count(*) FILTER (WHERE {_DOWN}) AS down_votes,
       CASE WHEN count(*) FILTER (WHERE {_UP}) >= count(*) FILTER (WHERE {_DOWN}) THEN '↑'
            ELSE '↓' END AS arrow FROM deltas_votes GROUP BY isin"""


@query("direction_votes", sql(_VOTED))
def direction_votes(spark, folder):
    return consensus.direction_votes(consensus.details(_deltas(spark, folder), GROUPS))


@query("funds_of_winning_side", sql(f"""
SELECT isin, arrow, etf_ticker FROM deltas_votes JOIN voted USING (isin)
WHERE CASE arrow WHEN '↑' THEN {_UP} ELSE {_DOWN} END""", voted=_VOTED))
def funds_of_winning_side(spark, folder):
    votes = consensus.details(_deltas(spark, folder), GROUPS)
    return consensus.funds_of_winning_side(votes, consensus.direction_votes(votes))


# --- views ----------------------------------------------------------------------------

_LISTED = ", ".join([
    "etf_ticker, source, commodity_vertical, constituent_ticker, constituent_name, isin",
    "curr_as_of_date, prev_as_of_date, delta_type, prev_weight_pct, curr_weight_pct",
    "delta_weight_pct, prev_shares, curr_shares, delta_shares, pct_change_shares",
    "prev_market_value, curr_market_value, delta_market_value"])


@query("latest_view_moves", sql(f"SELECT {_LISTED} FROM deltas_moves"))
def latest_view_moves(spark, folder):
    return as_doubles(_flow(spark, folder).moves)


@query("latest_view_signals", sql("SELECT * FROM deltas_scoped"))
def latest_view_signals(spark, folder):
    return as_doubles(_flow(spark, folder).signals)


@query("latest_view_votes", sql(f"SELECT {_VOTE} FROM deltas_scoped_votes"))
def latest_view_votes(spark, folder):
    return as_doubles(_flow(spark, folder).details)


@query("aligned_view_moves", sql(f"SELECT {_LISTED} FROM deltas_aligned_moves"))
def aligned_view_moves(spark, folder):
    return as_doubles(_aligned(spark, folder).moves)


@query("aligned_view_signals", sql("SELECT * FROM deltas_aligned_scoped"))
def aligned_view_signals(spark, folder):
    return as_doubles(_aligned(spark, folder).signals)


@query("scoped_run", sql(f"""
SELECT {_MOVE} FROM deltas_listed
WHERE etf_ticker IN (SELECT etf_ticker FROM universe WHERE issuer = 'vaneck')"""))
def scoped_run(spark, folder):
    funds = universe(spark, folder)
    flow = views.reported(_deltas(spark, folder), CONFIG)
    kept = views.scoped(flow, keep=funds.filter("issuer = 'vaneck'"))
    return as_doubles(kept.moves.select(*_MOVE_COLUMNS))


@query("scoped_run_signals", sql("""
SELECT s.isin, k.n AS n_etfs, s.total_delta_market_value FROM deltas_signals s JOIN (
  SELECT isin, count(DISTINCT etf_ticker) AS n FROM deltas_votes
  WHERE etf_ticker IN (SELECT etf_ticker FROM universe WHERE issuer = 'vaneck')
  GROUP BY isin) k USING (isin) WHERE s.n_etfs >= 2 AND k.n >= 2"""))
def scoped_run_signals(spark, folder):
    funds = universe(spark, folder)
    flow = views.reported(_deltas(spark, folder), CONFIG)
    kept = views.scoped(flow, keep=funds.filter("issuer = 'vaneck'"))
    return as_doubles(kept.signals.select("isin", "n_etfs", "total_delta_market_value"))


@query("anything_to_report", sql("SELECT count(*) > 0 AS has_moves FROM deltas_moves"))
def anything_to_report(spark, folder):
    return coverage.has_moves(_flow(spark, folder).moves)


_STALE = """
SELECT etf_ticker, latest_stored AS fund_date FROM latest_stored
WHERE latest_stored < (SELECT max(prev_as_of_date) FROM deltas)
  AND etf_ticker NOT IN (SELECT etf_ticker FROM paused)"""


def _stale(found, funds):
    active = found.latest_stored.join(coverage.paused(funds), "etf_ticker", "left_anti")
    own = active.withColumn("as_of_date", F.lit(None).cast("date"))
    return coverage.stale_funds(own, found.latest.dates())


@query("stale_funds", sql(_STALE))
def stale_funds(spark, folder):
    return _stale(_views(spark, folder), universe(spark, folder))


@query("signal_table", sql("""
SELECT s.*, coalesce(nullif(s.constituent_name, ''), s.constituent_ticker) AS shown_name,
       x.units_up, x.units_down, x.stale_funds
FROM deltas_scoped s JOIN (
  SELECT isin, count(*) FILTER (WHERE delta_type = 'change' AND delta_shares > 0) AS units_up,
         count(*) FILTER (WHERE delta_type = 'change' AND delta_shares < 0) AS units_down,
         count(stale.etf_ticker) AS stale_funds
  FROM deltas_scoped_votes v LEFT JOIN stale ON v.etf_ticker = stale.etf_ticker
  GROUP BY isin) x USING (isin)""", stale=_STALE))
def signal_table(spark, folder):
    found = _views(spark, folder)
    return as_doubles(views.read_signals(found.latest, _stale(found, universe(spark, folder))))


@query("marked_votes", sql("""
SELECT v.isin, v.etf_ticker, v.etf_ticker || CASE WHEN stale.etf_ticker IS NULL THEN '' ELSE '*' END AS shown
FROM deltas_scoped_votes v LEFT JOIN stale ON v.etf_ticker = stale.etf_ticker""", stale=_STALE))
def marked_votes(spark, folder):
    found = _views(spark, folder)
    return views.marked_votes(found.latest, _stale(found, universe(spark, folder)))


@query("move_search", sql(f"""
SELECT {_MOVE} FROM deltas_moves WHERE contains(lower(concat(etf_ticker, ' ',
  coalesce(constituent_ticker, ''), ' ', coalesce(constituent_name, ''), ' ',
  coalesce(isin, ''))), 't4 holding 4')"""))
def move_search(spark, folder):
    found = _flow(spark, folder).moves.filter(search(
        " T4 Holding 4", ["etf_ticker", "constituent_ticker", "constituent_name", "isin"]))
    return as_doubles(found.select(*_MOVE_COLUMNS))


@query("moves_by_value", sql(f"""
SELECT {_MOVE}, CAST(row_number() OVER (ORDER BY abs(delta_market_value) DESC NULLS LAST,
  etf_ticker, delta_type, isin NULLS FIRST, constituent_ticker NULLS FIRST) AS BIGINT) AS place
FROM deltas_moves"""))
def moves_by_value(spark, folder):
    ordered = coverage.sorted_table(
        _flow(spark, folder).moves, "delta_market_value", size_only=True,
        then=["etf_ticker", "delta_type", "isin", "constituent_ticker"])
    return as_doubles(in_order(ordered).select(*_MOVE_COLUMNS, "place"))


# --- digest ---------------------------------------------------------------------------

_SIZE = """CASE delta_type WHEN 'addition' THEN coalesce(curr_weight_pct, 0)
 WHEN 'removal' THEN coalesce(prev_weight_pct, 0) ELSE abs(coalesce(delta_weight_pct, 0)) END"""
_TOP = f"""
SELECT *, total - max(place) OVER (PARTITION BY delta_type) AS hidden FROM (
  SELECT *, row_number() OVER (PARTITION BY delta_type ORDER BY {_SIZE} DESC, etf_ticker,
                               isin NULLS FIRST, constituent_ticker NULLS FIRST) AS place,
         count(*) OVER (PARTITION BY delta_type) AS total FROM deltas_moves) WHERE place <= 10"""


@query("top_moves", sql(
    "SELECT delta_type, place, total, hidden, etf_ticker, isin, constituent_ticker FROM top",
    top=_TOP))
def top_moves(spark, folder):
    return digest.top_moves(_flow(spark, folder).moves).select(
        "delta_type", F.col("place").cast("long"), "total", "hidden", "etf_ticker", "isin",
        "constituent_ticker")


_LABEL = """CASE WHEN constituent_ticker IS NOT NULL AND constituent_ticker <> '' THEN
 trim(coalesce(constituent_name, '')) || ' (' || constituent_ticker || ')' ELSE
 coalesce(nullif(trim(coalesce(constituent_name, '')), ''), '—') END"""


_LINES = f"""
SELECT delta_type AS section, place, total, hidden,
       rpad(etf_ticker, CAST(greatest(length(etf_ticker), w1) AS INTEGER), ' ') || '  ' ||
       rpad(lbl, CAST(greatest(length(lbl), w2) AS INTEGER), ' ') || '  ' || CASE delta_type
         WHEN 'addition' THEN printf('%4.1f', coalesce(curr_weight_pct, 0.0)) || '% wt'
         WHEN 'removal' THEN 'was ' || printf('%4.1f', coalesce(prev_weight_pct, 0.0)) || '% wt'
         ELSE printf('%10s', printf('%+.2f', coalesce(delta_weight_pct, 0.0)) || '% wt') || '  ' ||
              printf('%9s', {short_shares_sql("delta_shares")} || ' shr') END AS line
FROM (SELECT *, max(length(etf_ticker)) OVER (PARTITION BY delta_type) AS w1,
             max(length(lbl)) OVER (PARTITION BY delta_type) AS w2
      FROM (SELECT *, CASE delta_type WHEN 'addition' THEN '+' WHEN 'removal' THEN '-' ELSE '' END
                      || {_LABEL} AS lbl FROM top))"""


@query("digest_move_lines", sql(_LINES, top=_TOP))
def digest_move_lines(spark, folder):
    top = digest.top_moves(_flow(spark, folder).moves)
    return digest.move_lines(top).withColumn("place", F.col("place").cast("long"))


@query("digest_signal_lines", sql(f"""
SELECT t.isin, t.n_etfs, 0 AS part, lbl || ': wt ' || arrow || ' in ' || funds AS line
FROM (SELECT isin, n_etfs, {_LABEL} AS lbl FROM deltas_scoped ORDER BY n_etfs DESC, isin LIMIT 5) t
JOIN (SELECT v.isin, any_value(arrow) AS arrow, string_agg(v.etf_ticker, ', ' ORDER BY v.etf_ticker)
             AS funds FROM deltas_scoped_votes v JOIN voted USING (isin)
      WHERE CASE arrow WHEN '↑' THEN {_UP} ELSE {_DOWN} END GROUP BY v.isin) f USING (isin)""",
    voted=_VOTED.replace("deltas_votes", "deltas_scoped_votes")))
def digest_signal_lines(spark, folder):
    flow = _flow(spark, folder)
    return digest.signal_lines(flow.signals, flow.details, per_part=1_000_000)


@query("digest_header", sql("""
SELECT strftime(max(curr_as_of_date), '%-d %b %Y') AS as_of_day,
       strftime(max(prev_as_of_date), '%-d %b %Y') AS previous_day,
       (SELECT count(DISTINCT etf_ticker) || ' ETFs' FROM deltas_moves) AS funds,
       (SELECT concat_ws(' · ',
         CASE WHEN count(*) FILTER (WHERE delta_type = 'addition') > 0
              THEN count(*) FILTER (WHERE delta_type = 'addition') || ' add' END,
         CASE WHEN count(*) FILTER (WHERE delta_type = 'removal') > 0
              THEN count(*) FILTER (WHERE delta_type = 'removal') || ' rm' END,
         CASE WHEN count(*) FILTER (WHERE delta_type = 'change') > 0
              THEN count(*) FILTER (WHERE delta_type = 'change') || ' moves' END,
         CASE WHEN (SELECT count(*) FROM deltas_scoped) > 0
              THEN (SELECT count(*) FROM deltas_scoped) || ' cross-ETF' END)
        FROM deltas_moves) AS counts FROM deltas"""))
def digest_header(spark, folder):
    flow = _flow(spark, folder)
    return digest.header(flow.summary(), flow.dates())


# --- published result -------------------------------------------------------------------

_BODY = "etf_ticker, isin, constituent_ticker, constituent_name, delta_shares, curr_market_value"


@query("payload_moves", sql(f"""
SELECT delta_type AS kind, {_BODY}, CAST(curr_as_of_date AS VARCHAR) AS curr_as_of_date FROM deltas_moves"""))
def payload_moves(spark, folder):
    """The bodies of the published moves, read back."""
    rows = publish.payload_rows(views.Flow(*map(as_doubles, _flow(spark, folder))), "latest")
    body = F.from_json("body", "etf_ticker string, isin string, constituent_ticker string, constituent_name string, "
                               "delta_shares double, curr_market_value double, curr_as_of_date string")
    return rows.where("kind <> 'signal'").select("kind", body.alias("b")).select("kind", "b.*")


@query("payload_signals", sql("""
SELECT s.isin, s.constituent_name, s.n_etfs, s.total_delta_market_value,
  string_agg(v.etf_ticker || ':' || v.delta_type, ' ' ORDER BY v.etf_ticker) AS votes
FROM deltas_scoped s JOIN deltas_scoped_votes v USING (isin) GROUP BY ALL"""))
def payload_signals(spark, folder):
    """The bodies of the published signals with their votes, read back; parts are put together."""
    rows = publish.payload_rows(views.Flow(*map(as_doubles, _flow(spark, folder))), "latest")
    body = F.from_json("body", "isin string, constituent_name string, n_etfs bigint, total_delta_market_value double, "
                               "etf_details array<struct<etf_ticker:string,delta_type:string>>")
    votes = rows.where("kind = 'signal'").select(body.alias("b")).select("b.*").select(
        "isin", "constituent_name", "n_etfs", "total_delta_market_value", F.explode("etf_details").alias("d"))
    return votes.groupBy("isin", "constituent_name", "n_etfs", "total_delta_market_value").agg(F.array_join(
        F.transform(F.sort_array(F.collect_list("d")), lambda d: F.concat(d["etf_ticker"], F.lit(":"), d["delta_type"])),
        " ").alias("votes"))


@query("payload_rows", sql("""
SELECT 'latest' AS view, delta_type AS kind, count(*) AS n, NULL AS votes FROM deltas_moves
GROUP BY delta_type
UNION ALL SELECT 'latest', 'signal', count(DISTINCT isin), count(*) FROM deltas_scoped_votes"""))
def payload_rows(spark, folder):
    rows = publish.payload_rows(views.Flow(*map(as_doubles, _flow(spark, folder))), "latest")
    isin = F.when(F.col("kind") == "signal", F.get_json_object("body", "$.isin"))
    votes = F.json_array_length(F.get_json_object("body", "$.etf_details"))
    return rows.groupBy("view", "kind").agg(
        F.coalesce(F.nullif(F.count_distinct(isin), F.lit(0)), F.count(F.lit(1))).alias("n"),
        F.sum(votes).cast("long").alias("votes"))
