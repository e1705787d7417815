"""Queries about stored histories: committed runs, the dates index, positions in buckets, kept views."""

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdrift.operators import resolve
from holdrift.plans import incremental_views, views
from holdrift.plans.joins import settled
from holdrift.sources import history, layout, ledger
from workload.ingest_queries import (
    BATCHES, KEY_PARTS, OVERRIDES, STORE, STORED, listed_securities, scratch, store_case,
)
from workload.registry import query
from workload.sql import sql
from workload.tables import CONFIG, as_doubles, holdings, universe

RUN_DATE = date(2001, 4, 15)
BUCKETS = 16

_AFTER = {**STORE, "ledger_rows": f"""
SELECT {STORED} FROM holdings WHERE source = 'web_csv' AND as_of_date < DATE '1999-01-01' UNION ALL
SELECT {STORED.replace('source', "'web_csv' AS source")} FROM incoming
SEMI JOIN (SELECT * FROM heads WHERE status = 'ingested') h
  ON h.etf_ticker = incoming.etf_ticker AND h.as_of_date = incoming.as_of_date AND h.batch = incoming.batch"""}


def _appended(spark, folder):
    """A stored history, a run that is cut off before its commit, a run, and the same run again."""
    incoming, stored = store_case(spark, folder)
    target = scratch(spark, "ledger")
    ledger.import_history(stored, target)
    ledger.staged_run(incoming, target, RUN_DATE, BATCHES)
    for _ in range(2):
        ledger.append_run(incoming, target, RUN_DATE, BATCHES)
    return ledger.read_ledger(spark, target)


@query("ledger_rows", sql("SELECT * FROM ledger_rows", **_AFTER))
def ledger_rows(spark, folder):
    return _appended(spark, folder).rows


@query("ledger_dates", sql("""
SELECT etf_ticker, source, as_of_date, count(*) AS n_rows FROM ledger_rows GROUP BY ALL""", **_AFTER))
def ledger_dates(spark, folder):
    return _appended(spark, folder).dates


@query("ledger_status_of_two_runs", sql("""
SELECT etf_ticker, batch, CASE WHEN status = 'ingested' AND taken THEN 'skipped' ELSE status END AS status,
  CASE WHEN status <> 'future_date' THEN as_of_date END AS as_of_date,
  CASE WHEN status = 'ingested' AND NOT taken THEN n ELSE 0 END AS n_today
FROM (SELECT *, EXISTS (SELECT 1 FROM holdings k WHERE k.source = 'manual' AND k.etf_ticker = h.etf_ticker
                        AND k.as_of_date = h.as_of_date AND k.as_of_date <= DATE '2001-04-15') AS taken
      FROM heads h)""", **STORE))
def ledger_status_of_two_runs(spark, folder):
    """Of two runs at once, the status of the one that came second: dates that the first stored are skipped."""
    incoming, stored = store_case(spark, folder)
    target = scratch(spark, "ledger")
    ledger.import_history(stored, target)
    second = ledger.staged_run(incoming, target, RUN_DATE, BATCHES)
    manual = incoming.filter("source = 'manual'").withColumn("batch", F.lit(1))
    ledger.append_run(manual, target, RUN_DATE, BATCHES)
    return ledger.committed(second).drop("quarter")


@query("repaired_dates", sql("""
SELECT etf_ticker, source, as_of_date, count(*) AS n_rows FROM holdings GROUP BY ALL"""))
def repaired_dates(spark, folder):
    """The index of a history whose own part was overwritten with a part of it, built again from the rows."""
    target = scratch(spark, "ledger")
    ledger.import_history(holdings(spark, folder), target)
    run = ledger.commits(spark, target).first().run
    broken = ledger.read_ledger(spark, target).dates.filter("source = 'manual'").withColumn("n_rows", F.col("n_rows") + 1)
    settled(broken).write.mode("overwrite").parquet(f"{target}/dates/run={run}")
    ledger.repair_dates(spark, target)
    return ledger.read_ledger(spark, target).dates


@query("crosswalk_of_runs", sql('SELECT "table", key, isin FROM crosswalk', **KEY_PARTS))
def crosswalk_of_runs(spark, folder):
    """The crosswalk from the states of three parts of the rows, merged."""
    rows = listed_securities(spark, folder)
    states = [resolve.crosswalk_state(rows.filter(F.col("p_partkey") % 3 == k)) for k in range(3)]
    return resolve.crosswalk_of(resolve.merged_states(reduce(DataFrame.unionByName, map(settled, states))))


@query("filled_isins_by_kept_keys", sql(
    "SELECT p_partkey, coalesce(isin, found_isin) AS isin FROM answered", **KEY_PARTS))
def filled_isins_by_kept_keys(spark, folder):
    """One half of the rows is filled with the kept state of the other half and its own rows; then the other."""
    rows, even = listed_securities(spark, folder), F.col("p_partkey") % 2 == 0
    overrides = resolve.override_table(spark, OVERRIDES)

    def filled(own, other):
        state = settled(resolve.crosswalk_state(other))
        return resolve.fill_isins(own, resolve.isin_lookup(own, overrides, state)).select("p_partkey", "isin")

    return filled(rows.filter(even), rows.filter(~even)).unionByName(filled(rows.filter(~even), rows.filter(even)))


def _ledger(spark, folder):
    target = scratch(spark, "ledger")
    ledger.import_history(holdings(spark, folder), target)
    return ledger.read_ledger(spark, target)


_ALL_BUT_PAIR = "SELECT * EXCLUDE (pair_date) FROM"


@query("daily_deltas_by_dates_index", sql(f"{_ALL_BUT_PAIR} deltas"))
def daily_deltas_by_dates_index(spark, folder):
    stored = _ledger(spark, folder)
    return views.daily_deltas(stored.rows, universe(spark, folder), dates=stored.dates)


@query("aligned_signals_by_dates_index", sql("SELECT * FROM deltas_aligned_scoped"))
def aligned_signals_by_dates_index(spark, folder):
    stored = _ledger(spark, folder)
    return as_doubles(views.aligned_view(stored.rows, universe(spark, folder), CONFIG, dates=stored.dates).signals)


def _positions(spark, folder):
    """The holdings in buckets, written in two steps: a history and what came later."""
    rows = history.with_history_columns(holdings(spark, folder))
    name, target = f"positions_{uuid.uuid4().hex}", scratch(spark, "positions")
    later = F.col("as_of_date") >= F.lit(date(2000, 1, 1))
    layout.write_positions(rows.filter(~later), name, target, BUCKETS)
    layout.write_positions(rows.filter(later), name, target, BUCKETS, mode="append")
    return spark.table(name), ledger.dates_of(rows)


@query("history_deltas_of_buckets", sql("SELECT * FROM deltas_all"))
def history_deltas_of_buckets(spark, folder):
    positions, dates = _positions(spark, folder)
    return layout.history_deltas(positions, universe(spark, folder), dates)


@query("daily_deltas_of_buckets", sql(f"{_ALL_BUT_PAIR} deltas"))
def daily_deltas_of_buckets(spark, folder):
    positions, dates = _positions(spark, folder)
    return layout.daily_deltas(positions, universe(spark, folder), dates)


def _kept(spark, folder, pinned):
    """A view kept from a history in which every tenth fund lacked its later dates, then brought up to date."""
    rows, funds = holdings(spark, folder), universe(spark, folder)
    late = (F.substring("etf_ticker", 2, 20).cast("long") % 10 == 3) & (F.col("as_of_date") >= F.lit(date(1997, 1, 1)))
    before = rows.filter(~late)
    view = incremental_views.kept_view(before, funds, ledger.dates_of(before), CONFIG, pinned=pinned)
    update = incremental_views.updated(view, rows, funds, ledger.dates_of(rows), CONFIG, pinned=pinned)
    return incremental_views.flow(update.view, funds, CONFIG)


@query("kept_latest_signals", sql("SELECT * FROM deltas_scoped"))
def kept_latest_signals(spark, folder):
    return as_doubles(_kept(spark, folder, pinned=False).signals)


@query("kept_latest_moves", sql("SELECT * EXCLUDE (pair_date) FROM deltas_moves"))
def kept_latest_moves(spark, folder):
    return as_doubles(_kept(spark, folder, pinned=False).moves)


@query("kept_aligned_signals", sql("SELECT * FROM deltas_aligned_scoped"))
def kept_aligned_signals(spark, folder):
    return as_doubles(_kept(spark, folder, pinned=True).signals)
