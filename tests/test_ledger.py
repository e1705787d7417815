"""Committed runs: cut off, at once, repeated; the dates index and its repair."""

import re
from datetime import date

import pytest

from holdrift.operators import resolve, snapshots
from holdrift.plans import views
from holdrift.plans.ingest import ingest
from holdrift.sources import ledger
from holdrift.streaming.incremental import ingest_available, landing_stream
from holdrift.schemas import DOCUMENTS
from workload import tables
from tests.build import DAY, documents, history, position, rows, universe

FOLDER = "/root/testdata/sf0.001"
FIRST = [position("A", 1, "X", 1), position("A", 1, "Y", 1), position("B", 2, "X", 1)]
SECOND = [position("A", 3, "X", 2), position("B", 2, "X", 9)]


def stored(spark, folder):
    return rows(ledger.read_ledger(spark, folder).rows, "etf_ticker", "as_of_date", "constituent_ticker", "shares_held")


def index(spark, folder):
    return rows(ledger.read_ledger(spark, folder).dates, "etf_ticker", "source", "as_of_date", "n_rows")


def test_before_the_first_run(spark, tmp_path):
    empty = ledger.read_ledger(spark, str(tmp_path / "none"))
    assert empty.version == -1 and empty.rows.count() == 0 and empty.dates.count() == 0
    assert ledger.remove_abandoned(spark, str(tmp_path / "none"), 0) == []
    assert views.daily_deltas(empty.rows, universe(spark, []), dates=empty.dates).count() == 0


def test_runs_and_retry(spark, tmp_path):
    folder = str(tmp_path)
    assert rows(ledger.append_run(history(spark, FIRST), folder, DAY[9])) == [
        ("A", "ingested", DAY[1], 2), ("B", "ingested", DAY[2], 1)]
    for _ in range(2):
        ledger.append_run(history(spark, SECOND), folder, DAY[9])
    assert rows(ledger.append_run(history(spark, SECOND), folder, DAY[9])) == [
        ("A", "skipped", DAY[3], 0), ("B", "skipped", DAY[2], 0)]
    assert stored(spark, folder) == [("A", DAY[1], "X", 1.0), ("A", DAY[1], "Y", 1.0), ("A", DAY[3], "X", 2.0),
                                     ("B", DAY[2], "X", 1.0)]
    assert index(spark, folder) == [("A", "web_csv", DAY[1], 2), ("A", "web_csv", DAY[3], 1), ("B", "web_csv", DAY[2], 1)]
    # Runs without news are not committed.
    assert ledger.read_ledger(spark, folder).version == 1


def test_a_run_that_is_cut_off_leaves_nothing(spark, tmp_path):
    folder = str(tmp_path)
    ledger.append_run(history(spark, FIRST), folder, DAY[9])
    ledger.staged_run(history(spark, SECOND), folder, DAY[9])  # rows and dates are written, the commit is not
    history(spark, SECOND).write.partitionBy("as_of_date").parquet(f"{folder}/rows/run=cut")  # cut before the dates
    before = stored(spark, folder)
    assert len(before) == 3 and len(index(spark, folder)) == 2
    assert ledger.remove_abandoned(spark, folder, 3600) == []
    assert len(ledger.remove_abandoned(spark, folder, 0)) == 2 and stored(spark, folder) == before
    ledger.append_run(history(spark, SECOND), folder, DAY[9])
    assert len(stored(spark, folder)) == 4 and ledger.remove_abandoned(spark, folder, 0) == []


def test_two_runs_at_once(spark, tmp_path):
    folder = str(tmp_path)
    ledger.append_run(history(spark, FIRST), folder, DAY[9])
    one = ledger.staged_run(history(spark, SECOND), folder, DAY[9])
    other = ledger.staged_run(history(spark, [position("A", 3, "X", 7), position("C", 4, "Z", 1)]), folder, DAY[9])
    apart = ledger.staged_run(history(spark, [position("D", 4, "Z", 1)]), folder, DAY[9])
    assert one.version == other.version == apart.version == 0
    assert rows(ledger.committed(other)) == [("A", "ingested", DAY[3], 1), ("C", "ingested", DAY[4], 1)]
    # The slower run had the same date of A: it has to be judged again and finds it stored.
    assert rows(ledger.committed(one)) == [("A", "skipped", DAY[3], 0), ("B", "skipped", DAY[2], 0)]
    # A run without a common date takes the next number with what it has written.
    assert rows(ledger.committed(apart)) == [("D", "ingested", DAY[4], 1)]
    assert [r for r in stored(spark, folder) if r[1] == DAY[3]] == [("A", DAY[3], "X", 7.0)]
    found = index(spark, folder)
    assert len(found) == len({r[:3] for r in found}) == 5
    assert apart.run in {c.run for c in ledger.commits(spark, folder).collect()}


def test_both_lose_and_part_of_a_batch_is_new(spark, tmp_path):
    folder = str(tmp_path)
    one = ledger.staged_run(history(spark, [position("A", 1, "X", 1), position("B", 1, "X", 1)]), folder, DAY[9])
    other = ledger.staged_run(history(spark, [position("A", 1, "X", 5)]), folder, DAY[9])
    ledger.committed(other)
    assert rows(ledger.committed(one)) == [("A", "skipped", DAY[1], 0), ("B", "ingested", DAY[1], 1)]
    assert stored(spark, folder) == [("A", DAY[1], "X", 5.0), ("B", DAY[1], "X", 1.0)]


def test_repair(spark, tmp_path):
    folder = str(tmp_path)
    for batch in (FIRST, SECOND):
        ledger.append_run(history(spark, batch), folder, DAY[9])
    wanted, runs = index(spark, folder), [c.run for c in ledger.commits(spark, folder).orderBy("version").collect()]
    assert ledger.repair_dates(spark, folder).count() == 0 and index(spark, folder) == wanted
    spark.createDataFrame([("A", "web_csv", DAY[1], 5)], "etf_ticker string, source string, as_of_date date, n_rows long").write.mode(
        "overwrite").parquet(f"{folder}/dates/run={runs[0]}")
    with pytest.raises(ValueError, match="incomplete"):
        ledger.append_run(history(spark, SECOND), folder, DAY[9])
    differing = ledger.repair_dates(spark, folder)
    assert rows(differing, "etf_ticker", "as_of_date", "indexed", "counted") == [("A", DAY[1], 5, 2), ("B", DAY[2], None, 1)]
    assert index(spark, folder) == wanted and ledger.missing_dates(spark, folder).count() == 0


def test_import(spark, tmp_path):
    folder = str(tmp_path)
    table = history(spark, [*FIRST, position("A", 1, "M", 1, source="manual")])
    ledger.import_history(table, folder)
    assert ("A", "manual", DAY[1], 1) in index(spark, folder)
    with pytest.raises(ValueError, match="already"):
        ledger.import_history(table, folder)
    assert rows(ledger.append_run(history(spark, SECOND), folder, DAY[9])) == [
        ("A", "ingested", DAY[3], 1), ("B", "skipped", DAY[2], 0)]


def test_a_run_judged_anew_is_copied_from_what_it_has_written(spark, tmp_path):
    folder, source = str(tmp_path / "ledger"), str(tmp_path / "source")
    named = [position("A", 3, "X", 2, isin="US0000000011"), position("B", 2, "X", 9, isin="US0000000029"),
             position("B", 2, "Y", 4), position("B", 2, "M", 1), position("C", 4, "Y", 1, isin="US0000000045"),
             position("D", 12, "Y", 1), {"etf_ticker": "E", "constituent_ticker": "Y"}]
    history(spark, named).write.parquet(source)
    slow = ledger.staged_run(spark.read.parquet(source), folder, DAY[9])
    ledger.append_run(history(spark, [position("A", 3, "Z", 1), position("F", 3, "Z", 1)]), folder, DAY[9])
    # The source is gone by now; what was judged has been written.
    history(spark, [position("B", 5, "N", 1)]).write.mode("overwrite").parquet(source)
    assert rows(ledger.committed(slow)) == sorted([
        ("A", "skipped", DAY[3], 0), ("B", "ingested", DAY[2], 3), ("C", "ingested", DAY[4], 1),
        ("D", "future_date", None, 0), ("E", "no_data", None, 0)], key=repr)
    assert stored(spark, folder) == [
        ("A", DAY[3], "Z", 1.0), ("B", DAY[2], "M", 1.0), ("B", DAY[2], "X", 9.0), ("B", DAY[2], "Y", 4.0),
        ("C", DAY[4], "Y", 1.0), ("F", DAY[3], "Z", 1.0)]
    found = ledger.read_ledger(spark, folder)
    assert rows(found.dates) == rows(ledger.dates_of(found.rows)) and found.version == 1
    assert rows(found.keys) == rows(resolve.crosswalk_state(found.rows))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, folder):
    return [line for line in re.findall(r"FileScan parquet.*", plan(df)) if folder in line]


def test_views_take_dates_from_the_index(spark, tmp_path):
    folder, funds = str(tmp_path), tables.universe(spark, FOLDER)
    ledger.import_history(tables.holdings(spark, FOLDER), folder)
    ledger.append_run(history(spark, [position("F1", 3, "T5", 4), position("F1", 3, "T6", 4)]), folder, DAY[9])
    found = ledger.read_ledger(spark, folder)
    dates = snapshots.snapshot_dates(found.dates, "web_csv")
    assert scans(dates, "/dates") and not scans(dates, "/rows")
    deltas = views.daily_deltas(found.rows, funds, dates=found.dates)
    # One scan of the rows, for the deltas themselves, pruned by run and by date; none for dates.
    assert len(scans(deltas, "/rows")) == 1 and "dynamicpruning" in plan(deltas)
    assert "run#" in scans(deltas, "/rows")[0].split("PartitionFilters")[1]
    assert rows(deltas) == rows(views.daily_deltas(found.rows, funds))
    assert rows(views.history_deltas(found.rows, funds, dates=found.dates)) == rows(views.history_deltas(found.rows, funds))
    with_index, without = views.both_views(found.rows, funds, dates=found.dates), views.both_views(found.rows, funds)
    assert rows(with_index.aligned.moves) == rows(without.aligned.moves)
    assert with_index.aligned_date.first() == without.aligned_date.first()


def test_ingest_into_a_ledger(spark, tmp_path):
    folder, funds = str(tmp_path / "ledger"), universe(spark, [("A", "gold"), ("B", "gold")])
    head = "as of 2026-06-01\nTicker,Name,Weight (%)\n"
    docs = documents(spark, [("a1", "A", "ishares", f"{head}X,Ex,60\nY,Why,40\n"), ("b1", "B", "ishares", f"{head}X,Ex,100\n")])
    for n, status in ((2, "ingested"), (0, "skipped")):
        found = ingest(docs, funds, folder, date(2026, 6, 30), append=ledger.append_run,
                       keys=ledger.read_ledger(spark, folder).keys)
        assert ("A", status, n) in rows(found, "etf_ticker", "status", "n_today")
    docs.select(*DOCUMENTS.fieldNames()).write.parquet(str(tmp_path / "landing"))
    again = ingest_available(landing_stream(spark, str(tmp_path / "landing"), 1), funds, folder, str(tmp_path / "work"),
                             date(2026, 6, 30), append=ledger.append_run)
    assert rows(again, "status") == [("skipped",), ("skipped",)] and len(stored(spark, folder)) == 3


def test_keys_of_runs_merge_to_those_of_the_whole_history(spark, tmp_path):
    folder = str(tmp_path)
    first = history(spark, [position("A", 1, "XX US", 1, isin="US0000000011", country="US", name="Quiet Harbour Inc"),
                            position("A", 1, "YY", 1, isin="US0000000029"), position("A", 1, "ZZ", 1)])
    second = history(spark, [position("B", 2, "XX AU", 1, isin="AU0000000037", country="AU", name="Quiet Harbour"),
                             position("B", 2, "ZZ", 1, isin="US0000000045"), position("B", 2, "C", 1, isin="CASH")])
    for batch in (first, second):
        ledger.append_run(batch, folder, DAY[9])
    ledger.staged_run(history(spark, [position("C", 3, "YY", 1, isin="US0000000052")]), folder, DAY[9])
    found = ledger.read_ledger(spark, folder)
    assert rows(resolve.crosswalk_of(found.keys)) == rows(resolve.crosswalk(found.rows))
    assert scans(found.keys, "/keys") and not scans(found.keys, "/rows")
    asked = history(spark, [position("D", 5, t, 1, name=None) for t in ("YY", "ZZ", "XX")])
    lookup = resolve.isin_lookup(asked, state=found.keys)
    assert rows(resolve.fill_isins(asked, lookup), "constituent_ticker", "isin") == [
        ("XX", None), ("YY", "US0000000029"), ("ZZ", "US0000000045")]
    ledger.rebuild_keys(spark, folder)
    again = ledger.read_ledger(spark, folder).keys
    assert rows(again) == rows(resolve.crosswalk_state(found.rows))


def test_the_dates_of_a_large_run_are_indexed_in_many_tasks(spark, tmp_path):
    folder, whole = str(tmp_path), tables.holdings(spark, FOLDER)
    names = ["advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize"]
    kept = {f"spark.sql.adaptive.{name}": spark.conf.get(f"spark.sql.adaptive.{name}") for name in names}
    try:
        for name in kept:
            spark.conf.set(name, "1k")
        ledger.import_history(whole, folder)
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    [run] = (tmp_path / "dates").iterdir()
    assert len(list(run.glob("*.parquet"))) > 1
    assert rows(ledger.read_ledger(spark, folder).dates) == rows(ledger.dates_of(whole))
    small = str(tmp_path / "small")
    ledger.append_run(history(spark, FIRST), small, DAY[9])
    [run] = (tmp_path / "small" / "dates").iterdir()
    assert len(list(run.glob("*.parquet"))) == 1
