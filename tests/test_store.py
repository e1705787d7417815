from datetime import date

from pyspark.sql import functions as F

from holdrift.operators import snapshots
from holdrift.plans import publish, views
from holdrift.plans.ingest import ingest
from holdrift.schemas import DOCUMENTS
from holdrift.sources import history as store
from holdrift.streaming.incremental import ingest_available, landing_stream
from tests.build import DAY, documents, history, position, rows, universe


def test_empty_history(spark, tmp_path):
    empty = store.read_history(spark, str(tmp_path / "none"))
    assert empty.count() == 0 and empty.schema == store.empty_history(spark).schema
    assert views.daily_deltas(empty, universe(spark, [])).count() == 0
    assert snapshots.aligned_date(snapshots.latest_date_per_fund(
        snapshots.snapshot_dates(empty))).first()[0] is None


def test_append_is_repeatable(spark, tmp_path):
    folder = str(tmp_path / "history")
    batch = history(spark, [
        position("A", 1, "X", 1), position("A", 2, "Y", 1), position("B", 9, "X", 1),
        {"etf_ticker": "C", "constituent_ticker": "X"}])
    first = store.append_snapshots(batch, folder, DAY[5])
    assert rows(first) == sorted([
        ("A", "ingested", DAY[2], 2), ("B", "future_date", None, 0), ("C", "no_data", None, 0)], key=repr)
    again = store.append_snapshots(batch, folder, DAY[5])
    assert rows(again.filter("etf_ticker = 'A'")) == [("A", "skipped", DAY[2], 0)]
    stored = store.read_history(spark, folder)
    assert rows(stored, "etf_ticker", "as_of_date", "constituent_ticker", "source") == [
        ("A", DAY[2], "X", "web_csv"), ("A", DAY[2], "Y", "web_csv")]
    later = store.append_snapshots(batch, folder, DAY[9])
    assert rows(later.filter("etf_ticker = 'B'")) == [("B", "ingested", DAY[9], 1)]
    assert rows(store.stored_dates(store.read_history(spark, folder))) == [("A", DAY[2]), ("B", DAY[9])]


def test_csv_history_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "as_of_date,etf_ticker,constituent_ticker,sedol,weight_pct,instrument_type,source\n"
        "2026-06-18,U,CCJ,2158684,20.05,equity,web_csv\n2026-06-18,U,,,\"\",cash,web_csv\n")
    (tmp_path / "b.csv").write_text(
        "source,etf_ticker,as_of_date,weight_pct,constituent_name\nweb_csv,V,2026-06-19,1,\"two, words\"\n")
    found = store.read_csv_history(spark, str(tmp_path))
    assert rows(found, "etf_ticker", "as_of_date", "constituent_ticker", "constituent_name", "sedol",
                "weight_pct", "instrument_type") == sorted([
        ("U", date(2026, 6, 18), "CCJ", None, "2158684", 20.05, "equity"),
        ("U", date(2026, 6, 18), None, None, None, None, "cash"),
        ("V", date(2026, 6, 19), None, "two, words", None, 1.0, None)], key=repr)


def test_restamp(spark, tmp_path):
    table = history(spark, [
        position("A", 1, "X", 1, kind=None, sector="Cash and/or Derivatives"),
        position("A", 1, "Y", 1, kind=None, sector="Materials"),
        position("B", 1, "Z", 1, kind="cash", asset_class="Futures", sector="Cash")])
    found = store.restamp_history(table, str(tmp_path / "new"))
    assert rows(found.filter("all_types = 0 AND all_funds = 0"), "instrument_type", "etf_ticker", "n_rows") == [
        ("cash", "A", 1), ("derivative", "B", 1), ("equity", "A", 1)]
    assert found.filter("all_types = 1 AND all_funds = 1").first().n_rows == 3
    once = store.read_history(spark, str(tmp_path / "new"))
    assert rows(store.restamped(once)) == rows(once)


def test_export(spark, tmp_path):
    table = history(spark, [position("A", 2, "X", 1), position("A", 1, "X", 1), position("B", 1, "X", 1),
                            position("A", 1, "M", 1, source="manual")])
    report = store.export_history(table, universe(spark, [("A", "gold")]), str(tmp_path / "out"))
    assert rows(report) == [("A", 2, 2)]


_CSV = "as of {}\nTicker,Name,Weight (%)\n{}\n"


def _docs(spark):
    return documents(spark, [
        ("a1", "A", "ishares", _CSV.format("2026-06-01", "X,Ex,60\nY,Why,40")),
        ("b1", "B", "vaneck", "<html></html>"), ("c1", "C", "ishares", _CSV.format("2027-01-01", "X,Ex,60")),
        ("d1", "D", "ishares", _CSV.format("soon", "X,Ex,60")),
        ("e1", "E", "ishares", _CSV.format("2026-06-01", ",Note,"))])


_FUNDS = [("A", "gold"), ("B", "gold"), ("C", "gold"), ("D", "gold"), ("E", "gold"), ("G", "gold"),
          ("P", "gold", False), ("X", "gold", None, True)]


def test_ingest_run(spark, tmp_path):
    folder, funds = str(tmp_path / "history"), universe(spark, _FUNDS)
    status = ingest(_docs(spark), funds, folder, date(2026, 6, 30))
    assert {r.etf_ticker: (r.status, r.n_today, r.error) for r in status.collect()} == {
        "A": ("ingested", 2, None), "B": ("failed", 0, "web page instead of data"),
        "C": ("future_date", 0, "dated after the run"), "D": ("no_data", 0, None),
        "E": ("no_data", 0, "no usable holdings"), "G": ("failed", 0, "no document"),
        "X": ("external", 0, None)}
    assert rows(store.read_history(spark, folder), "etf_ticker", "constituent_ticker", "weight_pct") == [
        ("A", "X", 60.0), ("A", "Y", 40.0)]


def test_replayed_stream_appends_nothing(spark, tmp_path):
    landing, folder = str(tmp_path / "landing"), str(tmp_path / "history")
    _docs(spark).select(*DOCUMENTS.fieldNames()).repartition(3).write.parquet(landing)
    for turn in range(2):  # the second stream starts from nothing and sees the files again
        again = ingest_available(landing_stream(spark, landing, 1), universe(spark, _FUNDS), folder,
                                 str(tmp_path / f"work{turn}"), date(2026, 6, 30))
        assert store.read_history(spark, folder).count() == 2
    assert rows(again.filter("etf_ticker = 'A'"), "status", "n_today") == [("skipped", 0)]
    # Nothing has landed since.
    assert ingest_available(landing_stream(spark, landing, 1), universe(spark, _FUNDS), folder,
                            str(tmp_path / "work1"), date(2026, 6, 30)) is None


def test_batches_of_a_stream_do_not_change_what_is_stored(spark, tmp_path):
    """Also of two documents of one fund and date, and of ISINs that only another document states."""
    head = "Ticker,Name,ISIN,Weight (%),Market Value\n"
    docs = documents(spark, [
        ("1", "A", "ishares", f'"as of Jun 12, 2026"\n{head}X,Quiet Harbour Inc,US0000000011,60,1\n'),
        ("2", "B", "ishares", f'"as of Jun 12, 2026"\n{head}Q,Quiet Harbour,,60,1\nY,Twice,,1,1\n'),
        ("3", "C", "ishares", f'"as of Jun 12, 2026"\n{head}Y,Twice,US0000000029,60,1\n'),
        ("4", "D", "ishares", f'"as of Jun 12, 2026"\n{head}Y,Twice,US0000000037,60,1\n'),
        ("5", "C", "ishares", f'"as of Jun 12, 2026"\n{head}Z,Other,US0000000045,60,1\n')])
    landing, found = str(tmp_path / "landing"), []
    docs.select(*DOCUMENTS.fieldNames()).repartition(5, "path").write.parquet(landing)
    for files in (1, 4, 1000):
        folder = str(tmp_path / f"history{files}")
        ingest_available(landing_stream(spark, landing, files), universe(spark, _FUNDS), folder,
                         str(tmp_path / f"work{files}"), date(2026, 6, 30))
        found.append(rows(store.read_history(spark, folder), "etf_ticker", "constituent_ticker", "isin"))
    assert found[0] == found[1] == found[2] == [
        ("A", "X", "US0000000011"), ("B", "Q", "US0000000011"), ("B", "Y", None), ("C", "Y", "US0000000029"),
        ("D", "Y", "US0000000037")]


def _two_funds(spark):
    table = history(spark, [
        position("A", 1, "X", 1), position("A", 2, "X", 2), position("A", 3, "X", 3),
        position("B", 1, "X", 1), position("B", 2, "X", 5), position("P", 1, "X", 1)])
    return table, universe(spark, [("A", "gold"), ("B", "copper"), ("P", "gold", False)])


def test_views(spark):
    table, funds = _two_funds(spark)
    found = views.both_views(table, funds)
    assert found.aligned_date.first()[0] == DAY[2]
    changes = found.aligned.section("change").collect()
    assert {(r.etf_ticker, r.curr_as_of_date, r.curr_shares) for r in changes} == {
        ("A", DAY[2], 2.0), ("B", DAY[2], 5.0)}
    latest = found.latest.section("change").collect()
    assert {(r.etf_ticker, r.curr_as_of_date) for r in latest} == {("A", DAY[3]), ("B", DAY[2])}
    assert found.latest.summary().first().asDict() == {
        "total_additions": 0, "total_removals": 0, "total_significant_changes": 2,
        "etfs_processed": 2, "total_cross_etf_signals": 0}


def test_without_any_date_the_aligned_view_is_the_latest(spark):
    table, _ = _two_funds(spark)
    funds = universe(spark, [("A", "gold", False), ("B", "gold", False), ("P", "gold", False)])
    found = views.both_views(table, funds)
    assert found.aligned_date.first()[0] is None
    assert rows(found.aligned.deltas) == rows(found.latest.deltas)


def test_publish(spark, tmp_path):
    import json
    table, funds = _two_funds(spark)
    table = table.withColumn("isin", F.lit("US0000000011"))
    status = spark.createDataFrame([("A", "ingested", DAY[3]), ("B", "skipped", DAY[2])],
                                   "etf_ticker string, status string, as_of_date date")
    publish.publish(views.both_views(table, funds), status, funds, str(tmp_path), "2026-06-30T00:00:00")
    head = json.loads(spark.read.text(str(tmp_path / "head")).first()[0])
    assert (head["default_view"], head["aligned_date"]) == ("aligned", "2026-06-02")
    assert head["coverage"] == {"tracked": 2, "ingested": 1, "skipped": 1, "failed": 0, "external": 0}
    assert json.loads(head["latest_summary"])["total_cross_etf_signals"] == 1
    payload = spark.read.text(str(tmp_path / "payload"))
    assert rows(payload.groupBy("view", "kind").count()) == [
        ("aligned", "change", 2), ("aligned", "signal", 1), ("latest", "change", 2), ("latest", "signal", 1)]
    signal = json.loads(payload.filter("kind = 'signal' AND view = 'latest'").first()[0])
    assert [d["etf_ticker"] for d in signal["etf_details"]] == ["A", "B"]
    assert spark.read.json(str(tmp_path / "funds")).count() == 2


def test_exports_are_ordered_by_date_and_ticker(spark, tmp_path):
    table = history(spark, [position("A", day, ticker, 1) for day in (3, 1, 2) for ticker in "CAB"])
    store.export_history(table, universe(spark, [("A", "gold")]), str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    found = [(r.as_of_date, r.constituent_ticker) for r in written.coalesce(1).collect()]
    assert found == sorted(found) and len(found) == 9
