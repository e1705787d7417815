"""What must hold for large data: pruned scans, checked broadcasts, no Python in plans."""

import re

from pyspark.sql import functions as F

from holdrift.operators import consensus, resolve, snapshots
from holdrift.plans import joins, views
from holdrift.sources import documents as sources
from holdrift.sources import history as store
from tests.build import documents, history, position, rows
from __spark_entry__ import queries
from workload import tables

QUERIES = queries()
FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_limit(spark):
    side = spark.range(1000).select("id", F.lit("x" * 100).alias("t"))
    fact = spark.range(100000).withColumn("k", F.col("id") % 1000)
    shuffled = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        small = fact.join(joins.join_side(side).withColumnRenamed("id", "k"), "k")
        large = fact.join(joins.join_side(side, byte_limit=1000).withColumnRenamed("id", "k"), "k")
        assert "BroadcastHashJoin" in plan(small) and "BroadcastHashJoin" not in plan(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", shuffled)
    assert small.count() == large.count() == 100000


def test_results_do_not_depend_on_broadcasts(spark, monkeypatch):
    names = ["daily_deltas", "latest_view_signals", "scaled_weights", "resolved_isins", "appended_rows"]
    small = {name: rows(QUERIES[name](spark, FOLDER)) for name in names}
    original = joins.join_side
    for module in (snapshots, consensus, resolve, store):
        monkeypatch.setattr(module, "join_side", lambda df: original(df, byte_limit=-1))
    from holdrift.operators import normalise
    monkeypatch.setattr(normalise, "join_side", lambda df: original(df, byte_limit=-1))
    for name in names:
        assert rows(QUERIES[name](spark, FOLDER)) == small[name], name


def test_delta_query_reads_few_columns_and_shuffles_once(spark):
    found = views.daily_deltas(tables.holdings(spark, FOLDER), tables.universe(spark, FOLDER))
    text = plan(found)
    assert text.count("Exchange hashpartitioning") == 1
    assert "l_tax" not in text and "l_orderkey" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_stored_history_is_pruned_by_date(spark, tmp_path):
    folder = str(tmp_path / "history")
    store.write_history(store.with_history_columns(tables.holdings(spark, FOLDER)), folder)
    found = views.daily_deltas(store.read_history(spark, folder), tables.universe(spark, FOLDER))
    assert "dynamicpruning" in plan(found)


def test_stored_history_gives_the_same_deltas(spark, tmp_path):
    folder, funds = str(tmp_path / "history"), tables.universe(spark, FOLDER)
    store.write_history(store.with_history_columns(tables.holdings(spark, FOLDER)), folder)

    def shown(table):
        return rows(tables.as_doubles(views.daily_deltas(table, funds, as_of="1996-01-01")))

    wanted, stored = shown(tables.holdings(spark, FOLDER)), store.read_history(spark, folder)
    assert shown(stored) == wanted
    assert shown(stored.repartition(13)) == wanted  # sums do not depend on the order of rows


def test_a_large_date_read_by_one_task_is_written_by_several(spark, tmp_path, monkeypatch):
    """A small one stays in one file."""
    table = store.with_history_columns(spark.range(20000).coalesce(1).select(
        F.expr("CASE WHEN id < 19000 THEN DATE'2026-06-01' END").alias("as_of_date"), F.lit("HOT").alias("etf_ticker"),
        F.concat(F.lit("T"), F.col("id")).alias("constituent_ticker")))
    sizes = [f"spark.sql.adaptive.{name}" for name in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")]

    def rows_per_file(folder):
        store.write_history(table, folder)
        written = store.read_history(spark, folder)
        assert rows(written, "constituent_ticker", "as_of_date") == rows(table, "constituent_ticker", "as_of_date")
        files = written.filter("as_of_date IS NOT NULL").groupBy(F.input_file_name()).count()
        return [n for _, n in files.collect()]

    try:
        for name in sizes:
            spark.conf.set(name, "16k")
        assert rows_per_file(str(tmp_path / "small")) == [19000]
        monkeypatch.setattr(store, "PART_ROWS", 1000, raising=False)
        large = rows_per_file(str(tmp_path / "large"))
    finally:
        for name in sizes:
            spark.conf.unset(name)
    assert len(large) > 1 and max(large) < 19000 * 2 / 3


def test_history_deltas_shuffle_the_rows_once(spark):
    table, funds = tables.holdings(spark, FOLDER), tables.universe(spark, FOLDER)
    text = plan(views.history_deltas(table, funds))
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*delta_key", text)) == 1


def test_plans_hold_no_python_and_no_cross_join(spark):
    made = {name: QUERIES[name](spark, FOLDER) for name in [
        "latest_view_moves", "aligned_view_signals", "normalised_rows", "resolved_isins",
        "digest_move_lines", "instrument_types", "history_deltas"]}
    made["read_documents"] = sources.read_documents(
        documents(spark, [("p", "F", "ishares", "x"), ("q", "F", "row_json", "{}")]))
    for name, found in made.items():
        text = plan(found)
        for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                     "BroadcastNestedLoopJoin"):
            assert word not in text, (name, word)


def test_crosswalk_keys_are_made_of_distinct_securities(spark):
    """What is sorted for the smallest and largest ISIN grows with the securities, not with the rows."""
    table = tables.holdings(spark, FOLDER)
    text = plan(resolve.crosswalk_state(table))
    assert "SortAggregate" in text[:text.index("Generate")]
    assert "HashAggregate" in text[text.index("Generate"):]
    assert rows(resolve.crosswalk_state(table.union(table))) == rows(resolve.crosswalk_state(table))


def test_one_fund_with_most_rows(spark):
    """A hot fund, date and position: lots are combined before the shuffle, nothing is lost."""
    lots = spark.range(200000).select(
        F.lit("HOT").alias("etf_ticker"), F.lit("web_csv").alias("source"),
        F.expr("CASE WHEN id % 2 = 0 THEN DATE'2026-06-01' ELSE DATE'2026-06-02' END").alias("as_of_date"),
        F.lit("X").alias("constituent_ticker"), F.lit("X").alias("constituent_name"),
        F.lit("US0000000011").alias("isin"), F.lit(1.0).alias("shares_held"),
        F.lit(1.0).alias("market_value"), F.lit(0.0).alias("weight_pct"),
        F.lit("equity").alias("instrument_type"))
    rest = history(spark, [position("A", 1, "X", 1), position("A", 2, "X", 2)]).select(*lots.columns)
    dates = snapshots.snapshot_dates(lots.unionByName(rest))
    assert dates.count() == 4
    found = views.daily_deltas(lots.unionByName(rest), spark.createDataFrame(
        [], "etf_ticker string, commodity_vertical string"))
    assert rows(found, "etf_ticker", "prev_shares", "curr_shares") == [
        ("A", 1.0, 2.0), ("HOT", 100000.0, 100000.0)]
