"""One ingest run: documents to new snapshots, with a status per fund."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdrift.operators.normalise import normalised
from holdrift.operators.resolve import fill_isins, isin_lookup
from holdrift.plans.joins import settled
from holdrift.sources import documents, history

BATCH = ("etf_ticker", "path")


def prepared_rows(docs: DataFrame, overrides=None, known: DataFrame | None = None,
                  resolve_first=False, keys: DataFrame | None = None):
    """Document outcomes and normalised rows with ISINs filled; the documents are parsed once."""
    return prepared_parsed(settled(documents.read_documents(docs)), overrides, known, resolve_first, keys)


def prepared_parsed(read: DataFrame, overrides=None, known: DataFrame | None = None,
                    resolve_first=False, keys: DataFrame | None = None):
    """Outcomes and rows of parsed documents, a stored table.

    ISINs come from all rows of this run, or from ``known`` holdings such as the stored
    history. They never come from a part of the run. ``keys``, a kept crosswalk state (``ledger.Ledger.keys``),
    adds to this run's rows those of the history, without reading it.
    """
    raw = documents.raw_rows(read)
    if known is not None:
        lookup = isin_lookup(known, overrides)
        rows = normalised(raw, BATCH, lookup=lookup, resolve_first=resolve_first)
    else:
        rows = settled(normalised(raw, BATCH))
        rows = fill_isins(rows, isin_lookup(rows, overrides, keys))
    return documents.outcomes(read), settled(rows)


def run_status(universe: DataFrame, outcomes: DataFrame, appended: DataFrame) -> DataFrame:
    """Status per active fund and document.

    Funds fed from elsewhere are external, those without a document or with one that
    cannot be read have failed, and a document without usable rows is no data.
    """
    active = universe.filter(F.coalesce(F.col("enabled"), F.lit(True))).select(
        "etf_ticker", "commodity_vertical", F.coalesce("external", F.lit(False)).alias("external"))
    read = outcomes.select(
        "etf_ticker", "path", F.col("status").alias("read_status"), "error")
    joined = active.join(read, "etf_ticker", "left").join(
        appended.withColumnRenamed("status", "append_status"), ["etf_ticker", "path"], "left")
    status = (
        F.when(F.col("append_status").isNotNull(), F.col("append_status"))
        .when(F.col("read_status").isin("fetched", "no_data"), "no_data")
        .when(F.col("external") & F.col("read_status").isNull(), "external")
        .otherwise("failed")
    )
    error = (
        F.when(status == "failed", F.coalesce("error", F.lit("no document")))
        .when((status == "no_data") & F.col("append_status").isNull(), "no usable holdings")
        .when(status == "future_date", "dated after the run")
    )
    return joined.select(
        "etf_ticker", "path", "commodity_vertical", status.alias("status"), "as_of_date",
        F.coalesce("n_today", F.lit(0)).cast("long").alias("n_today"), error.alias("error"))


def ingest(docs: DataFrame, universe: DataFrame, folder: str, run_date, overrides=None,
           known=None, resolve_first=False, append=history.append_snapshots,
           keys=None) -> DataFrame:
    """Reads, normalises, resolves and appends; returns the status per fund and document.

    A repeated run finds the dates stored and appends nothing. ``append``: how rows are stored; with
    ``ledger.append_run`` runs are committed whole and may overlap.
    """
    read = settled(documents.read_documents(docs))
    return ingest_parsed(read, universe, folder, run_date, overrides, known, resolve_first, append, keys)


def ingest_parsed(read: DataFrame, universe: DataFrame, folder: str, run_date, overrides=None,
                  known=None, resolve_first=False, append=history.append_snapshots,
                  keys=None) -> DataFrame:
    """The same for documents that are parsed and stored already."""
    outcomes, rows = prepared_parsed(read, overrides, known, resolve_first, keys)
    appended = append(rows, folder, run_date, BATCH)
    return run_status(universe, outcomes, appended)
