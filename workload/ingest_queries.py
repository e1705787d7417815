"""Queries about normalising, resolving and storing holdings."""

import uuid
from datetime import date

from pyspark.sql import functions as F

from holdrift.operators import coverage, normalise, resolve, snapshots
from holdrift.plans.joins import checkpoint_folder
from holdrift.sources import history
from workload.registry import query
from workload.sql import sql, typed
from workload.tables import HOLDINGS_EXPRESSIONS, HOLDINGS_SQL, holdings, in_order, load, universe


def scratch(spark, name):
    """A new folder in the shared checkpoint folder."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


# --- normalising ------------------------------------------------------------------------
# Raw rows: the holdings as messy text. A document is a fund and quarter; documents of every
# fifth fund state weights as fractions, and some rows hold nothing but a name.

_EMPTY = "l_partkey % 37 = 0"


def raw_holdings(spark, folder):
    rows = holdings_of_documents(spark, folder)
    empty = F.expr(_EMPTY)
    percent = F.col("l_discount") * 100
    weight = F.when(F.col("l_suppkey") % 5 == 0, percent.cast("int") / 10000).otherwise(percent)

    def unless_empty(value, otherwise="-"):
        return F.when(empty, otherwise).otherwise(value)

    return rows.select(
        "etf_ticker", "path", "l_orderkey", "l_linenumber", "l_partkey",
        unless_empty(F.concat(F.lit("  "), F.coalesce("constituent_ticker", F.lit("N/A")),
                              F.lit("\t"))).alias("constituent_ticker"),
        F.concat("constituent_name", F.lit(" \n")).alias("constituent_name"),
        unless_empty(F.when(F.col("l_partkey") % 13 == 0, "bad isin").otherwise(
            F.lower("isin")), "none").alias("isin"),
        unless_empty(F.concat(F.lit(" "), F.format_number("shares_held", 2))).alias("shares_held"),
        unless_empty(F.concat(F.lit("$"), F.format_number("market_value", 2))).alias("market_value"),
        unless_empty(F.when(F.col("l_partkey") % 29 > 0, F.concat(
            weight.cast("string"), F.lit("%")))).alias("weight_pct"),
        F.lit("USD").alias("currency"), F.lit("--").alias("sector"),
        F.coalesce("country", F.lit("NA")).alias("country"), "asset_class",
        F.date_format("as_of_date", "M/d/yyyy").alias("as_of_date"),
    )


def holdings_of_documents(spark, folder):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount"]
    return load(spark, folder, "lineitem").selectExpr(*keys, *HOLDINGS_EXPRESSIONS).withColumn(
        "path", F.concat_ws("/", "etf_ticker", F.col("as_of_date").cast("string")))


_CLEANED = f"""
SELECT h.etf_ticker, h.etf_ticker || '/' || h.as_of_date AS path, l_orderkey, l_linenumber, l_partkey,
  CASE WHEN NOT ({_EMPTY}) THEN h.constituent_ticker END AS constituent_ticker,
  h.constituent_name, CASE WHEN NOT ({_EMPTY}) AND l_partkey % 13 > 0 THEN h.isin END AS isin,
  CAST(NULL AS VARCHAR) AS sedol,
  CASE WHEN NOT ({_EMPTY}) THEN CAST(h.shares_held AS DOUBLE) END AS shares_held,
  CASE WHEN NOT ({_EMPTY}) THEN CAST(h.market_value AS DOUBLE) END AS market_value,
  CASE WHEN NOT ({_EMPTY}) AND l_partkey % 29 > 0 THEN CASE WHEN l_suppkey % 5 = 0
    THEN CAST(trunc(l_discount * 100) AS DOUBLE) / 10000 ELSE l_discount * 100 END END AS weight_pct,
  'USD' AS currency, CAST(NULL AS VARCHAR) AS sector, h.country,
  nullif(h.asset_class, '') AS asset_class, h.as_of_date
FROM ({{holdings}}) h"""

_KEYED_HOLDINGS = HOLDINGS_SQL.replace(
    "FROM lineitem", ", l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount FROM lineitem")
_CLEANED = _CLEANED.format(holdings=_KEYED_HOLDINGS)
_SCALED = f"""
SELECT * EXCLUDE (weight_pct, total, largest), CASE WHEN total > 0 AND total <= 1.5 AND
  largest <= 1 THEN weight_pct * 100 ELSE weight_pct END AS weight_pct
FROM (SELECT *, sum(weight_pct) OVER (PARTITION BY etf_ticker, path) AS total,
             max(weight_pct) OVER (PARTITION BY etf_ticker, path) AS largest FROM ({_CLEANED}))"""
_KEPT = f"""
SELECT *, constituent_ticker IS NULL AND isin IS NULL AS partial_row FROM ({_SCALED})
WHERE constituent_ticker IS NOT NULL OR isin IS NOT NULL OR weight_pct IS NOT NULL
   OR shares_held IS NOT NULL OR market_value IS NOT NULL"""
_NORMALISED = f"""
SELECT * REPLACE (CASE WHEN instrument_type = 'cash' AND coalesce(isin, '') = '' THEN 'CASH'
                  ELSE isin END AS isin) FROM ({typed(_KEPT)})"""

_BATCH = ["etf_ticker", "path", "l_orderkey", "l_linenumber", "l_partkey"]
_DOCUMENT = ["etf_ticker", "path"]


@query("cleaned_rows", _CLEANED)
def cleaned_rows(spark, folder):
    return normalise.cleaned(raw_holdings(spark, folder), _BATCH)


@query("fractional_documents", f"""
SELECT etf_ticker, path FROM ({_CLEANED}) GROUP BY etf_ticker, path
HAVING sum(weight_pct) > 0 AND sum(weight_pct) <= 1.5 AND max(weight_pct) <= 1""")
def fractional_documents(spark, folder):
    return normalise.fractional_batches(
        normalise.cleaned(raw_holdings(spark, folder), _BATCH), _DOCUMENT)


@query("scaled_weights", _SCALED)
def scaled_weights(spark, folder):
    return normalise.scaled_weights(
        normalise.cleaned(raw_holdings(spark, folder), _BATCH), _DOCUMENT)


@query("normalised_rows", _NORMALISED.replace(
    "SELECT *", "SELECT * EXCLUDE (l_orderkey, l_linenumber, l_partkey)", 1))
def normalised_rows(spark, folder):
    return normalise.normalised(raw_holdings(spark, folder), _DOCUMENT)


@query("partial_rows", f"SELECT partial_row, instrument_type, count(*) AS n FROM ({_NORMALISED}) "
                       "GROUP BY ALL")
def partial_rows(spark, folder):
    return normalise.normalised(raw_holdings(spark, folder), _DOCUMENT).groupBy(
        "partial_row", "instrument_type").agg(F.count(F.lit(1)).alias("n"))


# --- resolving --------------------------------------------------------------------------
# Ten rows per security; some state an ISIN. Every tenth security has two ISINs, and the
# ISIN of every tenth plus one depends on the country.

OVERRIDES = {
    "by_ticker": {"S7": "ZZ0000000071", "S8 US": "ZZ0000000089", "S9:AU": "ZZ0000000097",
                  "s14.x": "ZZ0000000143"},
    "by_name": {"Security 16 Ltd": "ZZ0000000169", "Security 28": "ZZ0000000287"},
}

_LISTED = """
SELECT p_partkey, k, constituent_ticker, constituent_name, country,
  CASE WHEN p_partkey % 6 < 3 THEN code || lpad(CAST(k AS VARCHAR), 9, '0') || '5' END AS isin
FROM (SELECT *, CASE WHEN k % 10 = 0 AND p_size % 2 = 0 THEN 'XA'
                WHEN k % 10 = 1 AND country IS NOT NULL THEN country ELSE 'XB' END AS code FROM (
  SELECT p_partkey, p_size, p_partkey // 10 AS k,
    CASE p_partkey % 4 WHEN 0 THEN 'S' || (p_partkey // 10) || ' US'
      WHEN 1 THEN 's' || (p_partkey // 10) || '.AX' WHEN 2 THEN 'S' || (p_partkey // 10) END
      AS constituent_ticker,
    CASE WHEN p_partkey % 9 > 0 THEN 'Security ' || (p_partkey // 10) ||
      CASE p_partkey % 3 WHEN 0 THEN ' Ltd' WHEN 1 THEN ', Inc.' ELSE '' END END AS constituent_name,
    CASE p_partkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'AU' WHEN 2 THEN 'CA' END AS country
  FROM part))"""


def listed_securities(spark, folder):
    k = F.expr("p_partkey DIV 10")
    rows = load(spark, folder, "part").select(
        "p_partkey", "p_size", k.alias("k"),
        F.expr("""CASE p_partkey % 4 WHEN 0 THEN concat('S', p_partkey DIV 10, ' US')
          WHEN 1 THEN concat('s', p_partkey DIV 10, '.AX')
          WHEN 2 THEN concat('S', p_partkey DIV 10) END""").alias("constituent_ticker"),
        F.expr("""CASE WHEN p_partkey % 9 > 0 THEN concat('Security ', p_partkey DIV 10,
          CASE p_partkey % 3 WHEN 0 THEN ' Ltd' WHEN 1 THEN ', Inc.' ELSE '' END) END""")
        .alias("constituent_name"),
        F.expr("CASE p_partkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'AU' WHEN 2 THEN 'CA' END")
        .alias("country"))
    return rows.withColumn("isin", F.expr("""
        CASE WHEN p_partkey % 6 < 3 THEN concat(
          CASE WHEN k % 10 = 0 AND p_size % 2 = 0 THEN 'XA'
               WHEN k % 10 = 1 AND country IS NOT NULL THEN country ELSE 'XB' END,
          lpad(CAST(k AS STRING), 9, '0'), '5') END""")).drop("p_size")


_KEYS_SQL = f"""
SELECT *, upper(constituent_ticker) AS full_key, CASE WHEN constituent_ticker IS NOT NULL
    THEN 'S' || k END AS base_key,
  CASE WHEN constituent_ticker IS NOT NULL AND country IS NOT NULL THEN 'S' || k || ':' || country
    END AS pair_key, CASE WHEN constituent_name IS NOT NULL THEN 'SECURITY ' || k END AS name_key
FROM ({_LISTED})"""
_CROSSWALK = f"""
SELECT tab AS "table", key, CASE WHEN min(isin) = max(isin) THEN min(isin) END AS isin FROM (
  SELECT 'full' AS tab, full_key AS key, isin FROM keyed UNION ALL
  SELECT 'pair', pair_key, isin FROM keyed UNION ALL
  SELECT 'base', base_key, isin FROM keyed UNION ALL
  SELECT 'name', name_key, isin FROM keyed) WHERE key IS NOT NULL AND isin IS NOT NULL
GROUP BY tab, key"""
_RESOLVED = """
SELECT x.p_partkey, x.isin, x.isin IS NULL AND (x.full_key IS NOT NULL OR x.name_key IS NOT NULL)
    AS needed, o.found AS forced, o.how AS forced_how, f.isin AS f, p.isin AS p, b.isin AS b, n.isin AS n,
  f.key AS fk, p.key AS pk, b.key AS bk, n.key AS nk
FROM keyed x
LEFT JOIN (SELECT p_partkey, CASE
    WHEN pair_key = 'S9:AU' THEN 'ZZ0000000097'
    WHEN base_key = 'S7' THEN 'ZZ0000000071' WHEN base_key = 'S8' THEN 'ZZ0000000089'
    WHEN base_key = 'S14' THEN 'ZZ0000000143'
    WHEN name_key = 'SECURITY 16' THEN 'ZZ0000000169' WHEN name_key = 'SECURITY 28'
    THEN 'ZZ0000000287' END AS found,
  CASE WHEN pair_key = 'S9:AU' THEN 'override_ticker_country'
    WHEN base_key IN ('S7', 'S8', 'S14') THEN 'override_ticker'
    WHEN name_key IN ('SECURITY 16', 'SECURITY 28') THEN 'override_name' END AS how
  FROM keyed) o ON o.p_partkey = x.p_partkey
LEFT JOIN crosswalk f ON f."table" = 'full' AND f.key = x.full_key
LEFT JOIN crosswalk p ON p."table" = 'pair' AND p.key = x.pair_key
LEFT JOIN crosswalk b ON b."table" = 'base' AND b.key = x.base_key
LEFT JOIN crosswalk n ON n."table" = 'name' AND n.key = x.name_key"""
_ANSWERED = """
SELECT p_partkey, isin, needed, CASE WHEN needed THEN coalesce(forced, f, p, b, n) END AS found_isin,
  CASE WHEN needed THEN CASE WHEN forced IS NOT NULL THEN forced_how WHEN f IS NOT NULL THEN
    'ticker_full' WHEN p IS NOT NULL THEN 'ticker_base_country' WHEN b IS NOT NULL THEN 'ticker_base'
    WHEN n IS NOT NULL THEN 'name' END END AS method,
  CASE WHEN NOT needed OR forced IS NOT NULL THEN 0 ELSE
    CAST(f IS NULL AND fk IS NOT NULL AS INT) +
    CAST(f IS NULL AND p IS NULL AND pk IS NOT NULL AS INT) +
    CAST(f IS NULL AND p IS NULL AND b IS NULL AND bk IS NOT NULL AS INT) +
    CAST(f IS NULL AND p IS NULL AND b IS NULL AND n IS NULL AND nk IS NOT NULL AS INT) END AS ambiguous
FROM resolved"""
KEY_PARTS = {"keyed": _KEYS_SQL, "crosswalk": _CROSSWALK, "resolved": _RESOLVED, "answered": _ANSWERED}


@query("isin_crosswalk", sql('SELECT "table", key, isin FROM crosswalk', **KEY_PARTS))
def isin_crosswalk(spark, folder):
    return resolve.crosswalk(listed_securities(spark, folder))


def _resolved(spark, folder):
    rows = listed_securities(spark, folder)
    overrides = resolve.override_table(spark, OVERRIDES)
    return resolve.resolved(rows, resolve.isin_lookup(rows, overrides))


@query("resolved_isins", sql(
    "SELECT p_partkey, found_isin, method, ambiguous, needed FROM answered", **KEY_PARTS))
def resolved_isins(spark, folder):
    return _resolved(spark, folder).select(
        "p_partkey", "found_isin", "method", F.coalesce("ambiguous", F.lit(0)).alias("ambiguous"),
        "needed")


@query("filled_isins", sql(
    "SELECT p_partkey, coalesce(isin, found_isin) AS isin FROM answered", **KEY_PARTS))
def filled_isins(spark, folder):
    rows = listed_securities(spark, folder)
    overrides = resolve.override_table(spark, OVERRIDES)
    return resolve.fill_isins(rows, resolve.isin_lookup(rows, overrides)).select("p_partkey", "isin")


@query("resolution_counts", sql("""
SELECT outcome, n_rows FROM (
  SELECT coalesce(method, 'unresolved') AS outcome, count(*) AS n_rows FROM answered WHERE needed
  GROUP BY 1 UNION ALL
  SELECT 'resolved', count(*) FROM answered WHERE method IS NOT NULL UNION ALL
  SELECT 'ambiguous', CAST(sum(ambiguous) AS BIGINT) FROM answered)""", **KEY_PARTS))
def resolution_counts(spark, folder):
    return resolve.resolution_counts(_resolved(spark, folder))


# --- storing ----------------------------------------------------------------------------

STORED = """as_of_date, etf_ticker, constituent_ticker, constituent_name, isin, sedol,
  CAST(shares_held AS DOUBLE) AS shares_held, CAST(market_value AS DOUBLE) AS market_value,
  CAST(weight_pct AS DOUBLE) AS weight_pct, currency, sector, country, asset_class,
  instrument_type, source"""


@query("stored_columns", sql(f"""
SELECT {STORED.replace('asset_class,', 'NULL AS asset_class,').replace(
    'instrument_type,', 'NULL AS instrument_type,')} FROM holdings"""))
def stored_columns(spark, folder):
    return history.with_history_columns(
        holdings(spark, folder).drop("asset_class", "instrument_type"))


@query("csv_history_scan", sql(f"""
SELECT NULL AS as_of_date, etf_ticker, constituent_ticker,
  'as_of_date, etf_ticker' || chr(10) || coalesce(constituent_name, '') AS constituent_name,
  NULL AS isin, NULL AS sedol, NULL AS shares_held, NULL AS market_value, NULL AS weight_pct, NULL AS currency,
  NULL AS sector, NULL AS country, NULL AS asset_class, NULL AS instrument_type, NULL AS source
FROM holdings WHERE etf_ticker = 'F1' UNION ALL SELECT {STORED.replace('asset_class,', "nullif(asset_class, '') AS asset_class,")} FROM holdings
WHERE source = 'web_csv' UNION ALL SELECT {STORED.replace('asset_class,', 'NULL AS asset_class,').replace(
    'instrument_type,', 'NULL AS instrument_type,')} FROM holdings WHERE source = 'manual'"""))
def csv_history_scan(spark, folder):
    rows = history.with_history_columns(holdings(spark, folder))
    target = scratch(spark, "csv-history")
    options = {"header": True, "escape": '"'}
    rows.filter("source = 'web_csv'").write.csv(f"{target}/typed", **options)
    older = [c for c in reversed(rows.columns) if c not in ("asset_class", "instrument_type")]
    rows.filter("source = 'manual'").select(*older).write.csv(f"{target}/older", **options)
    # A file without dates, and with a name that looks like a header and holds a line break.
    rows.filter("etf_ticker = 'F1'").select(
        "constituent_ticker", "etf_ticker", F.concat(F.lit("as_of_date, etf_ticker\n"), F.coalesce(
            "constituent_name", F.lit(""))).alias("constituent_name")).write.csv(f"{target}/undated", **options)
    return history.read_csv_history(spark, f"{target}/*")


@query("stored_dates", sql("SELECT DISTINCT etf_ticker, as_of_date FROM holdings"))
def stored_dates(spark, folder):
    return history.stored_dates(holdings(spark, folder))


@query("batch_dates", sql("""
SELECT etf_ticker, year(as_of_date) AS year, max(as_of_date) AS as_of_date, count(*) AS n_rows
FROM holdings GROUP BY ALL"""))
def batch_dates(spark, folder):
    rows = holdings(spark, folder).withColumn("year", F.year("as_of_date").cast("long"))
    return history.batch_heads(rows, ("etf_ticker", "year"))


# Stored: the rows of the usual source before 1999. Incoming: all others, as up to three batches per
# fund and quarter, of which the first is ingested, if its date is neither stored nor after the run.
_INCOMING = """
SELECT *, CASE WHEN source = 'web_csv' THEN 0 WHEN country = 'AU' THEN 2 ELSE 1 END AS batch
FROM holdings WHERE source <> 'web_csv' OR as_of_date >= DATE '1999-01-01'"""
_HEADS = """
SELECT etf_ticker, batch, day AS as_of_date, CASE WHEN day > DATE '2001-04-15' THEN 'future_date'
  WHEN stored OR turn > 1 THEN 'skipped' ELSE 'ingested' END AS status, n
FROM (SELECT *, row_number() OVER (PARTITION BY etf_ticker, day ORDER BY quarter, batch) AS turn FROM (
  SELECT i.etf_ticker, i.as_of_date AS quarter, batch, max(i.as_of_date) AS day, count(*) AS n,
    bool_or(EXISTS (SELECT 1 FROM kept k WHERE k.etf_ticker = i.etf_ticker
                    AND k.as_of_date = i.as_of_date)) AS stored
  FROM incoming i GROUP BY ALL))"""
STORE = {"incoming": _INCOMING, "heads": _HEADS, "kept": """
SELECT DISTINCT etf_ticker, as_of_date FROM holdings
WHERE source = 'web_csv' AND as_of_date < DATE '1999-01-01'"""}


def store_case(spark, folder):
    rows = holdings(spark, folder).withColumn("quarter", F.col("as_of_date"))
    incoming = rows.filter("source <> 'web_csv' OR as_of_date >= DATE'1999-01-01'").withColumn(
        "batch", F.when(F.col("source") == "web_csv", 0).when(F.col("country") == "AU", 2).otherwise(1))
    stored = rows.filter("source = 'web_csv' AND as_of_date < DATE'1999-01-01'")
    return incoming, stored


BATCHES = ("etf_ticker", "quarter", "batch")


@query("append_status", sql("""
SELECT etf_ticker, batch, status, CASE WHEN status <> 'future_date' THEN as_of_date END AS as_of_date,
  CASE WHEN status = 'ingested' THEN n ELSE 0 END AS n_today FROM heads""", **STORE))
def append_status(spark, folder):
    incoming, stored = store_case(spark, folder)
    judged = history.judged_heads(
        history.batch_heads(incoming, BATCHES), stored, date(2001, 4, 15), BATCHES)
    return history.status_rows(judged, BATCHES).drop("quarter")


@query("appended_rows", sql(f"""
SELECT {STORED.replace('source', "'web_csv' AS source")} FROM incoming
SEMI JOIN (SELECT * FROM heads WHERE status = 'ingested') h
  ON h.etf_ticker = incoming.etf_ticker AND h.as_of_date = incoming.as_of_date
     AND h.batch = incoming.batch""", **STORE))
def appended_rows(spark, folder):
    incoming, stored = store_case(spark, folder)
    judged = history.judged_heads(
        history.batch_heads(incoming, BATCHES), stored, date(2001, 4, 15), BATCHES)
    return history.new_rows(incoming, judged, BATCHES)


@query("stored_and_appended", sql("""
SELECT as_of_date, count(*) AS n_rows, count(DISTINCT etf_ticker) AS n_funds FROM (
  SELECT as_of_date, etf_ticker FROM holdings
  WHERE source = 'web_csv' AND as_of_date < DATE '1999-01-01' UNION ALL
  SELECT incoming.as_of_date, incoming.etf_ticker FROM incoming
  SEMI JOIN (SELECT * FROM heads WHERE status = 'ingested') h
    ON h.etf_ticker = incoming.etf_ticker AND h.as_of_date = incoming.as_of_date
       AND h.batch = incoming.batch) GROUP BY as_of_date""", **STORE))
def stored_and_appended(spark, folder):
    incoming, stored = store_case(spark, folder)
    target = scratch(spark, "history")
    history.write_history(history.with_history_columns(stored), target)
    for _ in range(2):  # the second run must change nothing
        history.append_snapshots(incoming, target, date(2001, 4, 15), BATCHES)
    return history.read_history(spark, target).groupBy("as_of_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("etf_ticker").alias("n_funds"))


@query("exported_rows", sql(f"""
SELECT {STORED} FROM holdings WHERE source = 'web_csv'
AND etf_ticker IN (SELECT etf_ticker FROM universe WHERE issuer = 'globalx')"""))
def exported_rows(spark, folder):
    funds = universe(spark, folder).filter("issuer = 'globalx'")
    return history.exported(holdings(spark, folder), funds)


@query("export_report", sql("""
SELECT etf_ticker, CAST(count(*) AS BIGINT) AS n_rows, count(DISTINCT as_of_date) AS n_dates
FROM holdings WHERE source = 'web_csv'
AND etf_ticker IN (SELECT etf_ticker FROM universe WHERE issuer = 'globalx') GROUP BY 1"""))
def export_report(spark, folder):
    funds = universe(spark, folder).filter("issuer = 'globalx'")
    return history.export_history(holdings(spark, folder), funds, scratch(spark, "export"))


@query("rows_and_dates", sql("""
SELECT etf_ticker, CAST(count(*) AS BIGINT) AS n_rows, count(DISTINCT as_of_date) AS n_dates
FROM holdings GROUP BY 1"""))
def rows_and_dates(spark, folder):
    return coverage.rows_and_dates(holdings(spark, folder))


_RESTAMPED = typed(
    "SELECT * EXCLUDE (instrument_type, sector), CASE WHEN asset_class = '' THEN "
    "CASE WHEN country = 'AU' THEN 'Cash and/or Derivatives' ELSE 'Materials' END END AS sector, "
    "coalesce(nullif(asset_class, ''), CASE WHEN asset_class = '' THEN "
    "CASE WHEN country = 'AU' THEN 'Cash and/or Derivatives' ELSE 'Materials' END END) AS hint "
    "FROM holdings", label="hint")


def _unstamped(spark, folder):
    sector = F.expr("CASE WHEN asset_class = '' THEN CASE WHEN country = 'AU' "
                    "THEN 'Cash and/or Derivatives' ELSE 'Materials' END END")
    return holdings(spark, folder).withColumn("sector", sector)


@query("restamped_rows", sql(f"SELECT {STORED} FROM restamped", restamped=_RESTAMPED))
def restamped_rows(spark, folder):
    return history.restamped(_unstamped(spark, folder))


@query("rows_per_type", sql("""
SELECT instrument_type, etf_ticker, count(*) AS n_rows, grouping(instrument_type) AS all_types,
  grouping(etf_ticker) AS all_funds FROM restamped GROUP BY ROLLUP (instrument_type, etf_ticker)""",
    restamped=_RESTAMPED))
def rows_per_type(spark, folder):
    found = history.restamp_history(_unstamped(spark, folder), scratch(spark, "restamped"))
    return found.withColumns({c: F.col(c).cast("long") for c in ("all_types", "all_funds")})


@query("fund_dimension", sql(
    "SELECT etf_ticker, issuer, commodity_vertical, external, enabled FROM universe"))
def fund_dimension(spark, folder):
    return universe(spark, folder)


_STATUS = """
SELECT etf_ticker, CASE WHEN external THEN 'external' WHEN s_suppkey % 7 = 0 THEN 'failed'
  WHEN s_suppkey % 7 = 1 THEN 'skipped' WHEN s_suppkey % 7 = 2 THEN 'future_date'
  WHEN s_suppkey % 7 = 3 THEN 'no_data' ELSE 'ingested' END AS status
FROM universe JOIN supplier ON etf_ticker = 'F' || s_suppkey WHERE coalesce(enabled, TRUE)"""


def _status(spark, folder):
    key = F.substring("etf_ticker", 2, 20).cast("long")
    status = (
        F.when(F.col("external"), "external").when(key % 7 == 0, "failed")
        .when(key % 7 == 1, "skipped").when(key % 7 == 2, "future_date")
        .when(key % 7 == 3, "no_data").otherwise("ingested")
    )
    active = universe(spark, folder).filter(F.coalesce("enabled", F.lit(True)))
    return active.select("etf_ticker", status.alias("status"))


@query("coverage_counts", sql("""
SELECT (SELECT count(*) FROM universe WHERE coalesce(enabled, TRUE)) AS tracked,
  count(*) FILTER (WHERE status = 'ingested') AS ingested,
  count(*) FILTER (WHERE status = 'skipped') AS skipped,
  count(*) FILTER (WHERE status IN ('failed', 'no_data', 'future_date')) AS failed,
  count(*) FILTER (WHERE status = 'external') AS external FROM status""", status=_STATUS))
def coverage_counts(spark, folder):
    return coverage.coverage(_status(spark, folder), universe(spark, folder))


@query("fund_freshness", sql("""
SELECT s.etf_ticker, s.status, l.latest_stored, row_number() OVER (ORDER BY s.etf_ticker) AS place
FROM status s LEFT JOIN latest_stored l USING (etf_ticker)""", status=_STATUS))
def fund_freshness(spark, folder):
    dates = snapshots.snapshot_dates(holdings(spark, folder), "web_csv")
    return in_order(coverage.freshness(
        _status(spark, folder), snapshots.latest_date_per_fund(dates), universe(spark, folder)))
