"""Queries that read provider documents.

Documents of up to 40 parts each are written from the part table in every layout; the
readers have to give back what the parts say.
"""

from datetime import date

from pyspark.sql import functions as F

from holdrift.plans.ingest import ingest, prepared_rows
from holdrift.schemas import DOCUMENTS
from holdrift.sources import documents, history
from holdrift.streaming.incremental import ingest_available, landing_stream
from workload.ingest_queries import scratch
from workload.registry import query
from workload.tables import load

PER_DOCUMENT = 40

# Each part as one holding; a name may hold quotes, commas and markup characters.
_PARTS = f"""
SELECT p_partkey, p_partkey // {PER_DOCUMENT} AS doc, p_partkey % {PER_DOCUMENT} AS line,
  'P' || p_partkey AS ticker, CASE WHEN p_partkey % 7 = 0 THEN 'A "q", <b> & ' || p_name
  WHEN p_partkey % 7 = 3 THEN 'L''Or é – 😀 ' || p_name ELSE p_name END AS name, 'US' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || (p_partkey % 10) AS isin,
  CAST(1000000 + p_partkey AS VARCHAR) AS sedol, p_size || ',000' AS shares,
  '$' || p_size || '.50' AS value, p_size || '.25' AS weight, p_type AS sector,
  DATE '2026-01-01' + CAST((p_partkey // {PER_DOCUMENT}) % 150 AS INTEGER) AS day FROM part"""


def _holdings(spark, folder):
    key = F.col("p_partkey")
    doc = F.expr(f"p_partkey DIV {PER_DOCUMENT}")
    size = F.col("p_size").cast("string")
    return load(spark, folder, "part").select(
        doc.alias("doc"), F.expr(f"p_partkey % {PER_DOCUMENT}").alias("line"),
        F.concat(F.lit("P"), key).alias("ticker"),
        F.when(key % 7 == 0, F.concat(F.lit('A "q", <b> & '), "p_name"))
        .when(key % 7 == 3, F.concat(F.lit("L'Or é – 😀 "), "p_name"))
        .otherwise(F.col("p_name")).alias("name"),
        F.concat(F.lit("US"), F.lpad(key.cast("string"), 9, "0"), key % 10).alias("isin"),
        (key + 1000000).cast("string").alias("sedol"),
        F.concat(size, F.lit(",000")).alias("shares"),
        F.concat(F.lit("$"), size, F.lit(".50")).alias("value"),
        F.concat(size, F.lit(".25")).alias("weight"), F.col("p_type").alias("sector"),
        F.expr(f"date_add(DATE'2026-01-01', CAST((p_partkey DIV {PER_DOCUMENT}) % 150 AS INT))")
        .alias("day"))


def _quoted(value):
    return F.when(value.rlike('[",\n]'), F.concat(
        F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(value)


# How a page may write a character: by name or number, of any length, without a semicolon.
_REFERENCES = {"&": "&amp;", "<": "&lt;", '"': "&#34;", "é": "&eacute;", "–": "&ndash", "'": "&#x0000027;",
               "😀": "&#x0001F600;"}


def _markup(value):
    escaped = value
    for character, reference in _REFERENCES.items():
        escaped = F.replace(escaped, F.lit(character), F.lit(reference))
    return F.concat(F.lit("<td> <i>"), escaped, F.lit("</i> </td>"))


def _bound(spark, folder, record, separator="\n"):
    """One row per document with its records joined; a document has 40 at most."""
    rows = _holdings(spark, folder).withColumn("record", record)
    return rows.groupBy("doc", "day").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("line", "record"))), lambda r: r["record"]), separator).alias("body"))


def _documents(docs, layout, content, given=None, fund=None):
    fund = F.concat(F.lit("D"), "doc") if fund is None else fund
    return docs.select(
        F.concat(F.lit(layout + "/"), "doc").alias("path"), fund.alias("etf_ticker"),
        F.lit(layout).alias("layout"), content.alias("content"),
        (F.lit(None).cast("string") if given is None else given).alias("given_date"))


def _csv(*columns):
    return F.concat_ws(",", *[_quoted(F.col(c) if isinstance(c, str) else c) for c in columns])


def _lines(*parts):
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _day(form):
    return F.date_format("day", form)


def ishares(spark, folder):
    docs = _bound(spark, folder, _csv("ticker", "name", "sector", "isin", "value", "weight", "shares"),
                  "\r\n")
    head = "Ticker,Name,Sector,ISIN,Market Value,Weight (%),Shares"
    return _documents(docs, "ishares", F.concat_ws(
        "\r\n", F.lit("Fund of parts"), F.concat(F.lit('"Holdings as of '), _day("MMM dd, yyyy"), F.lit('"')),
        F.lit(" "), F.lit(head), F.col("body"), F.lit(",,,,,,")))


def globalx(spark, folder):
    docs = _bound(spark, folder, _csv("weight", "ticker", "name", "sedol", "value", "shares"))
    return _documents(docs, "globalx", _lines(
        F.concat(F.lit("Parts as of "), _day("MM/dd/yyyy")),
        "% of Net Assets,Ticker,Name,SEDOL,Market Value ($),Shares Held", F.col("body")))


def globalx_eu(spark, folder):
    docs = _bound(spark, folder, _csv(_day("yyyy-MM-dd"), "ticker", "name", "isin", "shares", "weight"))
    return _documents(docs, "globalx_eu", _lines(
        "AS_OF_DATE,TICKER,NAME,ISIN,SHARES_HELD,NET_ASSETS", F.col("body")))


def vaneck(spark, folder):
    docs = _bound(spark, folder, _csv("line", "name", "ticker", "value", "weight", "sector"))
    return _documents(docs, "vaneck", _lines(
        F.concat(F.lit("As of: "), _day("yyyy-MM-dd")),
        "Number,Holding Name,Holding Ticker,Market Value (USD),% of Net Assets,Sector", F.col("body")))


def betashares(spark, folder):
    docs = _bound(spark, folder, _csv("ticker", "name", "weight", "shares", "value"))
    return _documents(docs, "betashares", _lines(
        "Fund,Parts", F.concat(F.lit("Date,"), _day("yyyy-MM-dd")), "",
        "Ticker,Name,Weight (%),Shares/Units (#),Market Value (AUD)", F.col("body")))


def amplify(spark, folder):
    fund = F.concat(F.lit("d"), F.expr("CASE WHEN line % 2 = 0 THEN doc ELSE doc + 1000000 END"))
    docs = _bound(spark, folder, _csv(fund, "ticker", "name", "shares", "value", "weight",
                                      F.lit("Equity"), _day("MM/dd/yyyy")))
    return _documents(docs, "amplify", _lines(
        "Account,StockTicker,SecurityName,Shares,MarketValue,Weightings,SecurityType,Date",
        F.col("body")))


def sprott_addresses(spark, folder):
    docs = _bound(spark, folder, _csv("name", "value", "ticker", "sedol", "shares", "weight"))
    text = _lines("Security,Market Value,Symbol,SEDOL,Quantity,Weight", F.col("body"))
    address = F.concat(F.lit("data:application/csv;charset=utf-8,"), F.url_encode(text))
    # URI encoding leaves an apostrophe as it is.
    address = F.replace(F.replace(address, F.lit("+"), F.lit("%20")), F.lit("%27"), F.lit("'"))
    return _documents(docs, "sprott", F.concat(F.lit('<a href="'), address, F.lit('">x</a>')),
                      given=_day("M/d/yyyy"))


def sheet(spark, folder):
    docs = _bound(spark, folder, _csv("name", "ticker", "sedol", "weight", "sector", "shares"))
    return _documents(docs, "sheet", _lines(
        "Fund Name:,Parts,,,,", F.concat(F.lit("Holdings:,As of "), _day("dd-MMM-yyyy"), F.lit(",,,,")),
        ",,,,,", "Name,Ticker,SEDOL,Weight,Sector,Shares Held", F.col("body"), ",,,,,",
        ",,,,,nan"))


def _table_row(*columns):
    return F.concat(F.lit("<tr>"), *[_markup(F.col(c)) for c in columns], F.lit("</tr>"))


def page_table(spark, folder):
    docs = _bound(spark, folder, _table_row("ticker", "name", "weight", "shares"))
    return _documents(docs, "page_table", F.concat(
        F.lit("<!DOCTYPE html><html><body><script>as of 2001-01-01</script><p>Data as of <b>"),
        _day("MM/dd/yyyy"), F.lit("</b></p><table><tr><th>Key</th></tr><tr><td>1</td></tr></table>"
                                  "<table class='h'><tr><th>Code</th><th>Security</th><th>Weight (%)"
                                  "</th><th>Units</th></tr>"),
        F.col("body"), F.lit("<tr><td>Total</td></tr></table></body></html>")))


def placed_page_table(spark, folder):
    docs = _bound(spark, folder, _table_row("name", "value", "ticker", "sedol", "shares", "weight"))
    return _documents(docs, "placed_page_table", F.concat(
        F.lit("<p>Prices As of 1/2/2003</p><p>Holdings <b>As of</b> "), _day("M/d/yyyy"),
        F.lit("</p><table><thead><tr><td>Security</td><td>Market Value</td><td>Symbol</td>"
              "<td>SEDOL</td><td>Quantity</td><td>Weight %</td></tr></thead><tbody>"),
        F.col("body"), F.lit("</tbody></table>")))


def columnar_json(spark, folder):
    rows = _holdings(spark, folder)
    listed = {"ticker": "ticker", "issueName": "name", "isin": "isin", "unitsHeld": "shares",
              "marketValue": "value", "holdingPercent": "weight"}
    columns = [
        F.struct(F.transform(
            F.sort_array(F.collect_list(F.struct("line", F.col(column).alias("v")))),
            lambda r: r["v"]).alias("formattedValue")).alias(point)
        for point, column in listed.items()]
    docs = rows.groupBy("doc", "day").agg(F.struct(*columns).alias("points"))
    points = F.struct(*[F.col(f"points.{p}").alias(p) for p in listed],
                      F.struct(F.array(_day("yyyyMMdd")).alias("formattedValue")).alias("asOfDate"))
    for step in ("dataPointsByNameMap", "all", "containersByNameMap", "holdings", "componentsByNameMap"):
        points = F.struct(points.alias(step))
    return _documents(docs, "columnar_json", F.to_json(points))


def row_json(spark, folder):
    item = F.struct(
        F.when(F.col("line") % 2 == 0, F.col("ticker")).otherwise("").alias("Label"),
        F.col("ticker").alias("HoldingTicker"), F.col("name").alias("HoldingName"),
        F.col("isin").alias("ISIN"), F.col("shares").alias("Shares"), F.col("value").alias("MV"),
        F.col("weight").cast("double").alias("Weight"), F.lit("").alias("SecurityType"),
        F.lit("Common Stock").alias("AssetClass"))
    docs = _holdings(spark, folder).withColumn("item", item).groupBy("doc", "day").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("line", "item"))),
                    lambda r: r["item"]).alias("items"))
    return _documents(docs, "row_json", F.to_json(F.struct(F.struct(
        F.col("items").alias("Holdings"), F.lit(False).alias("IsTopTen"),
        _day("yyyy-MM-dd").alias("AsOfDate")).alias("data"))))


# What each layout states: field -> SQL over the parts; fields left out are NULL.
_STATED = {
    "ishares": dict(constituent_ticker="ticker", constituent_name="name", sector="sector",
                    isin="isin", market_value="value", weight_pct="weight", shares_held="shares",
                    as_of_date="strftime(day, '%b %d, %Y')"),
    "globalx": dict(constituent_ticker="ticker", constituent_name="name", sedol="sedol",
                    market_value="value", weight_pct="weight", shares_held="shares",
                    currency="'USD'", as_of_date="strftime(day, '%m/%d/%Y')"),
    "globalx_eu": dict(constituent_ticker="ticker", constituent_name="name", isin="isin",
                       weight_pct="weight", shares_held="shares", currency="'USD'",
                       as_of_date="strftime(day, '%Y-%m-%d')"),
    "vaneck": dict(constituent_ticker="ticker", constituent_name="name", market_value="value",
                   weight_pct="weight", sector="sector", as_of_date="strftime(day, '%Y-%m-%d')"),
    "betashares": dict(constituent_ticker="ticker", constituent_name="name", weight_pct="weight",
                       shares_held="shares", market_value="value", currency="'AUD'",
                       as_of_date="strftime(day, '%Y-%m-%d')"),
    "amplify": dict(constituent_ticker="ticker", constituent_name="name", weight_pct="weight",
                    shares_held="shares", market_value="value", asset_class="'Equity'",
                    currency="'USD'", as_of_date="strftime(day, '%m/%d/%Y')"),
    "sprott": dict(constituent_ticker="ticker", constituent_name="name", sedol="sedol",
                   weight_pct="weight", shares_held="shares", market_value="value",
                   currency="'USD'", as_of_date="strftime(day, '%Y-%m-%d')"),
    "sheet": dict(constituent_ticker="ticker", constituent_name="name", sedol="sedol",
                  weight_pct="weight", sector="sector", shares_held="shares",
                  as_of_date="strftime(day, '%d-%b-%Y')"),
    "page_table": dict(constituent_ticker="ticker", constituent_name="name", weight_pct="weight",
                       shares_held="shares", as_of_date="strftime(day, '%m/%d/%Y')"),
    "placed_page_table": dict(constituent_ticker="ticker", constituent_name="name", sedol="sedol",
                              weight_pct="weight", shares_held="shares", market_value="value",
                              currency="'USD'", as_of_date="strftime(day, '%Y-%m-%d')"),
    "columnar_json": dict(constituent_ticker="ticker", constituent_name="name", isin="isin",
                          weight_pct="weight", shares_held="shares", market_value="value",
                          as_of_date="strftime(day, '%Y%m%d')"),
    "row_json": dict(constituent_ticker="ticker", constituent_name="name", isin="isin",
                     weight_pct="weight", shares_held="shares", market_value="value",
                     asset_class="'Common Stock'", as_of_date="strftime(day, '%Y-%m-%d')"),
}
_FIELDS = ["constituent_ticker", "constituent_name", "isin", "sedol", "shares_held", "market_value",
           "weight_pct", "currency", "sector", "country", "asset_class", "as_of_date"]


def _stated_sql(layout, where="TRUE", line="line"):
    told = _STATED[layout]
    fields = ", ".join(f"{told.get(f, 'CAST(NULL AS VARCHAR)')} AS {f}" for f in _FIELDS)
    return (f"SELECT '{layout}/' || doc AS path, 'D' || doc AS etf_ticker, '{layout}' AS layout, "
            f"{line} AS line, {fields} FROM ({_PARTS}) WHERE {where}")


def _register(layout, make, where="TRUE", line="line", change=None):
    @query(f"read_{layout}", _stated_sql(layout, where, line))
    def read(spark, folder):
        docs = make(spark, folder)
        docs = change(docs) if change else docs
        return documents.raw_rows(documents.READERS.get(layout, documents.read_delimited)(docs))


for _layout, _make in [
    ("ishares", ishares), ("globalx", globalx), ("globalx_eu", globalx_eu), ("vaneck", vaneck),
    ("betashares", betashares), ("sheet", sheet), ("page_table", page_table),
    ("placed_page_table", placed_page_table), ("columnar_json", columnar_json),
    ("row_json", row_json),
]:
    _register(_layout, _make, where={"row_json": f"""doc IN (SELECT p_partkey // {PER_DOCUMENT}
        FROM part GROUP BY 1 HAVING count(*) > 10)"""}.get(_layout, "TRUE"))
_register("amplify", amplify, where="line % 2 = 0", line="line // 2")
_register("sprott", sprott_addresses, change=lambda docs: documents.decoded_documents(docs).drop("part"))


@query("read_multi_fund_feed", f"""
SELECT 'amplify/' || doc AS path, 'D' || CASE WHEN line % 2 = 0 THEN doc ELSE doc + 1000000 END
  AS etf_ticker, line, ticker AS constituent_ticker, name AS constituent_name FROM ({_PARTS})""")
def read_multi_fund_feed(spark, folder):
    feed = amplify(spark, folder).withColumn("etf_ticker", F.lit(None).cast("string"))
    return documents.feed_rows(documents.read_delimited(feed)).select(
        "path", "etf_ticker", "line", "constituent_ticker", "constituent_name")


# Documents of many kinds at once, some of them broken: every eleventh is a web page instead
# of text, every thirteenth has an unknown layout, every seventeenth no header.
_KINDS = [("ishares", ishares), ("globalx", globalx), ("betashares", betashares), ("row_json", row_json)]
_KIND_SQL = "CASE doc % 4 " + " ".join(
    f"WHEN {i} THEN '{layout}'" for i, (layout, _) in enumerate(_KINDS)) + " END"


def _mixed(spark, folder):
    found = None
    number = F.substring("etf_ticker", 2, 20).cast("long")
    for i, (_, make) in enumerate(_KINDS):
        own = make(spark, folder).filter(number % 4 == i)
        found = own if found is None else found.unionByName(own)
    return found.withColumns({
        "layout": F.when(number % 13 == 5, "unheard").otherwise(F.col("layout")),
        "content": F.when(number % 11 == 3, "<html>wait</html>").when(
            number % 17 == 2, "no header here").otherwise(F.col("content")),
    })


_READ_STATUS = f"""
SELECT doc, {_KIND_SQL} || '/' || doc AS path, 'D' || doc AS etf_ticker,
  CASE WHEN doc % 13 = 5 THEN 'unheard' ELSE {_KIND_SQL} END AS layout, day, n, sizes,
  CASE WHEN doc % 13 = 5 THEN 'unknown layout'
    WHEN doc % 11 = 3 THEN CASE WHEN doc % 4 = 3 THEN 'no data' ELSE 'web page instead of data' END
    WHEN doc % 17 = 2 THEN CASE WHEN doc % 4 = 3 THEN 'no data' ELSE 'no header line' END
    WHEN doc % 4 = 3 AND n < 11 THEN 'top holdings only' END AS reason
FROM (SELECT doc, day, count(*) AS n, count(DISTINCT name) AS sizes FROM ({_PARTS}) GROUP BY ALL)"""


@query("document_outcomes", f"""
SELECT path, etf_ticker, layout, CASE WHEN reason IS NULL THEN 'fetched' ELSE 'failed' END AS status,
  reason AS error FROM ({_READ_STATUS})""")
def document_outcomes(spark, folder):
    return documents.outcomes(documents.read_documents(_mixed(spark, folder)))


@query("rejected_documents", f"""
SELECT path, etf_ticker, layout, reason FROM ({_READ_STATUS}) WHERE reason IS NOT NULL""")
def rejected_documents(spark, folder):
    return documents.rejects(documents.read_documents(_mixed(spark, folder)))


# --- whole ingest runs ------------------------------------------------------------------

_RUN_DATE = date(2026, 4, 30)


def _funds(spark, folder):
    docs = load(spark, folder, "part").select(
        F.expr(f"p_partkey DIV {PER_DOCUMENT}").alias("doc")).distinct()
    number = F.col("doc")
    return docs.select(
        F.concat(F.lit("D"), number).alias("etf_ticker"), F.lit("mixed").alias("issuer"),
        F.when(number % 2 == 0, "gold").otherwise("copper").alias("commodity_vertical"),
        F.lit(None).cast("string").alias("fund_page_url"), (number % 19 == 7).alias("external"),
        F.when(number % 23 == 6, False).alias("enabled"))


_INGESTED = f"""
SELECT *, CASE WHEN reason IS NOT NULL THEN 'failed' WHEN day > DATE '2026-04-30' THEN 'future_date'
  ELSE 'ingested' END AS status FROM ({_READ_STATUS})"""


@query("ingest_run", f"""
SELECT etf_ticker, path, CASE WHEN doc % 2 = 0 THEN 'gold' ELSE 'copper' END AS commodity_vertical,
  status, CASE WHEN status = 'ingested' THEN day END AS as_of_date,
  CASE WHEN status = 'ingested' THEN n ELSE 0 END AS n_today,
  CASE status WHEN 'failed' THEN reason WHEN 'future_date' THEN 'dated after the run' END AS error
FROM ({_INGESTED}) WHERE doc % 23 <> 6""")
def ingest_run(spark, folder):
    return ingest(_mixed(spark, folder), _funds(spark, folder), scratch(spark, "ingest"), _RUN_DATE)


@query("ingest_run_again", f"""
SELECT CASE status WHEN 'ingested' THEN 'skipped' ELSE status END AS status, count(*) AS n,
  CAST(0 AS BIGINT) AS n_today FROM ({_INGESTED}) WHERE doc % 23 <> 6 GROUP BY 1""")
def ingest_run_again(spark, folder):
    target = scratch(spark, "ingest")
    docs, funds = _mixed(spark, folder), _funds(spark, folder)
    ingest(docs, funds, target, _RUN_DATE)
    return ingest(docs, funds, target, _RUN_DATE).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_today").alias("n_today"))


# Layouts without ISINs are resolved from those of the same run by name.
_RESOLVED = f"""
WITH parts AS ({_PARTS}), kept AS (SELECT p.*, s.reason, s.doc % 4 AS kind FROM parts p
  JOIN ({_READ_STATUS}) s ON s.doc = p.doc WHERE s.reason IS NULL),
known AS (SELECT upper(trim(regexp_replace(regexp_replace(upper(name), '[^A-Z0-9]+', ' ', 'g'), ' +', ' ', 'g')))
    AS key, CASE WHEN min(isin) = max(isin) THEN min(isin) END AS isin
  FROM kept WHERE kind IN (0, 3) GROUP BY 1)
SELECT 'D' || doc AS etf_ticker, ticker AS constituent_ticker, CASE WHEN kind IN (0, 3) THEN k.isin
  ELSE n.isin END AS isin, day AS as_of_date, p_size_value AS market_value, doc, kind
FROM (SELECT *, CAST(replace(value, '$', '') AS DOUBLE) AS p_size_value FROM kept) k
LEFT JOIN known n ON n.key = upper(trim(regexp_replace(regexp_replace(upper(k.name), '[^A-Z0-9]+', ' ', 'g'),
  ' +', ' ', 'g')))"""
_RESOLVED_COLUMNS = ["etf_ticker", "constituent_ticker", "isin", "as_of_date", "market_value"]


@query("resolved_documents", f"SELECT {', '.join(_RESOLVED_COLUMNS)} FROM ({_RESOLVED})")
def resolved_documents(spark, folder):
    _, rows = prepared_rows(_mixed(spark, folder))
    return rows.select(*_RESOLVED_COLUMNS)


@query("resolved_from_history", f"SELECT {', '.join(_RESOLVED_COLUMNS)} FROM ({_RESOLVED}) WHERE kind IN (1, 2)")
def resolved_from_history(spark, folder):
    """Documents without ISINs, resolved from a history that holds those with ISINs."""
    kind = F.substring("etf_ticker", 2, 20).cast("long") % 4
    docs = _mixed(spark, folder)
    _, stated = prepared_rows(docs.filter(kind.isin(0, 3)))
    known = history.with_history_columns(stated)
    _, rows = prepared_rows(docs.filter(kind.isin(1, 2)), known=known)
    return rows.select(*_RESOLVED_COLUMNS)


def streamed(spark, folder, files_per_batch):
    """What the history holds after the mixed documents have landed in eight files."""
    target, landing = scratch(spark, "streamed"), scratch(spark, "landing")
    _mixed(spark, folder).select(*DOCUMENTS.fieldNames()).repartition(8, "path").write.parquet(landing)
    ingest_available(
        landing_stream(spark, landing, files_per_batch), _funds(spark, folder), target,
        scratch(spark, "work"), _RUN_DATE)
    return history.read_history(spark, target).select(*_RESOLVED_COLUMNS)


@query("incremental_ingest", f"""
SELECT {', '.join(_RESOLVED_COLUMNS)} FROM ({_RESOLVED})
WHERE doc IN (SELECT doc FROM ({_INGESTED}) WHERE status = 'ingested')""")
def incremental_ingest(spark, folder):
    return streamed(spark, folder, files_per_batch=3)
