"""Provider documents to raw holdings rows.

Input is a landing table with one document per row (``schemas.DOCUMENTS``). A document is
taken apart within its row: no shuffle is needed until its holdings are spread as rows.
Every reader returns one row per document with ``reason`` (why it was rejected, else NULL),
its ``holdings``, and what it states once for all of them; ``raw_rows`` and ``rejects`` split that.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdrift.fixed_values import (
    AS_OF_PATTERN, COLUMNAR_JSON_FIELDS, COLUMNAR_JSON_PATH, CSV_LAYOUTS, DATA_ADDRESS_BODY,
    DATA_ADDRESS_PATTERN, DATE_LINE_PATTERN, HOLDINGS_AS_OF_PATTERN, HTML_NAME_WORDS, HTML_TABLE_COLUMNS,
    HTML_WEIGHT_WORDS, MIN_FULL_HOLDINGS, PAGE_AS_OF_PATTERN, PAGE_MARKERS, PAGE_STARTS,
    PLACED_TABLE_COLUMNS, PLACED_TABLE_WORDS, RAW_FIELDS, ROW_JSON_FIELDS, SHEET_COLUMNS,
)
from holdrift.functions.once import with_computed
from holdrift.functions.text import (
    SPACES, blank_to_null, bound, contains_any, parse_us_date, strip,
)
from holdrift.plans.joins import local_table
from holdrift.sources import delimited
from holdrift.sources.markup import element_text, elements, page_text, rows_of_cells

_KEYS = ["path", "etf_ticker", "layout"]


# --- facts about a document ---------------------------------------------------------

def looks_like_html(content) -> Column:
    head = F.lower(F.substring(F.ltrim(content, F.lit(SPACES)), 1, 512))
    starts = [head.startswith(start) for start in PAGE_STARTS]
    return reduce(or_, starts + [head.contains(marker) for marker in PAGE_MARKERS])


def _first(content, pattern) -> Column:
    return blank_to_null(F.regexp_extract(content, pattern, 1))


def as_of_text(content) -> Column:
    """The date after the first "as of", as written."""
    return _first(content, AS_OF_PATTERN)


def date_line_text(content) -> Column:
    """The date of a ``Date,2026-06-12`` line."""
    return _first(content, DATE_LINE_PATTERN)


def page_date(content) -> Column:
    """The date after "Holdings As of", else after any "As of"."""
    return parse_us_date(F.coalesce(
        _first(content, HOLDINGS_AS_OF_PATTERN), _first(content, PAGE_AS_OF_PATTERN)))


# --- a reader's result --------------------------------------------------------------

def _read(rows: DataFrame, reason, holdings, date=None, currency=None) -> DataFrame:
    """What a reader returns. A holding is an array of the raw fields, then its account."""
    null = F.lit(None).cast("string")
    return rows.select(
        *_KEYS, reason.alias("reason"), holdings.alias("holdings"),
        (null if date is None else date.cast("string")).alias("document_date"),
        (null if currency is None else currency).alias("document_currency"))


def _spread(read: DataFrame, fund) -> DataFrame:
    rows = read.filter(F.col("reason").isNull()).select(
        "path", "etf_ticker", "layout", "document_date", "document_currency",
        F.posexplode("holdings").alias("line", "stated"))
    fields = {name: F.get("stated", F.lit(i)) for i, name in enumerate(RAW_FIELDS)}
    fields["currency"] = F.coalesce("document_currency", fields["currency"])
    fields["as_of_date"] = F.coalesce(blank_to_null(fields["as_of_date"]), "document_date")
    return rows.select("path", fund.alias("etf_ticker"), "layout", "line",
                       *[value.alias(name) for name, value in fields.items()])


def raw_rows(read: DataFrame) -> DataFrame:
    """The holdings of accepted documents, one row each, with ``line`` as their place."""
    return _spread(read, F.col("etf_ticker"))


def feed_rows(read: DataFrame) -> DataFrame:
    """Rows of multi-fund feeds read once for all funds: each row's account is its fund."""
    return _spread(read, F.upper(strip(F.get("stated", F.lit(len(RAW_FIELDS))))))


def rejects(read: DataFrame) -> DataFrame:
    return read.filter(F.col("reason").isNotNull()).select(*_KEYS, "reason")


def outcomes(read: DataFrame) -> DataFrame:
    """Status per document: fetched, no_data (nothing usable) or failed, with the reason."""
    size = F.coalesce(F.size("holdings"), F.lit(0))
    status = (
        F.when(F.col("reason").isNotNull(), "failed")
        .when(size == 0, "no_data")
        .otherwise("fetched")
    )
    return read.select(*_KEYS, status.alias("status"), F.col("reason").alias("error"))


def _lowered(names):
    return [name.strip().lower() for name in names]


def _names(columns: dict) -> list:
    """For each raw field the lower-case column names that may hold it."""
    return [_lowered(columns.get(name, [])) for name in RAW_FIELDS]


def _picked(records, places) -> Column:
    """The raw fields of every record, by the places of their columns."""
    return F.transform(records, lambda record: F.transform(
        places, lambda place: F.get(record, place)))


# --- delimited text -----------------------------------------------------------------

_TEXTS = T.ArrayType(T.StringType())
_LAYOUT_TABLE = T.StructType([
    T.StructField("layout", T.StringType()),
    T.StructField("header_words", _TEXTS),
    T.StructField("header_words_without_weight", _TEXTS),
    T.StructField("date_rule", T.StringType()),
    T.StructField("loose", T.BooleanType()),
    T.StructField("needs_rows", T.BooleanType()),
    T.StructField("needs_name_or_ticker", T.BooleanType()),
    T.StructField("has_account", T.BooleanType()),
    T.StructField("currency", T.StringType()),
    T.StructField("column_names", T.ArrayType(_TEXTS)),  # of the raw fields, then the account
])


def layout_table(spark: SparkSession) -> DataFrame:
    """One row per delimited layout: how to find its header and its columns."""
    rows = []
    for layout, told in CSV_LAYOUTS.items():
        rows.append([
            layout, told["header"], told.get("header_without_weight"), told["date"],
            told.get("loose", True), told.get("needs_rows", False),
            told.get("needs_name_or_ticker", False), "account" in told,
            told.get("fixed", {}).get("currency"),
            [*_names(told["columns"]), _lowered(told.get("account", []))],
        ])
    return local_table(spark, rows, _LAYOUT_TABLE)


def read_delimited(docs: DataFrame) -> DataFrame:
    """Documents in any of the delimited layouts, read in one pass.

    Columns are located once per document; a record then only picks by place.
    """
    layouts = layout_table(docs.sparkSession)  # a handful of fixed rows
    content = F.col("content")
    rows = with_computed(docs.join(F.broadcast(layouts), "layout"), {
        "html": looks_like_html(content),
        "lines": F.split(delimited.plain_lines(content), "\n"),
        "words": F.when(
            F.lower(content).contains("weight"), F.col("header_words")
        ).otherwise(F.coalesce("header_words_without_weight", "header_words")),
        "as_of": as_of_text(content),
    })
    rows = with_computed(rows, {"start": delimited.header_line(F.col("lines"), F.col("words"))})
    readable = ~F.col("html") & (F.col("start") > 0)
    text = delimited.text_from_line(F.col("lines"), F.col("start"))
    rows = with_computed(rows, {"records": F.when(readable, delimited.records(text))})
    rows = with_computed(rows, {"names": delimited.header_names(F.get("records", F.lit(0)))})
    rows = with_computed(rows, {
        "places": F.transform("column_names", lambda names: delimited.column_position(
            F.col("names"), names, F.col("loose"))),
        "body": F.filter(
            F.slice("records", 2, F.greatest(F.size("records"), F.lit(1))),
            lambda record: delimited.has_text(record, F.size("names"))),
    })
    rows = with_computed(rows, {"stated": _picked("body", F.col("places"))})

    def wanted(holding):
        account = F.upper(strip(F.get(holding, F.lit(len(RAW_FIELDS)))))
        mine = ~F.col("has_account") | F.col("etf_ticker").isNull() | (
            F.coalesce(account, F.lit("")) == F.upper("etf_ticker"))
        told = F.coalesce(blank_to_null(F.get(holding, F.lit(0))),
                          blank_to_null(F.get(holding, F.lit(1)))).isNotNull()
        return mine & (~F.col("needs_name_or_ticker") | told)

    rows = with_computed(rows, {"kept": F.filter("stated", wanted)})
    date = (
        F.when(F.col("date_rule").isin("text", "column_then_text"), F.col("as_of"))
        .when(F.col("date_rule") == "date_line_then_text",
              F.coalesce(date_line_text(content), "as_of"))
        .when(F.col("date_rule") == "given", parse_us_date("given_date").cast("string"))
    )
    reason = (
        F.when(F.col("html"), "web page instead of data")
        .when(F.col("start") == 0, "no header line")
        .when(F.col("needs_rows") & (F.size("kept") == 0), F.when(
            F.col("has_account"), "no rows of this fund").otherwise("no rows"))
    )
    return _read(rows, reason, F.col("kept"), date, F.col("currency"))


def decoded_documents(docs: DataFrame) -> DataFrame:
    """Delimited documents inside ``data:`` addresses, one row per address in a text."""
    addresses = F.transform(
        F.regexp_extract_all(F.col("content"), F.lit(DATA_ADDRESS_PATTERN), F.lit(0)),
        lambda found: F.when(found.rlike("^[\"']"), F.substring(found, F.lit(2), F.length(found) - 2))
        .otherwise(found))
    spread = docs.select(*[c for c in docs.columns if c != "content"],
                         F.posexplode(addresses).alias("part", "address"))
    return with_computed(spread, {"content": decoded_address(F.col("address"))}).drop("address")


def decoded_address(address) -> Column:
    """Text of a ``data:application/csv`` address; NULL if it is none."""
    coded = blank_to_null(F.regexp_extract(address, DATA_ADDRESS_BODY, 1))
    # A plus sign and a stray percent sign stand for themselves.
    literal = F.regexp_replace(F.replace(coded, F.lit("+"), F.lit("%2B")),
                               "%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(literal)


# --- sheets -------------------------------------------------------------------------

def _places(names, columns: dict) -> Column:
    return F.transform(F.lit(_names(columns)), lambda aliases: delimited.column_position(
        names, aliases, F.lit(True)))


def _empty_cell(cell) -> Column:
    return F.coalesce(cell, F.lit("")).isin("", "nan")


def read_sheets(docs: DataFrame) -> DataFrame:
    """Sheets exported as delimited text, with free cells above the header."""
    rows = with_computed(docs, {
        "cells": delimited.records(delimited.plain_lines(F.col("content")))})

    def is_header(row):
        names = delimited.header_names(row)
        return F.array_contains(names, "ticker") & F.exists(names, lambda n: n.contains("weight"))

    rows = with_computed(rows, {
        "start": F.array_position(F.transform("cells", is_header), True).cast("int")})
    above = F.flatten(F.slice("cells", 1, F.greatest(F.col("start") - 1, F.lit(0))))
    rows = with_computed(rows, {
        "names": delimited.header_names(F.get("cells", F.col("start") - 1)),
        "date": as_of_text(F.array_join(F.filter(above, lambda c: ~_empty_cell(c)), " ")),
        "body": F.when(F.col("start") > 0, F.slice("cells", F.col("start") + 1, F.size("cells"))),
    })
    rows = with_computed(rows, {"places": _places(F.col("names"), SHEET_COLUMNS)})
    stated = F.transform(_picked("body", F.col("places")), lambda holding: F.transform(
        holding, lambda cell: F.when(~_empty_cell(cell), cell)))
    rows = with_computed(rows, {"kept": F.filter(stated, lambda h: F.coalesce(
        F.get(h, F.lit(0)), F.get(h, F.lit(1))).isNotNull())})
    reason = F.when(F.col("start") == 0, "no header line").when(F.size("kept") == 0, "no rows")
    return _read(rows, reason, F.col("kept"), F.col("date"))


# --- web pages ----------------------------------------------------------------------

def page_tables(page) -> Column:
    """Tables of a page as structs of header texts and the cell texts of rows with as many cells."""
    def table(markup):
        return bound(F.transform(elements(markup, "th"), element_text), lambda header: F.struct(
            header.alias("header"), rows_of_cells(markup, F.size(header)).alias("rows")))

    return F.transform(elements(page, "table"), table)


def read_pages(docs: DataFrame) -> DataFrame:
    """The first table of a page with a name and a weight column and rows to match."""
    def usable(table):
        names = delimited.header_names(table["header"])
        full = F.filter(table["rows"], lambda row: F.size(row) == F.size(names))
        return F.struct(names.alias("names"), full.alias("rows"))

    def fits(table):
        return (F.exists(table["names"], lambda n: contains_any(n, HTML_NAME_WORDS))
                & F.exists(table["names"], lambda n: contains_any(n, HTML_WEIGHT_WORDS))
                & (F.size(table["rows"]) > 0))

    rows = with_computed(docs, {
        "tables": F.transform(page_tables(F.col("content")), usable),
        "date": as_of_text(page_text(F.col("content"))),
    })
    rows = with_computed(rows, {"table": F.get(F.filter("tables", fits), F.lit(0))})
    rows = with_computed(rows, {"places": _places(F.col("table.names"), HTML_TABLE_COLUMNS)})
    reason = F.when(F.col("table").isNull(), "no holdings table")
    return _read(rows, reason, _picked("table.rows", F.col("places")), F.col("date"))


def read_placed_pages(docs: DataFrame) -> DataFrame:
    """The first table whose header holds all six wanted words; its columns go by place."""
    def heads(table):
        cells = F.flatten(F.transform(elements(table, "thead"), lambda h: elements(h, "td")))
        return delimited.header_names(F.transform(
            F.concat(elements(table, "th"), cells), element_text))

    def fits(table):
        words = F.array(*[F.lit(word) for word in PLACED_TABLE_WORDS])
        return F.forall(words, lambda word: F.exists(
            table["names"], lambda name: F.contains(name, word)))

    rows = with_computed(docs, {
        "tables": F.transform(elements(F.col("content"), "table"), lambda table: F.struct(
            heads(table).alias("names"), table.alias("markup"))),
        "date": page_date(page_text(F.col("content"))),
    })
    rows = with_computed(rows, {"table": F.get(F.filter("tables", fits), F.lit(0))["markup"]})
    body = F.flatten(F.transform(elements(F.col("table"), "tbody"), lambda b: F.transform(
        elements(b, "tr"), lambda r: F.transform(elements(r, "td"), element_text))))

    places = F.lit([PLACED_TABLE_COLUMNS.index(n) if n in PLACED_TABLE_COLUMNS else -1 for n in RAW_FIELDS])
    full = F.filter(body, lambda r: (F.size(r) >= len(PLACED_TABLE_COLUMNS)) & (
        (F.get(r, F.lit(0)) != "") | (F.get(r, F.lit(2)) != "")))
    rows = with_computed(rows, {"kept": full})
    reason = F.when(F.coalesce(F.size("kept"), F.lit(0)) == 0, "no holdings table")
    return _read(rows, reason, _picked("kept", places), F.col("date"), F.lit("USD"))


# --- JSON ---------------------------------------------------------------------------

def read_columnar_json(docs: DataFrame) -> DataFrame:
    """JSON with one array per column; short arrays end in NULLs, the ticker array counts."""
    values = T.StructType([T.StructField("formattedValue", T.ArrayType(T.StringType()))])
    schema = T.StructType([T.StructField(name, values) for name in COLUMNAR_JSON_FIELDS])
    for step in reversed(COLUMNAR_JSON_PATH):
        schema = T.StructType([T.StructField(step, schema)])
    points = "parsed." + ".".join(COLUMNAR_JSON_PATH)
    path = "$." + ".".join(COLUMNAR_JSON_PATH) + ".asOfDate.formattedValue"
    content = F.col("content")
    columns = {canon: F.col(f"{points}.{name}.formattedValue")
               for name, canon in COLUMNAR_JSON_FIELDS.items()}
    rows = with_computed(docs, {
        "parsed": F.from_json(content, schema),
        "date": F.coalesce(F.get_json_object(content, path + "[0]"),
                           F.nullif(F.get_json_object(content, path), F.lit("[]"))),
    })
    none = F.lit(None).cast(_TEXTS)
    rows = with_computed(rows, {
        "columns": F.array(*[columns.get(name, none) for name in RAW_FIELDS])})
    count = F.coalesce(F.size(columns["constituent_ticker"]), F.lit(0))
    lines = F.filter(F.sequence(F.lit(0), count), lambda i: i < count)
    holdings = F.transform(lines, lambda i: F.transform("columns", lambda c: F.get(c, i)))
    reason = F.when(F.col(f"{points}.ticker").isNull(), "no data points")
    return _read(rows, reason, holdings, F.col("date"))


def read_row_json(docs: DataFrame) -> DataFrame:
    """JSON with one object per holding; of a field's properties the first not empty wins."""
    names = [name for options in ROW_JSON_FIELDS.values() for name in options]
    item = T.StructType([T.StructField(name, T.StringType()) for name in names])
    schema = T.StructType([T.StructField("data", T.StructType([
        T.StructField("Holdings", T.ArrayType(item)),
        T.StructField("IsTopTen", T.BooleanType()),
        T.StructField("AsOfDate", T.StringType()),
    ]))])
    rows = with_computed(docs, {"parsed": F.from_json("content", schema)})
    rows = with_computed(rows, {
        "items": F.coalesce("parsed.data.Holdings", F.array().cast(T.ArrayType(item))),
        "date": F.col("parsed.data.AsOfDate"),
    })

    def holding(item):
        values = []
        for name in RAW_FIELDS:
            options = [item[option] for option in ROW_JSON_FIELDS.get(name, [])]
            first = [blank_to_null(option) for option in options[:-1]]
            values.append(F.coalesce(*first, options[-1]) if options
                          else F.lit(None).cast("string"))
        return F.array(*values)

    count = F.size("items")
    reason = (
        F.when(F.col("parsed.data").isNull(), "no data")
        .when(F.coalesce("parsed.data.IsTopTen", F.lit(False))
              | ((count > 0) & (count < MIN_FULL_HOLDINGS)), "top holdings only")
        .when(count == 0, "no rows")
    )
    return _read(rows, reason, F.transform("items", holding), F.col("date"))


# --- all layouts --------------------------------------------------------------------

READERS = {
    "sheet": read_sheets,
    "page_table": read_pages,
    "placed_page_table": read_placed_pages,
    "columnar_json": read_columnar_json,
    "row_json": read_row_json,
}


def read_documents(docs: DataFrame) -> DataFrame:
    """Documents of all layouts; one that cannot be read never stops the others.

    Keep the landing table partitioned by ``layout``: each reader then scans only its own.
    """
    read = read_delimited(docs.filter(F.col("layout").isin(list(CSV_LAYOUTS))))
    for layout, reader in READERS.items():
        read = read.unionByName(reader(docs.filter(F.col("layout") == layout)))
    known = [*CSV_LAYOUTS, *READERS]
    unknown = docs.filter(~F.coalesce(F.col("layout").isin(known), F.lit(False)))
    return read.unionByName(_read(
        unknown, F.lit("unknown layout"), F.lit(None).cast(T.ArrayType(_TEXTS))))
