"""Queries about cleaning, classifying and showing text and numbers.

Spark reads messy text made from the given tables; the SQL states what it has to yield.
"""

from pyspark.sql import functions as F

from holdrift.fixed_values import (
    CASH_WORDS, COMPANY_FORM_WORDS, CURRENCY_CODES, CURRENCY_WORDS, DERIVATIVE_WORDS, LABEL_RULES,
    TEXT_PLACEHOLDERS,
)
from holdrift.functions import display, text
from holdrift.functions.classify import is_tracked_type, label_type, with_instrument_type
from holdrift.operators.coverage import sort_key
from holdrift.sources import documents
from workload.registry import query
from workload.sql import LABEL_TYPE, any_of, short_shares_sql, typed
from workload.tables import load


# --- cleaning -------------------------------------------------------------------------

@query("clean_text", """
SELECT c_custkey, CASE WHEN c_custkey % 10 < 8 THEN NULL ELSE c_name END AS cleaned FROM customer""")
def clean_text(spark, folder):
    words = F.array(*[F.lit(w) for w in TEXT_PLACEHOLDERS])
    word = F.get(words, (F.col("c_custkey") % 10).cast("int"))
    stated = F.when(F.col("c_custkey") % 3 == 0, F.upper(word)).otherwise(word)
    messy = F.concat(F.lit(" \t"), F.coalesce(stated, "c_name"), F.lit(" \n"))
    return load(spark, folder, "customer").select(
        "c_custkey", text.clean_text(messy).alias("cleaned"))


@query("strip_whole_texts", r"""
SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS stripped FROM documents""")
def strip_whole_texts(spark, folder):
    return load(spark, folder, "documents").select("doc_id", text.strip("text").alias("stripped"))


@query("parse_numbers", """
SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN o_totalprice WHEN 1 THEN -o_totalprice
  WHEN 2 THEN o_totalprice WHEN 3 THEN o_totalprice WHEN 8 THEN o_orderkey * 1000.0 END AS parsed
FROM orders""")
def parse_numbers(spark, folder):
    price = F.col("o_totalprice")
    grouped = F.format_number(price, 2)
    messy = F.expr("o_orderkey % 9")
    stated = (
        F.when(messy == 0, F.concat(F.lit("$"), grouped))
        .when(messy == 1, F.concat(F.lit(" ("), grouped, F.lit(")")))
        .when(messy == 2, F.concat(price.cast("decimal(18,2)").cast("string"), F.lit(" %")))
        .when(messy == 3, F.concat(F.lit("\t"), grouped, F.lit("\n")))
        .when(messy == 4, "N/A").when(messy == 5, "--").when(messy == 6, "12 abc")
        .when(messy == 7, "NaN")
        .otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit("e3")))
    )
    return load(spark, folder, "orders").select(
        "o_orderkey", text.parse_number(stated).alias("parsed"))


@query("parse_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 8 THEN NULL
  WHEN o_orderkey % 9 = 2 AND day(o_orderdate) <= 12
  THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
  ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def parse_dates(spark, folder):
    formats = ["yyyy-MM-dd", "M/d/yyyy", "d/M/yyyy", "dd-MMM-yyyy", "d-MMM-yy", "d MMM yyyy",
               "MMM d, yyyy", "yyyyMMdd", "MMMM d yyyy"]
    stated = F.lit(None).cast("string")
    for i, form in enumerate(formats):
        stated = F.when(F.col("o_orderkey") % 9 == i,
                        F.date_format("o_orderdate", form)).otherwise(stated)
    # A full month name before a year without comma is a notation no provider's reader knows.
    return load(spark, folder, "orders").select("o_orderkey", text.parse_date(stated).alias("parsed"))


@query("clean_isins", """
SELECT p_partkey, CASE p_partkey % 5
  WHEN 0 THEN 'US' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || (p_partkey % 10)
  WHEN 1 THEN 'GB' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || (p_partkey % 10)
  WHEN 2 THEN 'CASH' END AS isin, p_partkey % 5 = 0 AS well_formed FROM part""")
def clean_isins(spark, folder):
    number = F.lpad(F.col("p_partkey").cast("string"), 9, "0")
    digit = (F.col("p_partkey") % 10).cast("string")
    kind = F.expr("p_partkey % 5")
    stated = (
        F.when(kind == 0, F.concat(F.lit("US"), number, digit))
        .when(kind == 1, F.concat(F.lit(" gb"), number, digit))
        .when(kind == 2, F.lit("Cash"))
        .when(kind == 3, F.concat(F.lit("US"), number))
        .otherwise("n/a")
    )
    return load(spark, folder, "part").select(
        "p_partkey", text.clean_isin(stated).alias("isin"), text.is_isin(stated).alias("well_formed"))


@query("ticker_parts", """
SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN upper(split_part(p_name, ' ', 1)) ||
    CASE p_partkey % 4 WHEN 0 THEN ' US' WHEN 1 THEN '.AX' ELSE '' END END AS ticker,
  CASE WHEN p_partkey % 4 < 3 THEN upper(split_part(p_name, ' ', 1)) END AS base FROM part""")
def ticker_parts(spark, folder):
    root = F.split_part("p_name", F.lit(" "), F.lit(1))
    kind = F.expr("p_partkey % 4")
    stated = (
        F.when(kind == 0, F.concat(root, F.lit(" us ")))
        .when(kind == 1, F.concat(F.lit("\t"), root, F.lit(".ax")))
        .when(kind == 2, root).otherwise("  ")
    )
    return load(spark, folder, "part").select(
        "p_partkey", text.normal_ticker(stated).alias("ticker"), text.base_ticker(stated).alias("base"))


@query("normal_names", """
SELECT p_partkey, CASE WHEN p_partkey % 5 < 4 THEN upper(p_name) ||
  CASE WHEN p_partkey % 5 = 3 THEN ' S A' ELSE '' END END AS name FROM part""")
def normal_names(spark, folder):
    kind = F.expr("p_partkey % 5")
    stated = (
        F.when(kind == 0, F.concat("p_name", F.lit(" Ltd.")))
        .when(kind == 1, F.concat(F.lit("The-Co "), F.regexp_replace("p_name", " ", " & ")))
        .when(kind == 2, F.concat("p_name", F.lit(", Inc")))
        .when(kind == 3, F.concat("p_name", F.lit(" S.A.")))
        .otherwise("PLC")
    )
    stated = F.regexp_replace(stated, "^The-", "")
    return load(spark, folder, "part").select("p_partkey", text.normal_name(stated).alias("name"))


_FORMS = ", ".join(f"'{word}'" for word in COMPANY_FORM_WORDS)


@query("names_of_whole_texts", rf"""
SELECT turn, conv_id, nullif(array_to_string(list_filter(
  regexp_split_to_array(regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-Z0-9]+', ' ', 'g'), ' '),
  lambda w: w <> '' AND w NOT IN ({_FORMS})),
  ' '), '') AS name FROM conversations""")
def names_of_whole_texts(spark, folder):
    return load(spark, folder, "conversations").select(
        "conv_id", "turn", text.normal_name("text").alias("name"))


@query("text_search", """
SELECT doc_id FROM documents
WHERE contains(lower(lang || ' ' || coalesce(source, '') || ' ' || text), 'src1 the')
   OR contains(lower(lang || ' ' || coalesce(source, '') || ' ' || text), 'ou th')""")
def text_search(spark, folder):
    fields = ["lang", "source", "text"]
    return load(spark, folder, "documents").filter(
        text.search("SRC1 the ", fields) | text.search("ou th", fields)).select("doc_id")


# --- classification -------------------------------------------------------------------

# Inputs made from the rules: each marker, alone and beside others, and the edges.
_MESSY_LABELS = (
    *[f" {words.upper()} a" for words, _ in LABEL_RULES], *[f"Zz {words}" for words, _ in LABEL_RULES[::3]],
    "", None, "unheard of",
)
_NAMES = (
    *[f"Zz {word} Zz" for word in CASH_WORDS[::2] + DERIVATIVE_WORDS[::2] + CURRENCY_WORDS[::2]],
    *[word.upper() for word in CASH_WORDS[1::5] + DERIVATIVE_WORDS[1::5] + CURRENCY_WORDS[1::5]],
    *[f"{a} {b}" for a, b in zip(CURRENCY_WORDS, DERIVATIVE_WORDS[::4] + CASH_WORDS[::4])],
    "Quiet Harbour", "", None,
)
_TICKERS = (*CURRENCY_CODES[::4], f" {CURRENCY_CODES[1].lower()} ", "QHB", "fut", "", None, "put")


def _pick(values, key, step):
    return F.get(F.array(*[F.lit(v) for v in values]), ((key / step).cast("int") % len(values)))


def _pick_sql(values, key, step):
    shown = ", ".join("NULL" if v is None else "'" + v + "'" for v in values)
    return f"([{shown}])[CAST(floor({key} / {step}.0) AS BIGINT) % {len(values)} + 1]"


_STATED = f"""
SELECT l_orderkey, l_linenumber, l_partkey, {_pick_sql(_MESSY_LABELS, 'l_partkey', 1)} AS asset_class,
  {_pick_sql(_NAMES, 'l_orderkey', 1)} AS constituent_name,
  {_pick_sql(_TICKERS, 'l_orderkey', 7)} AS constituent_ticker,
  CASE l_suppkey % 4 WHEN 0 THEN 'US' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '1'
    WHEN 1 THEN 'CASH' WHEN 2 THEN '' END AS isin,
  CASE WHEN l_linenumber > 5 THEN 0 WHEN l_linenumber < 5 THEN l_discount END AS weight_pct,
  CASE WHEN l_linenumber > 4 THEN 0 WHEN l_linenumber < 4 THEN l_extendedprice END AS market_value
FROM lineitem"""
_TYPED = typed(_STATED)


def _stated(spark, folder):
    key, order = F.col("l_partkey"), F.col("l_orderkey")
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        _pick(_MESSY_LABELS, key, 1).alias("asset_class"),
        _pick(_NAMES, order, 1).alias("constituent_name"),
        _pick(_TICKERS, order, 7).alias("constituent_ticker"),
        F.expr("CASE l_suppkey % 4 WHEN 0 THEN concat('US', lpad(l_partkey, 9, '0'), '1') "
               "WHEN 1 THEN 'CASH' WHEN 2 THEN '' END").alias("isin"),
        F.expr("CASE WHEN l_linenumber > 5 THEN 0 WHEN l_linenumber < 5 THEN l_discount END")
        .alias("weight_pct"),
        F.expr("CASE WHEN l_linenumber > 4 THEN 0 WHEN l_linenumber < 4 THEN l_extendedprice END")
        .alias("market_value"),
    )


@query("label_types", f"SELECT l_orderkey, l_linenumber, l_partkey, {LABEL_TYPE} AS label_type "
                      f"FROM ({_STATED})")
def label_types(spark, folder):
    return _stated(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", label_type("asset_class").alias("label_type"))


@query("instrument_types", f"""
SELECT l_orderkey, l_linenumber, l_partkey, instrument_type, instrument_type = 'equity' AS tracked
FROM ({_TYPED})""")
def instrument_types(spark, folder):
    return with_instrument_type(_stated(spark, folder)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "instrument_type",
        is_tracked_type().alias("tracked"))


@query("instrument_types_of_whole_texts", f"""
SELECT doc_id, CASE WHEN {any_of('words', CASH_WORDS)} THEN 'cash'
  WHEN {any_of('words', DERIVATIVE_WORDS)} THEN 'derivative'
  WHEN {any_of('words', CURRENCY_WORDS)} THEN 'fx' ELSE 'equity' END AS instrument_type
FROM (SELECT doc_id, lower(text || ' ' || source) AS words FROM documents)""")
def instrument_types_of_whole_texts(spark, folder):
    rows = load(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("constituent_name"),
        F.col("source").alias("constituent_ticker"),
        F.lit(None).cast("string").alias("isin"), F.lit(None).cast("string").alias("asset_class"),
        F.col("n_chars").cast("double").alias("market_value"), F.lit(1.0).alias("weight_pct"))
    return with_instrument_type(rows).select("doc_id", "instrument_type")


# --- showing --------------------------------------------------------------------------

@query("short_shares", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {short_shares_sql('v')} AS shown FROM (
  SELECT *, (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) * l_extendedprice *
    (CASE l_linenumber WHEN 1 THEN 0.001 WHEN 2 THEN 1 WHEN 3 THEN 1000 WHEN 4 THEN 100000
     ELSE 100 END) AS v FROM lineitem)""")
def short_shares(spark, folder):
    value = F.expr(
        "(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) * l_extendedprice * "
        "(CASE l_linenumber WHEN 1 THEN 0.001D WHEN 2 THEN 1D WHEN 3 THEN 1000D "
        "WHEN 4 THEN 100000D ELSE 100D END)")
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", display.short_shares(value).alias("shown"))


def _away(value, digits):
    """Decimals of a double with exact halves away from zero, as SQL."""
    scaled = f"({value} * {2 ** (digits + 1)})"
    nudge = 2.0 ** -(4 * digits + 4)
    return (f"printf('%.{digits}f', CASE WHEN {scaled} = floor({scaled}) AND "
            f"abs(CAST({scaled} AS HUGEINT) % 2) = 1 THEN {value} + sign({value}) * "
            f"CAST({nudge!r} AS DOUBLE) ELSE {value} END)")


@query("shown_figures", f"""
SELECT o_orderkey, CASE WHEN v >= 0 THEN '+' ELSE '' END || {_away('(v / 64)', 3)} || '%' AS percent,
  {_away('(v / 32)', 2)} || '%' AS weight, CASE WHEN v >= 0 THEN '+$' ELSE '−$' END || CASE
    WHEN abs(v * 4000) >= 1e9 THEN {_away('(abs(v * 4000) / 1e9)', 2)} || 'B'
    WHEN abs(v * 4000) >= 1e6 THEN {_away('(abs(v * 4000) / 1e6)', 2)} || 'M'
    WHEN abs(v * 4000) >= 1e3 THEN {_away('(abs(v * 4000) / 1e3)', 1)} || 'k'
    ELSE {_away('abs(v * 4000)', 0)} END AS money,
  CASE WHEN v > 0 THEN 'pos' WHEN v < 0 THEN 'neg' ELSE 'dim' END AS sign
FROM (SELECT o_orderkey, o_totalprice - 200000 AS v FROM orders)""")
def shown_figures(spark, folder):
    value = F.col("o_totalprice") - 200000
    return load(spark, folder, "orders").select(
        "o_orderkey", display.signed_percent(value / 64).alias("percent"),
        display.weight(value / 32).alias("weight"), display.money(value * 4000).alias("money"),
        display.sign_class(value).alias("sign"))


@query("shown_names", """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_name || ' (' || p_brand || ')' END
  AS label, CASE WHEN length(t) > 12 THEN left(t, 11) || '…' ELSE t END AS clipped
FROM (SELECT *, p_name || ' ' || p_type AS t FROM part)""")
def shown_names(spark, folder):
    ticker = F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand"))
    return load(spark, folder, "part").select(
        "p_partkey", display.label("p_name", ticker).alias("label"),
        display.clip(F.concat_ws(" ", "p_name", "p_type"), 12).alias("clipped"))


@query("shown_days", "SELECT o_orderkey, strftime(o_orderdate, '%-d %b %Y') AS day FROM orders")
def shown_days(spark, folder):
    return load(spark, folder, "orders").select("o_orderkey", display.day("o_orderdate").alias("day"))


@query("sort_keys", """
SELECT c_custkey, coalesce(abs(CASE WHEN c_custkey % 7 > 0 THEN c_acctbal END), '-inf'::DOUBLE)
  AS by_size, lower(CASE WHEN c_custkey % 5 > 0 THEN c_name ELSE '' END) AS by_text FROM customer""")
def sort_keys(spark, folder):
    balance = F.when(F.col("c_custkey") % 7 > 0, F.col("c_acctbal"))
    name = F.when(F.col("c_custkey") % 5 > 0, F.col("c_name"))
    return load(spark, folder, "customer").select(
        "c_custkey", sort_key(balance, size_only=True).alias("by_size"),
        sort_key(name, number=False).alias("by_text"))


# --- facts about documents --------------------------------------------------------------

@query("web_page_detection", """
SELECT page_id AS id, 'page' AS kind, TRUE AS is_page FROM pages
WHERE starts_with(lower(ltrim(html)), '<!doctype html') OR starts_with(lower(ltrim(html)), '<html')
   OR contains(lower(substring(ltrim(html), 1, 512)), '<head>')
UNION ALL
SELECT doc_id, 'text', starts_with(lower(ltrim(text)), '<!doctype html')
   OR starts_with(lower(ltrim(text)), '<html')
   OR contains(lower(substring(ltrim(text), 1, 512)), '<head>') FROM documents""")
def web_page_detection(spark, folder):
    pages = load(spark, folder, "pages").select(
        F.col("page_id").alias("id"), F.lit("page").alias("kind"),
        documents.looks_like_html(F.col("html")).alias("is_page")).filter("is_page")
    texts = load(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.lit("text").alias("kind"),
        documents.looks_like_html(F.col("text")).alias("is_page"))
    return pages.unionByName(texts)


@query("dates_in_texts", """
SELECT d.doc_id, CASE d.doc_id % 6 WHEN 0 THEN strftime(dt, '%b %-d, %Y')
    WHEN 1 THEN strftime(dt, '%d-%b-%Y') WHEN 2 THEN strftime(dt, '%-m/%-d/%Y')
    WHEN 3 THEN strftime(dt, '%Y-%m-%d') END AS as_of,
  CASE WHEN d.doc_id % 6 = 4 THEN strftime(dt, '%Y-%m-%d') END AS date_line,
  CASE WHEN d.doc_id % 6 IN (2, 5) THEN dt END AS page_date
FROM (SELECT *, DATE '2020-01-01' + CAST(doc_id % 3000 AS INTEGER) AS dt FROM documents) d""")
def dates_in_texts(spark, folder):
    day = F.expr("date_add(DATE'2020-01-01', CAST(doc_id % 3000 AS INT))")
    kind = F.expr("doc_id % 6")
    line = (
        F.when(kind == 0, F.concat(F.lit("Data as of "), F.date_format(day, "MMM d, yyyy")))
        .when(kind == 1, F.concat(F.lit("AS OF: "), F.date_format(day, "dd-MMM-yyyy")))
        .when(kind == 2, F.concat(F.lit("x As of "), F.date_format(day, "M/d/yyyy")))
        .when(kind == 3, F.concat(F.lit("as of, "), F.date_format(day, "yyyy-MM-dd")))
        .when(kind == 4, F.concat(F.lit(" date , "), day.cast("string")))
        .otherwise(F.concat(F.lit("Holdings\nAs of\t"), F.date_format(day, "M/d/yyyy")))
    )
    # The date stands behind the whole text, so all of it is searched.
    whole = F.concat(F.col("text"), F.lit("\n"), line, F.lit("\n"))
    as_of = F.when(kind != 5, documents.as_of_text(whole))
    return load(spark, folder, "documents").select(
        "doc_id", as_of.alias("as_of"), documents.date_line_text(whole).alias("date_line"),
        documents.page_date(whole).alias("page_date"))
