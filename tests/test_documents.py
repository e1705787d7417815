import json

from holdrift.sources import documents
from tests.build import documents as landed
from tests.build import rows


def read(spark, *docs):
    return documents.read_documents(landed(spark, docs))


def test_records_with_quotes_line_ends_and_blank_lines(spark):
    text = ('Fund X\r\n"as of Jun 12, 2026"\r\nTicker,Name,Weight (%),Market Value\r\n'
            'AAA,"Alpha, ""The"" Co",5.5,"1,000"\r\n,,,\r\n\r\nBBB,"two\r\nlines",1\r\nCCC,5" pipe,2,"open')
    found = documents.raw_rows(read(spark, ("p", "F", "ishares", text)))
    assert rows(found, "line", "constituent_ticker", "constituent_name", "market_value", "as_of_date") == [
        (0, "AAA", 'Alpha, "The" Co', "1,000", "Jun 12, 2026"),
        (1, "BBB", "two\nlines", None, "Jun 12, 2026"),
        (2, "CCC", '5" pipe', "open", "Jun 12, 2026")]


def test_columns_are_found_by_name_then_by_part_of_it(spark):
    text = "Ticker,Fund Name,Name,Net % of Net Assets,Weight\nA,fund,own,1,2\n"
    [row] = documents.raw_rows(read(spark, ("p", "F", "globalx", text))).collect()
    assert (row.constituent_name, row.weight_pct, row.currency) == ("own", "2", "USD")
    [row] = documents.raw_rows(read(spark, ("p", "F", "globalx", "Ticker,Fund Name,x net assets y\nA,b,1\n"))).collect()
    assert (row.constituent_name, row.weight_pct) == ("b", None)
    # Of columns with one name the last counts.
    [row] = documents.raw_rows(read(spark, ("p", "F", "vaneck", "Ticker,Name,Name\nA,b,c\n"))).collect()
    assert row.constituent_name == "c"


def test_rejected_documents_do_not_stop_others(spark):
    found = read(
        spark, ("1", "F", "vaneck", " <!DOCTYPE html><p>wait</p>"), ("2", "F", "ishares", "no header"),
        ("3", "F", "globalx", "Ticker,Name,Net\n"), ("4", "F", "amplify", "Account,StockTicker,SecurityName\nX,A,B\n"),
        ("5", "F", "row_json", "not json"), ("6", "F", "columnar_json", "{}"), ("7", "F", "unheard", "x"),
        ("8", "F", "page_table", "<table></table>"), ("9", "F", "sheet", "a,b\n"),
        ("10", "F", "ishares", "Ticker,Name,Weight\nA,B,1\n"), ("11", "F", "ishares", "Ticker,Name,Weight\n"),
        ("12", "F", None, "x"))
    assert {r.path: (r.status, r.error) for r in documents.outcomes(found).collect()} == {
        "1": ("failed", "web page instead of data"), "2": ("failed", "no header line"),
        "3": ("failed", "no rows"), "4": ("failed", "no rows of this fund"), "5": ("failed", "no data"),
        "6": ("failed", "no data points"), "7": ("failed", "unknown layout"),
        "8": ("failed", "no holdings table"), "9": ("failed", "no header line"), "10": ("fetched", None),
        "11": ("no_data", None), "12": ("failed", "unknown layout")}


def test_top_holdings_only_are_rejected(spark):
    def body(count, top):
        items = [{"Label": f"L{i}", "HoldingName": "N", "Weight": 1.5} for i in range(count)]
        return json.dumps({"data": {"Holdings": items, "IsTopTen": top, "AsOfDate": "2026-06-12"}})

    found = read(spark, ("a", "F", "row_json", body(10, False)), ("b", "F", "row_json", body(11, False)),
                 ("c", "F", "row_json", body(11, True)), ("d", "F", "row_json", body(0, False)))
    assert rows(documents.outcomes(found), "path", "error") == sorted([
        ("a", "top holdings only"), ("b", None), ("c", "top holdings only"), ("d", "no rows")], key=repr)
    assert documents.raw_rows(found).filter("weight_pct = '1.5'").count() == 11


def test_columnar_json_with_short_columns(spark):
    points = {"ticker": {"formattedValue": ["A", "B"]}, "isin": {"formattedValue": ["US1"]},
              "unitsHeld": {"formattedValue": "none"}, "asOfDate": {"formattedValue": "20260612"}}
    body = json.dumps({"componentsByNameMap": {"holdings": {"containersByNameMap": {
        "all": {"dataPointsByNameMap": points}}}}})
    found = documents.raw_rows(read(spark, ("p", "F", "columnar_json", body)))
    assert rows(found, "constituent_ticker", "isin", "shares_held", "as_of_date") == sorted([
        ("A", "US1", None, "20260612"), ("B", None, None, "20260612")], key=repr)


def test_page_table(spark):
    page = ("<html><body>As of 06/12/2026<!-- <table> --><table><tr><th>x</th></tr></table><table><thead>"
            "<tr><th>Name</th><th>Code</th><th>Weight (%)</th></tr></thead><tr><td> A&amp;B &#8364;<b> z </b>"
            "&#x41;</td><td>AB</td><td>3%</td></tr><tr><td>short</td></tr></table></body></html>")
    [row] = documents.raw_rows(read(spark, ("p", "F", "page_table", page))).collect()
    assert (row.constituent_name, row.constituent_ticker, row.weight_pct, row.as_of_date) == (
        "A&B €zA", "AB", "3%", "06/12/2026")


def test_data_addresses(spark):
    text = ("x data:application/csv;charset=utf-8,Security%2CSymbol%0ACam+co%2C50%%2Cb y "
            "data:application/csv,Security%2CSymbol%0AB%2CC")
    docs = documents.decoded_documents(landed(spark, [("p", "F", "sprott", text, "6/2/2026")]))
    assert rows(docs, "part", "content") == [
        (0, "Security,Symbol\nCam+co,50%,b"), (1, "Security,Symbol\nB,C")]
    found = documents.raw_rows(documents.read_documents(docs.drop("part")))
    assert rows(found, "constituent_name", "as_of_date") == [("B", "2026-06-02"), ("Cam+co", "2026-06-02")]


def test_feed_for_all_funds_at_once(spark):
    text = "Account,StockTicker,SecurityName\nSILJ,AG,First\noth ,X,Y\n"
    feed = landed(spark, [("p", None, "amplify", text)])
    assert rows(documents.feed_rows(documents.read_delimited(feed)), "etf_ticker", "constituent_ticker") == [
        ("OTH", "X"), ("SILJ", "AG")]
    own = documents.raw_rows(read(spark, ("p", "silj", "amplify", text)))
    assert rows(own, "etf_ticker", "constituent_ticker") == [("silj", "AG")]


def test_character_references(spark):
    from pyspark.sql import functions as F

    from holdrift.sources.markup import unescaped
    told = {
        "Soci&eacute;t&eacute; A &amp B &ndash; C": "Société A & B – C", "&#233;&#xE9;&#x00000E9;&#000000233": "éééé",
        "&#x01F600;&#128512;": "\U0001f600\U0001f600", "&#1114112;&#0;&#xD800;&#99999999999999999999;": "�" * 4,
        "&#150;&#x80;&#129;": "–€\x81", "&unheard; &; & &#; a&b": "&unheard; &; & &#; a&b", "&amp;lt;": "&lt;", "": "",
        "no": "no"}
    df = spark.createDataFrame(list(enumerate(told)), "i int, t string")
    found = df.orderBy("i").select(unescaped(F.col("t"))).collect()
    assert [r[0] for r in found] == list(told.values())


def test_wrong_numbers_do_not_stop_other_documents(spark):
    page = ("<table><tr><th>Name</th><th>Weight</th></tr><tr><td>A{}</td><td>1</td></tr></table>")
    found = read(spark, ("1", "F", "page_table", page.format("&#1114112;")), ("2", "F", "page_table", page.format("")))
    assert rows(documents.raw_rows(found), "path", "constituent_name") == [("1", "A�"), ("2", "A")]


def test_tables_inside_cells(spark):
    inner = "<table><tr><td>x</td></tr></table>"
    page = (f"<table><tr><td>{inner}</td></tr></table><table class=h><tr><th>Name</th><th>Weight</th></tr>"
            f"<tr><td>A</td><td>1 {inner}</td></tr><tr><td>B</td><td>2</td></tr></table>")
    outer = f"<table><tr><td><table><tr><th>Name</th><th>Weight</th></tr><tr><td>C</td><td>3</td></tr></table></td></tr></table>"
    found = documents.raw_rows(read(spark, ("1", "F", "page_table", page), ("2", "F", "page_table", outer)))
    assert rows(found, "path", "constituent_name", "weight_pct") == [("1", "B", "2"), ("2", "C", "3")]


def test_addresses_end_with_their_quote(spark):
    body = "Security,Market%20Value,Symbol,SEDOL,Quantity,Weight%0AL'Or,1,A,2,3,4%0AM,1,B,2,3,4"
    for text in (f'<a href="data:application/csv,{body}">x</a>', f"see data:application/csv,{body} here"):
        docs = landed(spark, [("p", "F", "sprott", text, "6/12/2026")])
        found = documents.raw_rows(documents.read_delimited(documents.decoded_documents(docs).drop("part")))
        assert rows(found, "constituent_name") == [("L'Or",), ("M",)]
