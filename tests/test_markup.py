"""Elements of HTML against a plain stack; and long pages whose cells are left open."""

import random
import re
import time

from pyspark.sql import functions as F

from holdrift.sources import documents, markup


def stack(text, tag):
    """Contents by a stack of open elements."""
    found, open_ = [], []
    for mark in re.finditer(rf"<{tag}(?=[\s/>])[^>]*>|</{tag}\s*>", text, re.I | re.S):
        if not mark[0].startswith("</"):
            open_.append(len(found))
            found.append([mark.end(), len(text)])
        elif open_:
            found[open_.pop()][1] = mark.start()
    return [text[a:b] for a, b in found]


def test_elements(spark, monkeypatch):
    rng = random.Random(4)
    parts = ["<td>", "<TD class='x'>", "</td>", "</td >", "é", "b ", "<tdx>", "\n", "<td\n/>", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(300)] + ["", None]
    for size in (256, 3):
        monkeypatch.setattr(markup, "_CHUNK", size)
        rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string").select(
            "k", markup.elements(F.col("text"), "td").alias("found")).collect()
        for row in rows:
            wanted = None if texts[row.k] is None else stack(texts[row.k], "td")
            assert row.found == wanted, texts[row.k]


def read(spark, page):
    found = spark.createDataFrame([(page,)], "page string").select(documents.page_tables(F.col("page")).alias("t"))
    return [(t.header, t.rows) for t in found.first().t]


def test_rows_of_open_cells(spark):
    head = "<table><tr><th>Name</th><th>Weight</th></tr>"
    assert read(spark, head + "<tr><td>a<td>1</tr><tr><td>b</td><td>2</td></tr><tr><td>only</tr></table>") == [
        (["Name", "Weight"], [["a1", "1"], ["b", "2"]])]
    # Rows left open hold all that follows, so only the last has two cells.
    assert read(spark, head + "<tr><td>a<td>1<tr><td>b<td>2</table>") == [(["Name", "Weight"], [["b2", "2"]])]
    # A cell that holds a table counts its cells too.
    assert read(spark, head + "<tr><td><table><tr><td>x</td></tr></table></td></tr></table>")[0][1] == [["x", "x"]]
    assert read(spark, "<table><tr><td>a</td><td>1") == [([], [])]
    assert read(spark, "no table") == []


def test_ten_thousand_open_cells(spark):
    head = "<table><tr><th>Name</th><th>Weight</th></tr>"
    in_one_row = head + "<tr>" + "<td>cell" * 10_000 + "</tr><tr><td>b</td><td>2</td></tr></table>"
    in_many_rows = head + "<tr><td>name<td>1" * 5_000 + "</table>"
    read(spark, head)
    started = time.time()
    assert read(spark, in_one_row) == [(["Name", "Weight"], [["b", "2"]])]
    assert read(spark, in_many_rows) == [(["Name", "Weight"], [["name1", "1"]])]
    assert time.time() - started < 60
