"""URL filters and the fixity audit."""

import datetime
import hashlib
import random

from pyspark.sql import functions as F

from holdrift.llm import url_filter, warc

DAY = datetime.date(2024, 1, 1)


def day(n):
    return None if n is None else DAY + datetime.timedelta(days=n)


def table(spark, rows):
    return spark.createDataFrame([(*r[:4], day(r[4])) for r in rows],
                                 "list string, action string, pattern string, event string, happened date")


def test_keys_of_urls(spark):
    urls = ["http://User@A.b.org:80/x/Y?q=/z#/f", "https://b.org", "nothing", None, "http://b.org//x/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    found = [r[0] for r in df.select(url_filter.keys_of(F.col("url"))).collect()]
    assert [sorted(k) for k in found] == [
        ["a.b.org", "a.b.org/x", "a.b.org/x/Y", "b.org", "org"], ["b.org", "org"], [], [], ["b.org", "b.org/x", "org"]]


def test_entries_active_when_fetched(spark):
    events = [
        ("spam", "block", "B.org", "add", 10), ("spam", "block", "b.org", "add", 10), ("spam", "block", "b.org", "remove", 20),
        ("spam", "block", "b.org", "add", 30), ("ed", "allow", "b.org/en", "add", 15), ("x", "block", "a.b.org", "add", 40),
        ("x", "block", "a.b.org", "remove", 40), (None, "block", "b.org", "add", 0), ("y", "block", None, "add", 0),
        ("z", "block", "b.org", "add", None)]
    captures = [(k, url, n) for k, (url, n) in enumerate(
        [("http://b.org/de", 9), ("http://b.org/de", 10), ("http://b.org/de", 20), ("http://w.b.org/", 35),
         ("http://b.org/en/1", 16), ("http://b.org/en/1", 12), ("http://a.b.org", 50), ("http://cb.org", 12),
         (None, 12), ("http://b.org/de", None), ("http://b.org/de", 10)])]
    df = spark.createDataFrame([(k, u, day(n)) for k, u, n in captures], "id long, url string, fetched date")
    df = df.withColumns({name: F.lit(1) for name in (
        "key", "pattern", "strongest", "capture", "given", "_capture", "n", "allows", "n_active", "blocked")})
    found = {r["id"]: r for r in url_filter.judged(df, url_filter.validity_intervals(table(spark, events))).collect()}
    assert [found[k]["blocked"] for k in range(11)] == [
        False, True, False, True, False, True, True, False, False, False, True]
    assert found[4]["strongest"] == 1 and found[4]["given"] == 1 and len(found[4]) == 14
    assert found[4]["decided_by"] == "b.org/en" and found[4]["n_active"] == 2 and found[0]["decided_by"] is None
    nothing = url_filter.judged(df, url_filter.validity_intervals(table(spark, events).limit(0)))
    assert nothing.where("blocked").count() == 0 and nothing.count() == 11
    assert url_filter.judged(df.limit(0), url_filter.validity_intervals(table(spark, events))).count() == 0


def test_audit_finds_every_fault(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 500)
    monkeypatch.setattr(warc, "FANOUT", 3)
    rng = random.Random(6)
    one, two, wanted = [], [], []
    for archive in ("a", "b", "c"):
        offset = 0
        for k in range(200):
            length = rng.randrange(1, 90)
            fault = rng.choice(["changed", "missing", "extra"]) if archive != "c" and rng.random() < 0.04 else None
            if fault != "extra":
                one.append((archive, offset, length, f"d{k}"))
            if fault != "missing":
                two.append((archive, offset, length, f"d{k}" + "!" * (fault == "changed")))
            if fault:
                wanted.append((archive, offset, length, fault))
            offset += length
    one += one[:5] + [(None, 0, 1, "x"), ("a", None, 1, "x")]
    schema = "archive string, offset long, length long, digest string"
    first, second = spark.createDataFrame(one, schema), spark.createDataFrame(two, schema).withColumn("place", F.lit(1))
    assert sorted(map(tuple, warc.audit(first, second).collect())) == sorted(wanted)
    assert warc.audit(first, first).count() == 0
    assert warc.audit(first, second.limit(0)).where("fault = 'missing'").count() == len(set(one[:-2]))
    assert warc.audit(first.limit(0), second.limit(0)).count() == 0


def test_roots_by_hand(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 10)
    monkeypatch.setattr(warc, "FANOUT", 2)
    rows = [("a", 0, 6, "p"), ("a", 6, 9, "q"), ("a", 15, 30, "r")]
    df = spark.createDataFrame(rows, "archive string, offset long, length long, digest string")
    leaves = warc.leaves_of(df)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    low, high = sha("0:6:p\n6:9:q"), sha("15:30:r")
    root = warc.tree(leaves, warc.levels_for(leaves))[-1].collect()
    assert [(r["place"], r["hash"]) for r in root] == [(0, sha(f"0:{low}\n1:{high}"))]


def test_written_files_are_read_back(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h/{k}", None if k == 3 else "é\r\n\r\n<p>" * k) for k in range(9)],
                                  "page_id long, url string, html string")
    records = pages.select(
        (F.col("page_id") % 2).alias("archive"), F.col("page_id").alias("offset"),
        warc.record_text(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    warc.write_warc(records, f"{tmp_path}/warc")
    read = warc.read_warc(spark, f"{tmp_path}/warc")
    digests = [r[0] for r in records.select(F.sha2("record", 256)).collect()]
    assert sorted(r["digest"] for r in read.collect()) == sorted(digests)
    assert sorted(r["offset"] for r in read.collect())[:2] == [0, 0]
