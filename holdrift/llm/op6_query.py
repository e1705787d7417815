"""Query of the fixity audit: all pages as WARC records, and a replica with faults."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from holdrift.llm import warc
from holdrift.llm.registry import query
from holdrift.llm.tables import table

PAGES_PER_ARCHIVE = 500

_RECORD = """'WARC/1.1' || e || 'WARC-Type: response' || e || 'WARC-Record-ID: <urn:record:' || page_id || '>' || e
  || 'WARC-Target-URI: ' || coalesce(url, '') || e || 'Content-Length: ' || strlen(coalesce({html}, '')) || e || e
  || coalesce({html}, '')"""
_HTML = "CASE WHEN page_id % 53 = 7 THEN '#' || substring(html, 2) ELSE html END"

SQL = f"""
WITH p AS (SELECT page_id, url, html, chr(13) || chr(10) AS e FROM pages),
versions AS (
  SELECT page_id, page_id // {PAGES_PER_ARCHIVE} AS archive, {_RECORD.format(html="html")} AS one,
         {_RECORD.format(html=f"({_HTML})")} AS two FROM p),
placed AS (
  SELECT *, strlen(one) + 4 AS length,
         coalesce(sum(strlen(one) + 4) OVER (
           PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
  FROM versions),
faults AS (
  SELECT archive, o, length, CASE
    WHEN page_id % 211 = 17 AND page_id % 101 = 13 THEN NULL
    WHEN page_id % 211 = 17 THEN 'extra'
    WHEN page_id % 101 = 13 THEN 'missing'
    WHEN sha256(one) <> sha256(two) THEN 'changed' END AS fault
  FROM placed)
SELECT archive, CAST(o AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length, fault
FROM faults WHERE fault IS NOT NULL
"""


def replicas(pages):
    """Two tables of records: the second has changed and missing records, the first lacks some, too."""
    html = F.when(F.col("page_id") % 53 == 7, F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(
        F.col("html"))
    digested = pages.select(
        "page_id", F.floor(F.col("page_id") / PAGES_PER_ARCHIVE).alias("archive"),
        warc.record_text(F.col("page_id"), F.col("url"), F.col("html")).alias("one"),
        warc.record_text(F.col("page_id"), F.col("url"), html).alias("two")).select(
        "page_id", "archive", (F.octet_length("one") + len(warc.RECORD_END)).cast("long").alias("length"),
        F.sha2("one", 256).alias("one"), F.sha2("two", 256).alias("two"))
    before = Window.partitionBy("archive").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = warc.stored(digested.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))))
    first = placed.where("page_id % 211 != 17").select("archive", "offset", "length", F.col("one").alias("digest"))
    second = placed.where("page_id % 101 != 13").select("archive", "offset", "length", F.col("two").alias("digest"))
    return first, second


@query("op6_fixity_audit", SQL)
def op6_fixity_audit(spark, folder):
    return warc.audit(*replicas(table(spark, folder, "pages")))
