"""Queries of the language identification, over all documents and over all pages."""

from pyspark.sql import functions as F

from holdrift.llm import language_id
from holdrift.llm.registry import query
from holdrift.llm.tables import table


@query("op3_language_id")
def op3_language_id(spark, folder):
    evidence = table(spark, folder, "documents").select(
        "doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host"))
    return language_id.judged(evidence).select(
        "doc_id", "declared", "host", "text_language", "language", "confidence", "kept")


def page_evidence(pages):
    """Visible text, language of the markup and host of pages."""
    visible = F.regexp_replace("html", r"(?is)<(script|style|title|nav)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    declared = F.regexp_extract("html", r"""(?i)<html[^>]*\blang=["']?([A-Za-z]+)""", 1)
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return pages.select(
        "page_id", visible.alias("text"), F.nullif(F.lower(declared), F.lit("")).alias("declared"),
        F.nullif(host, F.lit("")).alias("host"))


@query("page_languages")
def page_languages(spark, folder):
    return language_id.judged(page_evidence(table(spark, folder, "pages"))).select(
        "page_id", "declared", "host", "text_language", "language", "confidence", "kept")
