"""Query of the benchmark decontamination over all documents and all benchmark items."""

from pyspark.sql import functions as F

from holdrift.llm import decontaminate
from holdrift.llm.registry import query
from holdrift.llm.tables import table

SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
runs AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS run, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM runs),
places AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM places JOIN runs USING (run, n)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""


@query("op1_decontamination", SQL)
def op1_decontamination(spark, folder):
    found = decontaminate.decontaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")
