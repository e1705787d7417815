"""Query of the hard-negative mining over all vectors."""

from pyspark.sql import functions as F

from holdrift.llm import hard_negatives
from holdrift.llm.registry import query
from holdrift.llm.tables import table

SQL = r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM (SELECT vec_id, embedding,
               CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM embeddings)
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT ar, anchor_id, br AS pr, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, other_id NULLS LAST, br) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.ar, p.pr ORDER BY n.score DESC, n.other_id NULLS LAST, n.br) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.ar = p.ar AND NOT n.same
 AND 100 * n.score >= 30 * p.positive_score AND 100 * n.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.ar, p.pr ORDER BY n.score DESC, n.other_id NULLS LAST, n.br) <= 10
"""


def relabelled(vectors):
    """Every seventh id gets the next label, so that near copies have different labels."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                              .otherwise(F.col("label")))


@query("op12_hard_negatives", SQL)
def op12_hard_negatives(spark, folder):
    return hard_negatives.mined(relabelled(table(spark, folder, "embeddings")), F.col("vec_id") % 100 == 0)
