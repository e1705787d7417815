"""Query of the source divergence audit over all documents."""

from holdrift.llm import source_divergence
from holdrift.llm.registry import query
from holdrift.llm.tables import table

SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n_lang FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
totals AS (SELECT lang, count(*) AS v, CAST(sum(n_lang) AS HUGEINT) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT t.lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, CAST(sum(c) AS HUGEINT) AS n FROM counts GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5)) // (coalesce(s.n, 0) + 5 * totals.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.n_lang + 5)) // (totals.n + 5 * totals.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN totals ON totals.lang = g.lang
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 50
"""


@query("op13_source_divergence", SQL)
def op13_source_divergence(spark, folder):
    return source_divergence.audited(table(spark, folder, "documents"))
