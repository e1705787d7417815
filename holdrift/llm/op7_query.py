"""Query of the quality rules over all documents."""

from pyspark.sql import functions as F

from holdrift.llm import quality_rules
from holdrift.llm.registry import query
from holdrift.llm.tables import table

RULES = quality_rules.Rules()


def _list(values):
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


_COMMON = " ".join(f"WHEN '{lang}' THEN {_list(words)}" for lang, words in RULES.common_words.items())

SQL = rf"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         CASE lang {_COMMON} END AS common
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM texts WHERE len(words) >= 8)),
repeated AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, w) >= 2),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM repeated) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM texts)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         length(t) AS n_chars, len(regexp_extract_all(t, '[A-Z]')) AS n_capital,
         len(regexp_extract_all(t, '[0-9.,;:!?''"()\-]')) AS n_mark, len(regexp_extract_all(t, '[^\x00-\x7F]')) AS n_beyond,
         list_transform(common, lambda c: len(list_filter(words, lambda w: w = c))) AS listed
  FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
histograms AS (
  SELECT doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         [n_capital, n_mark, n_symbols, n_chars - word_chars, n_beyond,
          n_chars - n_capital - n_mark - n_symbols - (n_chars - word_chars) - n_beyond] AS classes,
         list_append(listed, n_words - list_sum(listed)) AS common
  FROM counts),
long AS (
  SELECT doc_id, lang, 'c' AS kind, unnest(classes) AS n, generate_subscripts(classes, 1) AS place FROM histograms
  UNION ALL
  SELECT doc_id, lang, 'w', unnest(common), generate_subscripts(common, 1) FROM histograms),
shares AS (
  SELECT doc_id, lang, kind, place, n / nullif(sum(n) OVER (PARTITION BY doc_id, kind), 0) AS p FROM long),
sums AS (SELECT lang, kind, place, sum(n) AS n FROM long GROUP BY ALL),
usual AS (SELECT lang, kind, place, n / nullif(sum(n) OVER (PARTITION BY lang, kind), 0) AS q FROM sums),
distances AS (
  SELECT shares.doc_id, shares.kind, CASE WHEN count(p) > 0 AND count(q) > 0 THEN sqrt(greatest(sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) END AS d
  FROM shares JOIN usual
  ON shares.lang IS NOT DISTINCT FROM usual.lang AND shares.kind = usual.kind AND shares.place = usual.place
  GROUP BY shares.doc_id, shares.kind),
without AS (
  SELECT lang, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS d
  FROM (SELECT lang, q, CASE WHEN place = max(place) OVER (PARTITION BY lang) THEN 1.0 ELSE 0.0 END AS p
        FROM usual WHERE kind = 'w' AND q IS NOT NULL) GROUP BY lang),
judged AS (
  SELECT h.*, c.d AS class_distance, w.d AS word_distance,
         n_words < {RULES.min_words} OR 100 * n_repeat_words > {RULES.repeat_percent} * n_words AS base_failed,
         (n_words >= {RULES.min_words_for_distance} AND coalesce(c.d, 0) > {RULES.class_distance})
         OR (n_words >= {RULES.min_words_for_word_distance}
             AND coalesce(w.d > {RULES.word_distance} * without.d, FALSE)) AS far
  FROM histograms h
  LEFT JOIN distances c ON c.doc_id = h.doc_id AND c.kind = 'c'
  LEFT JOIN distances w ON w.doc_id = h.doc_id AND w.kind = 'w'
  LEFT JOIN without ON without.lang IS NOT DISTINCT FROM h.lang)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance,
       NOT base_failed AND NOT far AS kept
FROM judged
"""


@query("op7_quality_rules", SQL)
def op7_quality_rules(spark, folder):
    return quality_rules.judged(table(spark, folder, "documents"), RULES).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", F.round("class_distance", 6).alias("class_distance"),
        F.round("word_distance", 6).alias("word_distance"), "kept")
