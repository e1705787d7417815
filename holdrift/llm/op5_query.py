"""Query of the URL filters: all pages against dated lists derived from their hosts."""

from pyspark.sql import functions as F

from holdrift.llm import url_filter
from holdrift.llm.registry import query
from holdrift.llm.tables import table

# Which hosts are listed, and when, follows from the smallest page of a host or domain.
EVENTS = """
  SELECT list, action, pattern, event, CAST(DATE '2024-01-01' AS DATE) + CAST(day AS INT) AS happened FROM (
    SELECT 'spam' AS list, 'block' AS action, host AS pattern, 'add' AS event, seed * 11 % 200 AS day
      FROM hosts WHERE seed % 3 = 0
    UNION ALL SELECT 'spam', 'block', host, 'remove', seed * 11 % 200 + 60 + seed % 50 FROM hosts WHERE seed % 3 = 0
    UNION ALL SELECT 'spam', 'block', host, 'add', seed * 11 % 200 + 130 FROM hosts WHERE seed % 6 = 0
    UNION ALL SELECT 'brand', 'block', domain, 'add', seed * 7 % 300 FROM domains WHERE seed % 2 = 0
    UNION ALL SELECT 'editors', 'allow', host || '/en', 'add', seed * 13 % 250 FROM hosts WHERE seed % 4 <> 1
    UNION ALL SELECT 'editors', 'allow', host || '/en', 'remove', seed * 13 % 250 + 90 FROM hosts WHERE seed % 4 = 2
  )
"""
FETCHED = "CAST(DATE '2024-01-01' AS DATE) + CAST(page_id * 7 % 366 AS INT)"

SQL = f"""
WITH captures AS (
  SELECT page_id, url, {FETCHED} AS fetched, lower(regexp_extract(url, '://([^/:?#]+)', 1)) AS host,
         regexp_extract(url, '://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
hosts AS (SELECT host, min(page_id) AS seed FROM captures GROUP BY host),
domains AS (
  SELECT regexp_extract(host, '([^.]+[.][^.]+)$', 1) AS domain, min(page_id) AS seed FROM captures GROUP BY ALL),
events AS ({EVENTS}),
intervals AS (
  SELECT * FROM (SELECT *, lead(happened) OVER (PARTITION BY list, action, pattern ORDER BY happened) AS until FROM events)
  WHERE event = 'add'),
active AS (
  SELECT page_id, pattern, action, length(pattern) AS size
  FROM captures JOIN intervals ON happened <= fetched AND (until IS NULL OR fetched < until)
   AND (host = pattern OR ends_with(host, '.' || pattern)
        OR starts_with(host || path || '/', pattern || '/') AND contains(pattern, '/'))),
best AS (
  SELECT page_id, count(*) AS n_active, max(size) AS size FROM active GROUP BY page_id)
SELECT page_id, url, fetched, coalesce(n_active, 0) AS n_active,
       (SELECT min(pattern) FROM active a WHERE a.page_id = c.page_id AND a.size = b.size) AS decided_by,
       coalesce((SELECT bool_and(action = 'block') FROM active a WHERE a.page_id = c.page_id AND a.size = b.size),
                false) AS blocked
FROM captures c LEFT JOIN best b USING (page_id)
"""


def list_events(captures):
    """Dated list entries for the hosts and domains of captures (page_id, host)."""
    hosts = captures.groupBy("host").agg(F.min("page_id").alias("seed"))
    domains = hosts.groupBy(F.regexp_extract("host", r"([^.]+[.][^.]+)$", 1).alias("domain")).agg(
        F.min("seed").alias("seed"))
    return captures.sparkSession.sql(EVENTS.replace("FROM hosts", "FROM {hosts}").replace(
        "FROM domains", "FROM {domains}"), hosts=hosts, domains=domains)


@query("op5_url_filter", SQL)
def op5_url_filter(spark, folder):
    captures = table(spark, folder, "pages").select("page_id", "url", F.expr(FETCHED).alias("fetched"))
    events = list_events(captures.select("page_id", url_filter.host_of(F.col("url")).alias("host")))
    return url_filter.judged(captures, url_filter.validity_intervals(events))
