"""DuckDB SQL of the derived tables and of the delta run, in named parts."""

from holdrift.fixed_values import (
    CASH_WORDS, CURRENCY_CODES, CURRENCY_WORDS, DERIVATIVE_WORDS, LABEL_RULES,
    UNTYPED_ROW_CURRENCY_CODES,
)
from workload.tables import CONFIG, HOLDINGS_SQL, UNIVERSE_SQL


def quoted(values):
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


TRACKED = f"""
(CASE WHEN instrument_type IS NOT NULL THEN instrument_type = 'equity'
      ELSE coalesce(coalesce(isin, constituent_ticker) <> 'CASH', FALSE)
           AND (isin IS NOT NULL OR upper(trim(constituent_ticker))
                NOT IN ({quoted(UNTYPED_ROW_CURRENCY_CODES)}))
           AND (coalesce(weight_pct, 0) <> 0 OR coalesce(market_value, 0) <> 0) END
 AND NOT regexp_matches(upper(trim(coalesce(constituent_name, ''))), '^[A-Z]{{3}}/[A-Z]{{3}}$'))"""

PART = {
    "holdings": HOLDINGS_SQL,
    "universe": UNIVERSE_SQL,
    "paused": "SELECT etf_ticker FROM universe WHERE enabled = FALSE",
    "dates": "SELECT DISTINCT etf_ticker, source, as_of_date FROM holdings WHERE source = 'web_csv'",
    "latest_stored": "SELECT etf_ticker, max(as_of_date) AS latest_stored FROM dates GROUP BY 1",
    "aligned": "SELECT min(latest_stored) AS aligned_date FROM latest_stored "
               "WHERE etf_ticker NOT IN (SELECT etf_ticker FROM paused)",
    "tracked": "SELECT *, coalesce(isin, constituent_ticker) AS delta_key "
               f"FROM holdings WHERE {TRACKED}",
}

_MEASURES = ["shares_held", "market_value", "weight_pct"]


def rolled(side_rows):
    """One row per position of the given rows (which carry fund, source, pair_date, key)."""
    return f"""
SELECT etf_ticker, source, pair_date, delta_key, max(as_of_date) AS as_of_date, max(isin) AS isin,
       max({{'v': coalesce(market_value, 0), 'l': constituent_ticker}})
           FILTER (WHERE constituent_ticker IS NOT NULL)['l'] AS constituent_ticker,
       max({{'v': coalesce(market_value, 0), 'l': constituent_name}})
           FILTER (WHERE constituent_name IS NOT NULL)['l'] AS constituent_name,
       sum(shares_held) AS shares_held, sum(market_value) AS market_value,
       sum(weight_pct) AS weight_pct
FROM ({side_rows}) GROUP BY etf_ticker, source, pair_date, delta_key"""


def _side(pairs, side):
    return (f"SELECT t.*, p.pair_date FROM tracked t JOIN {pairs} p USING (etf_ticker, source, "
            f"as_of_date) WHERE p.side = {side}")


def delta_parts(name, dates, consecutive=False):
    """Parts that end in table ``name``: the deltas of the pairs made of a table of dates."""
    if consecutive:
        pairs = f"""
SELECT *, as_of_date AS pair_date, 1 AS side FROM {dates}
UNION ALL
SELECT * FROM (SELECT *, lead(as_of_date) OVER (PARTITION BY etf_ticker, source
               ORDER BY as_of_date) AS pair_date, 0 AS side FROM {dates})
WHERE pair_date IS NOT NULL"""
    else:
        pairs = f"""
SELECT etf_ticker, source, as_of_date, newest AS pair_date,
       CASE WHEN as_of_date = newest THEN 1 ELSE 0 END AS side
FROM (SELECT *, max(as_of_date) OVER (PARTITION BY etf_ticker, source) AS newest,
             row_number() OVER (PARTITION BY etf_ticker, source ORDER BY as_of_date DESC) AS n
      FROM {dates}) WHERE n <= 2"""
    deltas = f"""
SELECT coalesce(c.etf_ticker, p.etf_ticker) AS etf_ticker, coalesce(c.source, p.source) AS source,
       coalesce(c.pair_date, p.pair_date) AS pair_date, u.commodity_vertical,
       coalesce(c.constituent_ticker, p.constituent_ticker) AS constituent_ticker,
       coalesce(c.constituent_name, p.constituent_name) AS constituent_name,
       coalesce(c.isin, p.isin) AS isin,
       c.as_of_date AS curr_as_of_date, p.as_of_date AS prev_as_of_date,
       CASE WHEN p.etf_ticker IS NULL THEN 'addition' WHEN c.etf_ticker IS NULL THEN 'removal'
            ELSE 'change' END AS delta_type,
       CAST(p.weight_pct AS DOUBLE) AS prev_weight_pct,
       CAST(c.weight_pct AS DOUBLE) AS curr_weight_pct,
       CAST(coalesce(c.weight_pct, 0) - coalesce(p.weight_pct, 0) AS DOUBLE) AS delta_weight_pct,
       CAST(p.shares_held AS DOUBLE) AS prev_shares, CAST(c.shares_held AS DOUBLE) AS curr_shares,
       CAST(coalesce(c.shares_held, 0) - coalesce(p.shares_held, 0) AS DOUBLE) AS delta_shares,
       CASE WHEN p.shares_held > 0 THEN (CAST(c.shares_held AS DOUBLE) -
            CAST(p.shares_held AS DOUBLE)) / CAST(p.shares_held AS DOUBLE) * 100
            END AS pct_change_shares,
       CAST(p.market_value AS DOUBLE) AS prev_market_value,
       CAST(c.market_value AS DOUBLE) AS curr_market_value,
       CAST(coalesce(c.market_value, 0) - coalesce(p.market_value, 0) AS DOUBLE)
           AS delta_market_value
FROM {name}_cur c FULL OUTER JOIN {name}_prev p
  ON c.etf_ticker = p.etf_ticker AND c.source = p.source AND c.pair_date = p.pair_date
     AND c.delta_key = p.delta_key
LEFT JOIN universe u ON u.etf_ticker = coalesce(c.etf_ticker, p.etf_ticker)"""
    return {
        f"{name}_pairs": pairs,
        f"{name}_cur": rolled(_side(f"{name}_pairs", 1)),
        f"{name}_prev": rolled(_side(f"{name}_pairs", 0)),
        name: deltas,
    }


PART.update(delta_parts("deltas", "dates"))
PART["dates_2000"] = "SELECT * FROM dates WHERE as_of_date <= DATE '2000-05-15'"
PART.update(delta_parts("deltas_2000", "dates_2000"))
PART["dates_aligned"] = (
    "SELECT * FROM dates WHERE as_of_date <= (SELECT aligned_date FROM aligned)")
PART.update(delta_parts("deltas_aligned", "dates_aligned"))
PART.update(delta_parts("deltas_all", "dates", consecutive=True))

_GROUPS = CONFIG["cross_etf"]["equivalent_etf_groups"]
PART["listing"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{fund}', '{group[0]}', {i})" for group in _GROUPS for i, fund in enumerate(group)
) + ") t(etf_ticker, group_key, group_rank)"

_D, _O = CONFIG["defaults"], CONFIG["overrides_by_vertical"]


def band(name):
    """The band of a row's vertical as SQL."""
    own = "".join(f" WHEN '{v}' THEN {float(o[name])}" for v, o in _O.items() if name in o)
    whole = f"CASE commodity_vertical{own} ELSE {float(_D[name])} END" if own else str(float(_D[name]))
    return f"CAST({whole} AS DOUBLE)"


MATERIAL = "(delta_shares <> 0 OR abs(delta_weight_pct) > CAST(0.001 AS DOUBLE))"
PASSES = f"""(abs(delta_weight_pct) * 100 >= {band('min_weight_delta_bps')}
 OR abs(coalesce(pct_change_shares, 0)) >= {band('min_share_pct_change')}
 OR abs(delta_market_value) >= {band('min_value_delta_usd')})"""


def flow_parts(name):
    """Parts ``name``_votes, _signals, _kept (thresholds), _listed (collapsed moves), _scoped."""
    return {
        f"{name}_votes": f"""
SELECT * EXCLUDE (n) FROM (
  SELECT d.*, coalesce(g.group_key, d.etf_ticker) AS group_key,
         row_number() OVER (PARTITION BY d.isin, coalesce(g.group_key, d.etf_ticker)
                            ORDER BY coalesce(g.group_rank, 0)) AS n
  FROM {name} d LEFT JOIN listing g USING (etf_ticker)
  WHERE d.isin IS NOT NULL AND d.isin NOT IN ('', 'CASH')) WHERE n = 1""",
        f"{name}_signals": f"""
SELECT isin, min({{'e': etf_ticker, 'l': constituent_name}})
                 FILTER (WHERE constituent_name IS NOT NULL)['l'] AS constituent_name,
       min({{'e': etf_ticker, 'l': constituent_ticker}})
                 FILTER (WHERE constituent_ticker IS NOT NULL)['l'] AS constituent_ticker,
       count(DISTINCT group_key) AS n_etfs,
       count(*) FILTER (WHERE delta_weight_pct > 0) AS n_etfs_weight_up,
       count(*) FILTER (WHERE delta_weight_pct < 0) AS n_etfs_weight_down,
       count(*) FILTER (WHERE delta_type = 'addition') AS n_etfs_added,
       count(*) FILTER (WHERE delta_type = 'removal') AS n_etfs_removed,
       CAST(sum(CAST(delta_market_value AS DECIMAL(38,2))) AS DOUBLE) AS total_delta_market_value
FROM {name}_votes GROUP BY isin""",
        f"{name}_kept": f"""
SELECT * FROM {name} WHERE delta_type <> 'change' OR ({MATERIAL} AND {PASSES})""",
        f"{name}_listed": f"""
SELECT * EXCLUDE (n) FROM (
  SELECT k.*, row_number() OVER (
           PARTITION BY k.delta_type, coalesce(g.group_key, k.etf_ticker),
                        coalesce(nullif(k.isin, ''), k.constituent_ticker)
           ORDER BY coalesce(g.group_rank, 0)) AS n
  FROM {name}_kept k LEFT JOIN listing g USING (etf_ticker)) WHERE n = 1""",
        f"{name}_moves": f"""
SELECT * FROM {name}_listed WHERE etf_ticker NOT IN (SELECT etf_ticker FROM paused)""",
        f"{name}_funds": f"""
SELECT v.* FROM {name}_votes v JOIN (SELECT isin FROM {name}_signals WHERE n_etfs >= 2) s
USING (isin) WHERE v.etf_ticker NOT IN (SELECT etf_ticker FROM paused)""",
        f"{name}_scoped": f"""
SELECT s.* REPLACE (k.n AS n_etfs) FROM {name}_signals s
JOIN (SELECT isin, count(DISTINCT etf_ticker) AS n FROM {name}_funds GROUP BY isin
      HAVING count(DISTINCT etf_ticker) >= 2) k USING (isin)""",
        f"{name}_scoped_votes": f"SELECT f.* FROM {name}_funds f SEMI JOIN {name}_scoped USING (isin)",
    }


for _name in ("deltas", "deltas_aligned"):
    PART.update(flow_parts(_name))


def sql(select, **more):
    """The select with all parts it names, directly or not, as a WITH list."""
    import re
    parts = {**PART, **more}
    needed = []

    def add(text):
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in parts and word not in needed and word not in open_parts:
                open_parts.append(word)
                add(parts[word])
                needed.append(word)

    open_parts = []
    add(select)
    listed = ",\n".join(f"{name} AS ({parts[name]})" for name in needed)
    return f"WITH {listed}\n{select}" if needed else select


def short_shares_sql(value):
    size = f"abs({value})"
    return f"""CASE WHEN {value} IS NULL THEN '—' ELSE (CASE WHEN {value} >= 0 THEN '+' ELSE '-' END)
 || CASE WHEN {size} >= 1e9 THEN printf('%.1fB', {size} / 1e9)
         WHEN {size} >= 1e7 THEN printf('%.0fM', {size} / 1e6)
         WHEN {size} >= 1e6 THEN printf('%.1fM', {size} / 1e6)
         WHEN {size} >= 1e3 THEN printf('%.0fK', {size} / 1e3)
         ELSE printf('%.0f', {size}) END END"""


def any_of(value, words):
    return "(" + " OR ".join(f"contains({value}, '{w}')" for w in words) + ")"


LABEL_TYPE = "CASE " + " ".join(
    f"WHEN contains(lower(trim(asset_class)), '{w}') THEN '{kind}'" for w, kind in LABEL_RULES) + " END"


def typed(rows, label="asset_class"):
    """The rows with ``instrument_type``."""
    by_label = LABEL_TYPE.replace("asset_class", label)
    return f"""
SELECT * EXCLUDE (words, code, real_isin), CASE WHEN {by_label} IS NOT NULL THEN {by_label}
  WHEN {any_of('words', CASH_WORDS)} THEN 'cash'
  WHEN {any_of('words', DERIVATIVE_WORDS)} THEN 'derivative'
  WHEN NOT real_isin AND (code IN ({quoted(CURRENCY_CODES)}) OR {any_of('words', CURRENCY_WORDS)})
    THEN 'fx'
  WHEN NOT real_isin AND code = '' THEN 'residual'
  WHEN coalesce(weight_pct, 0) = 0 AND coalesce(market_value, 0) = 0 THEN 'derivative'
  ELSE 'equity' END AS instrument_type
FROM (SELECT *, lower(coalesce(constituent_name, '') || ' ' || coalesce(constituent_ticker, ''))
        AS words, upper(trim(coalesce(constituent_ticker, ''))) AS code,
        coalesce(isin, '') NOT IN ('', 'CASH') AS real_isin FROM ({rows}))"""
