"""Holdings tables derived from the given tables, in Spark and in DuckDB SQL.

A fund is a supplier, a position a part number class, a snapshot a calendar quarter;
every third fund reports one quarter late, every ninth three quarters. All rows of the base tables are used.
"""

from pyspark.sql import functions as F

from holdrift.plans.joins import settled

CONFIG = {
    "defaults": {
        "min_weight_delta_bps": 250,
        "min_share_pct_change": 60.0,
        "min_value_delta_usd": 60000,
    },
    "overrides_by_vertical": {
        "gold": {"min_weight_delta_bps": 400},
        "copper": {"min_weight_delta_bps": 100, "min_value_delta_usd": 90000},
    },
    "cross_etf": {
        "min_converging_etfs": 2,
        "equivalent_etf_groups": [["F0", "F5", "F10"], ["F1", "F11"], ["F2", "F12"]],
    },
}

_HOLDINGS_SPARK = """
    CASE WHEN l_suppkey % 9 = 0 THEN add_months(trunc(l_shipdate, 'QUARTER'), -9)
         WHEN l_suppkey % 3 = 0 THEN add_months(trunc(l_shipdate, 'QUARTER'), -3)
         ELSE trunc(l_shipdate, 'QUARTER') END                         AS as_of_date
    | concat('F', l_suppkey)                                           AS etf_ticker
    | CASE WHEN l_partkey % 31 > 0 THEN concat('T', l_partkey % 50) END AS constituent_ticker
    | CASE WHEN l_partkey % 11 = 0 THEN 'EUR/USD'
           ELSE concat('Holding ', l_partkey % 50, ' Ltd') END         AS constituent_name
    | CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 50 = 49 THEN 'CASH'
           ELSE concat('US', lpad(CAST(l_partkey % 50 AS STRING), 9, '0'),
                       l_partkey % 10) END                             AS isin
    | CAST(1000000 + l_partkey AS STRING)                              AS sedol
    | CAST(l_quantity AS DECIMAL(18,2))                                AS shares_held
    | CASE WHEN l_partkey % 19 = 0 THEN CAST(0 AS DECIMAL(18,2)) WHEN l_partkey % 23 > 0
           THEN CAST(l_extendedprice AS DECIMAL(18,2)) END             AS market_value
    | CASE WHEN l_partkey % 19 = 0 THEN CAST(0 AS DECIMAL(18,2)) WHEN l_partkey % 29 > 0
           THEN CAST(l_discount * 100 AS DECIMAL(18,2)) END            AS weight_pct
    | 'USD'                                                            AS currency
    | CAST(NULL AS STRING)                                             AS sector
    | CASE l_partkey % 3 WHEN 0 THEN 'AU' WHEN 1 THEN 'CA' END         AS country
    | CASE l_partkey % 8 WHEN 5 THEN '' WHEN 6 THEN 'Cash' WHEN 7 THEN 'Futures'
           ELSE 'Equity' END                                           AS asset_class
    | CASE l_partkey % 8 WHEN 5 THEN NULL WHEN 6 THEN 'cash' WHEN 7 THEN 'derivative'
           ELSE 'equity' END                                           AS instrument_type
    | CASE WHEN l_linenumber = 7 THEN 'manual' ELSE 'web_csv' END      AS source
"""

HOLDINGS_SQL = """
SELECT CAST(CASE WHEN l_suppkey % 9 = 0 THEN date_trunc('quarter', l_shipdate) - INTERVAL 9 MONTH
            WHEN l_suppkey % 3 = 0 THEN date_trunc('quarter', l_shipdate) - INTERVAL 3 MONTH
            ELSE date_trunc('quarter', l_shipdate) END AS DATE)                AS as_of_date,
       'F' || l_suppkey                                                        AS etf_ticker,
       CASE WHEN l_partkey % 31 > 0 THEN 'T' || (l_partkey % 50) END           AS constituent_ticker,
       CASE WHEN l_partkey % 11 = 0 THEN 'EUR/USD'
            ELSE 'Holding ' || (l_partkey % 50) || ' Ltd' END                  AS constituent_name,
       CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 50 = 49 THEN 'CASH'
            ELSE 'US' || lpad(CAST(l_partkey % 50 AS VARCHAR), 9, '0') || (l_partkey % 10)
            END                                                                AS isin,
       CAST(1000000 + l_partkey AS VARCHAR)                                    AS sedol,
       CAST(l_quantity AS DECIMAL(18,2))                                       AS shares_held,
       CASE WHEN l_partkey % 19 = 0 THEN 0 WHEN l_partkey % 23 > 0
            THEN CAST(l_extendedprice AS DECIMAL(18,2)) END                    AS market_value,
       CASE WHEN l_partkey % 19 = 0 THEN 0 WHEN l_partkey % 29 > 0
            THEN CAST(l_discount * 100 AS DECIMAL(18,2)) END                   AS weight_pct,
       'USD'                                                                   AS currency,
       CAST(NULL AS VARCHAR)                                                   AS sector,
       CASE l_partkey % 3 WHEN 0 THEN 'AU' WHEN 1 THEN 'CA' END                AS country,
       CASE l_partkey % 8 WHEN 5 THEN '' WHEN 6 THEN 'Cash' WHEN 7 THEN 'Futures'
            ELSE 'Equity' END                                                  AS asset_class,
       CASE l_partkey % 8 WHEN 5 THEN NULL WHEN 6 THEN 'cash' WHEN 7 THEN 'derivative'
            ELSE 'equity' END                                                  AS instrument_type,
       CASE WHEN l_linenumber = 7 THEN 'manual' ELSE 'web_csv' END             AS source
FROM lineitem"""

UNIVERSE_SQL = """
SELECT 'F' || s_suppkey AS etf_ticker,
       CASE s_suppkey % 5 WHEN 0 THEN 'ishares' WHEN 1 THEN 'globalx' WHEN 2 THEN 'vaneck'
            WHEN 3 THEN 'amplify' ELSE 'spdr' END AS issuer,
       CASE s_suppkey % 4 WHEN 0 THEN 'gold' WHEN 1 THEN 'copper' WHEN 2 THEN 'silver'
            ELSE 'uranium' END AS commodity_vertical,
       s_suppkey % 26 = 0 AS external,
       CASE WHEN s_suppkey % 13 = 0 THEN FALSE END AS enabled
FROM supplier"""


def load(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


HOLDINGS_EXPRESSIONS = [part.strip() for part in _HOLDINGS_SPARK.split("\n    | ")]


def holdings(spark, folder):
    return load(spark, folder, "lineitem").selectExpr(*HOLDINGS_EXPRESSIONS)


def universe(spark, folder):
    key = F.col("s_suppkey")
    return load(spark, folder, "supplier").select(
        F.concat(F.lit("F"), key).alias("etf_ticker"),
        F.expr("CASE s_suppkey % 5 WHEN 0 THEN 'ishares' WHEN 1 THEN 'globalx' "
               "WHEN 2 THEN 'vaneck' WHEN 3 THEN 'amplify' ELSE 'spdr' END").alias("issuer"),
        F.expr("CASE s_suppkey % 4 WHEN 0 THEN 'gold' WHEN 1 THEN 'copper' "
               "WHEN 2 THEN 'silver' ELSE 'uranium' END").alias("commodity_vertical"),
        (key % 26 == 0).alias("external"),
        F.when(key % 13 == 0, False).alias("enabled"),
    )


def in_order(ordered):
    """Adds ``place``, counted from 1 in the order in which an ordered table gives its rows.

    Rows are numbered within their partitions, and those are few enough to be added up here.
    """
    marked = settled(ordered.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    before, starts = 0, []
    for row in marked.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((row["part"], before))
        before += row["count"]
    table = ordered.sparkSession.createDataFrame(starts, "_part long, _before long")
    return marked.join(F.broadcast(table), part == F.col("_part")).withColumn(
        "place", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_part", "_before")


def as_doubles(df):
    """Decimal columns as doubles, so that both engines show the same type."""
    return df.select(*[
        F.col(f.name).cast("double") if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in df.schema.fields])
