"""Connected components of a table of links, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdrift.llm.tables import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Links the larger neighbours of every node to the smallest of its neighbourhood."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return both.join(least, "u").where("v > u").select(
        F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links the smaller neighbours of every node, and the node, to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    moved = links.join(least, "u").where("v != least").select(
        F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a, b): its smallest reachable node.

    Stops when all links point straight to a smallest node; the number of rounds grows with the
    logarithm of the size. No neighbourhood is collected, and the links stay in Spark.
    """
    current = stored(links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        facts = current.join(current.select(F.col("u").alias("v")).distinct().withColumn("passed", F.lit(1)),
                             "v", "left").agg(F.count("*"), F.count_distinct("u"), F.count("passed")).first()
        if facts[0] == facts[1] and facts[2] == 0:
            break
        current = stored(_small_star(_large_star(current)))
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
