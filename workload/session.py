"""A local Spark session for tests, checks and the bench."""

from pyspark.sql import SparkSession


def session(cpus="8", partitions="8"):
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("holdrift")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
