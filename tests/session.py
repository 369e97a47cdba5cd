"""The local session of tests and checks."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("lossloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
