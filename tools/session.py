"""One local Spark session for tests and tools."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", time_zone: str = "UTC") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tripmart")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
