"""The Spark session that local runs, tests and the benchmark use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("pitpanel").config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
