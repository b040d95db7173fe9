"""A local session for tests and the benchmark; on a cluster the caller brings the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("basketlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
