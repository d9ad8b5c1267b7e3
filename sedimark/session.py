"""Session helper used by tests, the bench and local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session with the settings the engine assumes (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sedimark")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
