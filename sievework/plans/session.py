"""Session settings for local runs; a cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "12g", **conf: str) -> SparkSession:
    """A local session in UTC with adaptive execution; keyword arguments override (dots written as two underscores)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sievework")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SIEVEWORK_DRIVER_MEMORY", memory))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
