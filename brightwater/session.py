"""The Spark session that the engine expects: UTC, ANSI SQL, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session; further settings by their names with __ for a dot."""
    builder = SparkSession.builder.master(master).appName("brightwater")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for name, value in (settings | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
