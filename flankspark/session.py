"""Session defaults for local runs and tests; a cluster brings its own settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    # Checkpoints go once nothing holds them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session. Keyword arguments are Spark settings with ``__`` for each dot."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.driver.memory", memory)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
