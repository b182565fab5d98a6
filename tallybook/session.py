"""Session settings the plans expect.  A cluster sets sizes and the shared folder itself."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # one broken plan node per column call is not worth two JVM round trips each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | None = None, memory: str = "8g", app: str = "tallybook") -> SparkSession:
    """Local session for tests and the bench: as many shuffle partitions as cores."""
    n = cpus or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{n}]").appName(app)
    local = {
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(n),
    }
    for k, v in {**SETTINGS, **local}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
