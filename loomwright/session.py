"""Sessions for local work, and what a session needs to run the library's Python functions."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def local(cores: str | int = "*", partitions: int = 8, memory: str = "20g") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loomwright")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return ready(session)


def ready(spark: SparkSession) -> SparkSession:
    """Puts this library on the path of the session's Python workers (a cluster gets it by --py-files)."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))
    return spark
