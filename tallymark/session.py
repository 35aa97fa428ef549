"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # call-site capture for every column expression slows down the building of large plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(name: str = "tallymark") -> SparkSession.Builder:
    """A builder with the settings above; master and sizes are left to the cluster."""
    b = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def local(cores: int = 8, name: str = "tallymark-local", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        builder(name)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
