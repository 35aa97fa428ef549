"""Shared storage for lineage cuts and scratch tables.

The cluster names a folder every executor can reach in ``spark.checkpoint.dir``.
Only where that setting is missing (a local session) is a folder of our own used.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder from ``spark.checkpoint.dir``, or one made for this local session."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _own_folder[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _own_folder[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    The rows (and anything derived from partition numbers) are then the same for
    every later reader, survive the loss of executors, and can be column-pruned.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
