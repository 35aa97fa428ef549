"""Additive results of micro-batches, stored under the batch number.

A repeated batch replaces its own folder. From time to time the batches so far are merged into a base that
carries the last batch number it holds; a base counts once its write is committed, the one with the
highest number is read, and batches it holds are deleted at the merge after that. So reading costs
no more for a long stream than for a short one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

#: Batches between two merges.
MERGE_EVERY = 20


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the ``name=<n>`` folders of a path whose write was committed."""
    fs, where = _folder(spark, path)
    if not fs.exists(where):
        return []
    found = []
    for status in fs.listStatus(where):
        last = status.getPath()
        if last.getName().startswith(f"{name}=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(last, "_SUCCESS")):
            found.append(int(last.getName().split("=")[1]))
    return sorted(found)


def claim(spark: SparkSession, target: str, checkpoint: str) -> None:
    """Bind a target to the checkpoint of its stream; another one is refused.

    Batch numbers start at 0 in a new checkpoint, so they would meet the batches of the old one.
    """
    fs, where = _folder(spark, f"{target}/_owner")
    if fs.exists(where):
        owner = spark.read.text(f"{target}/_owner").first()["value"]
        if owner != checkpoint:
            raise ValueError(f"{target} belongs to the stream with checkpoint {owner}")
    else:
        spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.text(f"{target}/_owner")


def _read(spark: SparkSession, target: str) -> tuple[DataFrame | None, int]:
    bases = _numbers(spark, f"{target}/_base", "upto")
    last = bases[-1] if bases else -1
    paths = [f"{target}/_base/upto={last}"] if bases else []
    batches = [n for n in _numbers(spark, target, "batch") if n > last]
    paths += [f"{target}/batch={n}" for n in batches]
    return (spark.read.parquet(*paths) if paths else None), max([last, *batches])


def merge(spark: SparkSession, target: str, combine: Callable[[DataFrame], DataFrame]) -> None:
    """Write a base of everything stored, then delete what the base before it held."""
    old = _numbers(spark, f"{target}/_base", "upto")
    rows, upto = _read(spark, target)
    if rows is None or (old and old[-1] == upto):
        return
    combine(rows).write.mode("overwrite").parquet(f"{target}/_base/upto={upto}")
    gone = [f"{target}/batch={n}" for n in _numbers(spark, target, "batch") if old and n <= old[-1]]
    for path in gone + [f"{target}/_base/upto={n}" for n in old[:-1]]:
        fs, where = _folder(spark, path)
        fs.delete(where, True)


def store(
    rows: DataFrame, reduce: Callable[[DataFrame], DataFrame], combine: Callable[[DataFrame], DataFrame],
    target: str, checkpoint: str, merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Reduce every micro-batch, until all landed files are read."""
    claim(rows.sparkSession, target, checkpoint)

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = _numbers(spark, f"{target}/_base", "upto")
        if held and number <= held[-1]:
            return  # repeated after its merge
        reduce(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")
        if number % merge_every == merge_every - 1:
            merge(spark, target, combine)

    return (
        rows.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def rows(spark: SparkSession, target: str) -> DataFrame:
    """All rows of the committed batches of a target that is never merged, with their number as ``batch``."""
    numbers = _numbers(spark, target, "batch")
    if not numbers:
        raise ValueError(f"nothing is stored in {target}")
    return spark.read.option("basePath", target).parquet(*[f"{target}/batch={n}" for n in numbers])


def read(spark: SparkSession, target: str, combine: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The combined rows of all batches stored so far."""
    rows, _ = _read(spark, target)
    if rows is None:
        raise ValueError(f"nothing is stored in {target}")
    return combine(rows)
