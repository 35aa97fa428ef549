"""Sorting, limits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(
    df: DataFrame, metric: str, n: int, tie: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The ``n`` rows with the highest metric (a bounded heap per task, no full sort)."""
    best = df.orderBy(F.desc_nulls_last(metric), F.asc(tie)).limit(n)
    return best.select(*columns) if columns else best


def top_tail(df: DataFrame, metric: str, n: int, tie: str) -> DataFrame:
    """The ``n`` highest, lowest of them first."""
    return top_n(df, metric, n, tie).orderBy(F.asc(metric), F.desc(tie))


def sort_nulls_last(df: DataFrame, key: str, direction: str = "desc", tie: str | None = None) -> DataFrame:
    """Sorted either way with nulls at the end.

    Equal keys (the nulls above all) are ordered by ``tie``, or by a hash of the row, so the
    sort can spread them over tasks.
    """
    order = F.asc_nulls_last(key) if direction == "asc" else F.desc_nulls_last(key)
    return df.orderBy(order, F.asc(tie) if tie else F.xxhash64(*df.columns))


def recent(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(key)).limit(n)


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows, the same ones for the same seed and keys."""
    mark = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    return df.withColumn("_mark", mark).orderBy("_mark", key).limit(n).drop("_mark")
