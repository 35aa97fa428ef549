"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_PART = 1_000_000


def as_parts(counted: DataFrame, keys: Sequence[str], n: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Of counted keys those with more than ``rows_per_part`` rows, and the number of parts
    (``_salts``) of about that size each should be split into. A table of N rows has fewer
    than N / rows_per_part of them.
    """
    hot = counted.where(F.col(n) > rows_per_part)
    return hot.select(*keys, F.ceil(F.col(n) / F.lit(rows_per_part)).cast("int").alias("_salts"))


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The parts of every key above ``rows_per_part``. Counting is map-side combined."""
    counted = df.select(*keys).na.drop("any").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return as_parts(counted, keys, "_n", rows_per_part)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    salt_by: Sequence[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)`` with null keys, and hot keys on request, spread over tasks.

    Rows with a null key match nothing and are dealt out by a hash of ``salt_by`` (default: all
    left columns). AQE splits other heavy keys at run time, which takes no pass over the data. Where it
    cannot (the joined side feeds an aggregate on the same keys, or is cached), give ``hot``, from
    ``hot_keys`` or ``as_parts``: left rows of these keys get one of their part numbers, and only
    their right rows are repeated, once per part. ``how`` is ``left`` or ``inner``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    spread = F.xxhash64(*(salt_by or left.columns))
    if hot is None:
        salt = F.when(any_null, F.pmod(spread, F.lit(tasks)).cast("int")).otherwise(0)
        split, copied = left.withColumn("_salt", salt), right.withColumn("_salt", F.lit(0))
    else:
        parts = F.coalesce("_salts", F.when(any_null, F.lit(tasks)), F.lit(1))
        part = F.when(parts > 1, F.pmod(spread, parts).cast("int"))
        split = left.join(hot, list(keys), "left").withColumn("_salt", F.coalesce(part, F.lit(0))).drop("_salts")
        every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
        copied = right.join(hot, list(keys), "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return split.join(copied, [*keys, "_salt"], how).drop("_salt")
