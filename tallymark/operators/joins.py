"""Equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.exprs import pad_fips
from tallymark.operators.windows import distinct_on
from tallymark.plans.skew import salted_join


def left_upper_name(
    fact: DataFrame,
    dim: DataFrame,
    name: str,
    order_by: Sequence[Column],
    dim_columns: Sequence[str],
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Every fact row with the newest directory row of the same name, ignoring case.

    The directory is reduced to one row per name before the join, so the fact
    keeps its row count. A name shared by many facts is split over tasks.
    """
    one = distinct_on(dim.withColumn("_name", F.upper(name)), ["_name"], order_by)
    keyed = fact.withColumn("_name", F.upper(name))
    return salted_join(
        keyed, one.select("_name", *dim_columns), ["_name"], "left", salt_by
    ).drop("_name")


def stats_to_feature(
    features: DataFrame, stats: DataFrame, code: str, stats_code: str, width: int,
    columns: Sequence[str],
) -> DataFrame:
    """Map features with their statistics by zero-padded code; missing ones get nulls."""
    left = features.withColumn("_code", pad_fips(code, width))
    right = stats.select(pad_fips(stats_code, width).alias("_code"), *columns)
    return left.join(right, "_code", "left").drop(code).withColumnRenamed("_code", code)


def with_names(
    df: DataFrame, names: DataFrame, code: str, name: str, out: str = "name", width: int = 5,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the name for a code, or the code itself where no name is known."""
    table = names.select(pad_fips(code, width).alias("_code"), F.col(name).alias("_name"))
    joined = salted_join(
        df.withColumn("_code", pad_fips(code, width)), table, ["_code"], "left", salt_by
    )
    return joined.withColumn(out, F.coalesce("_name", code)).drop("_code", "_name")


def inner_on(
    a: DataFrame, b: DataFrame, left: str, right: str, columns: Sequence[str],
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """All of ``a`` with ``columns`` of the matching rows of ``b``."""
    keyed = b.select(F.col(right).alias("_key"), *columns)
    return salted_join(a.withColumn("_key", F.col(left)), keyed, ["_key"], "inner", salt_by).drop(
        "_key"
    )


def not_stored(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the stored ones; null key parts match each other.

    Only the key columns of ``stored`` are read.
    """
    kinds = {c: new.schema[c].dataType for c in keys}
    known = stored.select(F.struct(*[F.col(c).cast(kinds[c]).alias(c) for c in keys]).alias("_key"))
    return new.withColumn("_key", F.struct(*keys)).join(known, "_key", "left_anti").drop("_key")
