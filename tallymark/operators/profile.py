"""Profiles of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators.quantiles import quantiles
from tallymark.operators.windows import first_n_per


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False
) -> DataFrame:
    """count, mean, std, min, quartiles and max of every numeric column, one row each.

    Exact quartiles shuffle the distinct values; ``approx`` takes them from a sketch.
    """
    numeric = columns or [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType)
    ]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot(
        [], [f"`{c}`" for c in numeric], "column", "value"
    )
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quart = quantiles(long, "value", [0.25, 0.5, 0.75], ["column"], approx=approx).select("column", "q")
    joined = moments.join(quart, "column", "left")
    return joined.select(
        "column", "count", "mean", "std", "min",
        F.get("q", F.lit(0)).alias("p25"),
        F.get("q", F.lit(1)).alias("p50"),
        F.get("q", F.lit(2)).alias("p75"),
        "max",
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage per column, from one pass."""
    n = F.count(F.lit(1))
    one = df.agg(n.alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}")
                                  for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_m{i}").alias("missing"),
            F.coalesce(F.try_divide(F.col(f"_m{i}") * 100.0, F.col("_n")), F.lit(0.0)).alias("pct"),
        )
        for i, c in enumerate(df.columns)
    ])
    return one.select(F.inline(rows))


def categorical_profile(df: DataFrame, max_cols: int = 5, max_values: int = 10) -> DataFrame:
    """Distinct count of the first string columns, with the values where there are few.

    Values are reduced to distinct ones first, and no more than ``max_values`` of
    a column are ever brought together.
    """
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)][:max_cols]
    long = df.select(*text).unpivot([], [f"`{c}`" for c in text], "column", "value")
    values = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    few = (
        first_n_per(values, ["column"], [F.asc("value")], max_values, "_rank")
        .groupBy("column")
        .agg(F.sort_array(F.collect_list("value")).alias("listed"))
    )
    return counts.join(few, "column").select(
        "column", "n_distinct",
        F.when(F.col("n_distinct") <= max_values, F.col("listed")).alias("listed"),
    )
