"""Long to wide and wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.exprs import relabel


def pivot(df: DataFrame, index: str, series: str, value: str, values: Sequence[str]) -> DataFrame:
    """One column per series value. The values are given, so no extra pass looks for them."""
    return df.groupBy(index).pivot(series, list(values)).agg(F.first(value))


def melt(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str],
    variable: str = "variable",
    value: str = "value",
    labels: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per id and column, nulls included; ``labels`` renames the column names."""
    long = df.unpivot(list(ids), list(columns), variable, value)
    return long if labels is None else long.withColumn(variable, relabel(variable, labels, variable))
