"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.exprs import safe_float


def coord_valid(lat: str, lon: str) -> Column:
    """Both coordinates present, numeric and on the globe."""
    return F.coalesce(
        safe_float(lat).between(-90, 90) & safe_float(lon).between(-180, 180), F.lit(False)
    )


def in_list(column: str, values: Sequence) -> Column:
    """Membership; an empty selection keeps every row."""
    return F.col(column).isin(list(values)) if values else F.lit(True)


def in_range(column: str, low, high) -> Column:
    """Inclusive range; nulls are out."""
    return F.col(column).between(low, high)


def above(column: str, limit) -> Column:
    return F.col(column) > limit


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def eq_or_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Numbers must equal ``text``; everything else must match it as a pattern, ignoring case."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return df.where(F.col(column) == F.lit(float(text)))
    return df.where(F.col(column).cast("string").rlike(f"(?i){text}"))


def key_lookup(df: DataFrame, **equals) -> DataFrame:
    """All rows with the given key values; partitioned data is pruned by them."""
    for column, value in equals.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def paired(df: DataFrame, x: str, y: str, name: str) -> DataFrame:
    """Scatter points ``(x, y, name)`` of rows that have both values."""
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
        F.col(name).alias("name"),
    )


def scatter(
    districts: DataFrame,
    state_stats: DataFrame,
    x: str,
    avg_x: str,
    state: str | None = None,
    county: str | None = None,
    y: str = "math_pct_prof",
    avg_y: str = "avg_math_pct_prof",
) -> DataFrame:
    """Points for the drill level: schools of a county, schools of a state, or state averages."""
    if state is None:
        return paired(state_stats, avg_x, avg_y, "state")
    rows = key_lookup(districts, state=state)
    if county is not None:
        rows = key_lookup(rows, county_fips=county)
    return paired(rows, x, y, "school_name")
