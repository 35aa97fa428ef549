"""Data-quality tests. Each gives rows; a table passes when the failures are zero."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators.aggregates import duplicates

# declared not-null columns per model
NOT_NULL = {
    "stg_census_data": ["state"],
    "stg_school_directory": ["leaid", "ncessch", "latitude", "longitude"],
    "stg_school_assessments": ["leaid", "ncessch", "year"],
    "stg_location_data": ["latitude", "longitude"],
    "dim_school_assessments": ["leaid", "ncessch", "year"],
}


def not_null(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Null count per declared column, one pass per table."""
    parts = []
    for name, (df, columns) in tables.items():
        one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        rows = F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column"),
                     F.col(c).alias("failures"))
            for c in columns
        ])
        parts.append(one.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness, with how often they occur."""
    return duplicates(df, keys, "failures")
