"""Unions and distinct rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAYER_COLUMNS = ("geoid", "name", "state_fips", "county_fips", "geometry")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_layers(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Polygon layers of different shape in one table, tagged with ``layer_type``.

    A layer's name defaults to its geoid, and codes it does not have are null.
    """
    parts = []
    for layer, df in layers.items():
        have = set(df.columns)
        columns = [
            F.col(c).cast("string").alias(c) if c in have
            else (F.col("geoid") if c == "name" else F.lit(None)).cast("string").alias(c)
            for c in LAYER_COLUMNS
        ]
        parts.append(df.select(F.lit(layer).alias("layer_type"), *columns))
    return union_all(parts)


def distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
