"""Questions about tables, and read-only SQL."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows",
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def usable_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows, and rows that satisfy the predicate."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(predicate).alias("n_usable"),
        (F.count_if(predicate) > 0).alias("usable"),
    )


def run_select(
    spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None,
    args: Mapping | None = None,
) -> DataFrame:
    """Run a query given as text. Anything but a query is refused.

    The text is placed inside ``SELECT * FROM (...)``, so Spark's own parser rejects
    statements that write, even behind a WITH.
    """
    text = sql.strip().rstrip(";")
    if text.split(None, 1)[0].lower() not in ("select", "with"):
        raise ValueError("only SELECT queries are allowed")
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(f"SELECT * FROM (\n{text}\n)", args=dict(args or {}))
