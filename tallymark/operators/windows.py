"""Ranking, de-duplication and change over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.plans.lineage import settle
from tallymark.plans.scan import ordered_chunks, running, unchunk
from tallymark.plans.skew import ROWS_PER_PART, as_parts, salted_join

def first_n_per(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int, out: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each key with their rank.

    Spark limits each group to ``n`` rows before the shuffle (WindowGroupLimit),
    so a heavy key sends at most ``n`` rows per task. Beyond the size up to which
    Spark does that (``spark.sql.window.group.limit.threshold``), the rows are numbered by
    the chunked scan instead, which starts jobs and needs a total order to be repeatable.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.window.group.limit.threshold", "1000")):
        return dupe_rank(df, keys, order_by, out).where(F.col(out) <= n).withColumn(out, F.col(out).cast("int"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn(out, rank).where(F.col(out) <= n)


def distinct_on(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One whole row per key: the first in the given order."""
    return first_n_per(df, keys, order_by, 1, "_first").drop("_first")


def latest_wins(
    df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest version per key."""
    order = [F.desc_nulls_last(version), *[F.desc_nulls_last(t) for t in ties]]
    return distinct_on(df, keys, order)


def top_bottom(
    df: DataFrame, keys: Sequence[str], metric: str, tie: str, n: int = 3
) -> DataFrame:
    """Best and worst ``n`` rows per key, marked in ``side`` with their rank."""
    present = df.where(F.col(metric).isNotNull())
    top = first_n_per(present, keys, [F.desc(metric), F.asc(tie)], n)
    bottom = first_n_per(present, keys, [F.asc(metric), F.desc(tie)], n)
    return top.withColumn("side", F.lit("top")).unionByName(
        bottom.withColumn("side", F.lit("bottom"))
    )


def dupe_rank(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], out: str = "dupe_rank",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Number all rows of each key 1, 2, 3, ... in the given (total) order. Starts a job that counts the keys.

    Keys of up to ``rows_per_part`` rows are numbered by a window. Larger ones go through the ordered scan, in as many
    chunks of that size as they need, so neither way puts more rows of a key in one task.
    """
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(1).alias("one"))
    counts = df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    heavy = settle(counts.where(F.col("_n") > rows_per_part), "heavy")
    rows = heavy.agg(F.sum("_n")).first()[0]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)).cast("bigint")
    if not rows:
        return df.withColumn(out, number)
    marked = df.withColumn("_key", key)
    light = marked.join(heavy, "_key", "left_anti").drop("_key").withColumn(out, number)
    large = marked.join(heavy, "_key", "left_semi").drop("_key")
    parts = max(-(-rows // rows_per_part), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranked = running(ordered_chunks(large, keys, order_by, parts), keys, {out: F.lit(1).cast("bigint")})
    return light.unionByName(unchunk(ranked.withColumn(out, F.col(out) + 1)))


def count_in(
    df: DataFrame, keys: Sequence[str], out: str, salt_by: Sequence[str] | None = None,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Every row with the size of its group; rows without a key get null.

    Counts are combined map-side and joined back, so no task holds a whole group. The counts
    themselves say which keys to split.
    """
    present = df.na.drop("any", subset=list(keys))
    counts = present.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return salted_join(df, counts, keys, "left", salt_by, as_parts(counts, keys, out, rows_per_part))


def yoy_diff(
    df: DataFrame, year: str, series: str, value: str, names: Sequence[str]
) -> DataFrame:
    """Mean per year and series, and its change from the previous year in the data.

    Gives a row for every year and every series in ``names``; the change is null
    where either year has no value. The window runs over the pivoted table,
    which has one row per year.
    """
    wide = (
        df.where(F.col(year).isNotNull())
        .groupBy(year)
        .pivot(series, list(names))
        .agg(F.avg(value))
    )
    by_year = Window.orderBy(year)
    changed = wide.select(
        year, *[(F.col(f"`{n}`") - F.lag(f"`{n}`").over(by_year)).alias(n) for n in names]
    )
    return changed.unpivot([year], [f"`{n}`" for n in names], series, "change")
