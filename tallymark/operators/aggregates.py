"""Grouped and global aggregates. All are partial/final hash aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.exprs import present, round_to, zip_prefix


def _sum(c: str | Column) -> Column:
    """Sum that is 0 over nothing."""
    return F.coalesce(F.sum(c), F.lit(0))


def _with_keys(df: DataFrame, keys: Sequence[str], null_as_empty: bool) -> DataFrame:
    """Rows that belong to a group: a null text key is the group ``''`` or none at all."""
    if null_as_empty:
        df = df.na.fill("", subset=list(keys))
    return df.na.drop("any", subset=list(keys))


def mean_sum_by(
    df: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
    total: str | None = None,
    null_as_empty: bool = False,
) -> DataFrame:
    """Means and sums per key (output name -> column); rows with a null key are dropped.

    ``total`` names a further column holding the sum of all sums. With ``null_as_empty``
    null text keys form the group ``''``, as they do for a text-only client.
    """
    means, sums = means or {}, sums or {}
    out = (
        _with_keys(df, keys, null_as_empty)
        .groupBy(*keys)
        .agg(
            *[F.avg(c).alias(n) for n, c in means.items()],
            *[_sum(c).alias(n) for n, c in sums.items()],
        )
    )
    if total:
        added = F.lit(0)
        for n in sums:
            added = added + F.col(n)
        out = out.withColumn(total, added)
    return out


def group_summary(
    df: DataFrame, key: str, counted: str, sums: Mapping[str, str], per_unit: str,
    out: str, count_name: str = "n", null_as_empty: bool = False,
) -> DataFrame:
    """Count, sums, and one of the sums divided by the count, rounded to whole numbers."""
    return (
        _with_keys(df, [key], null_as_empty)
        .groupBy(key)
        .agg(F.count(counted).alias(count_name), *[_sum(c).alias(n) for n, c in sums.items()])
        .withColumn(out, round_to(F.try_divide(F.col(per_unit), F.col(count_name)), 0))
    )


def count_by(
    df: DataFrame, keys: Sequence[str], out: str = "n", null_as_empty: bool = False
) -> DataFrame:
    return _with_keys(df, keys, null_as_empty).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def prefix_summary(
    df: DataFrame, code: str, sums: Mapping[str, str], n: int = 3,
    prefix: str = "zip_prefix", count_name: str = "zip_count",
) -> DataFrame:
    """Sums and number of codes per code prefix."""
    return (
        df.where(F.col(code).isNotNull())
        .groupBy(zip_prefix(code, n).alias(prefix))
        .agg(*[_sum(c).alias(o) for o, c in sums.items()], F.count(code).alias(count_name))
    )


def value_counts(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """Frequency table, most frequent first."""
    return count_by(df, [column], out).orderBy(F.desc(out), column)


def label_totals(
    df: DataFrame,
    parts: Mapping[str, Column | str],
    total: Column | str | None = None,
    label: str = "label",
    value: str = "value",
    rest: str = "Other",
    positive_only: bool = False,
) -> DataFrame:
    """Sums of the whole table as (label, value) rows.

    With ``total`` given, what the parts do not cover is added as ``rest``.
    """
    aggs = {n: _sum(c) for n, c in parts.items()}
    named = {f"_{i}": n for i, n in enumerate(aggs)}
    one = df.agg(
        *[a.alias(k) for k, a in zip(named, aggs.values())],
        *([_sum(total).alias("_t")] if total is not None else []),
    )
    pairs = [(n, F.col(k)) for k, n in named.items()]
    if total is not None:
        left = F.col("_t")
        for k in named:
            left = left - F.col(k)
        pairs.append((rest, left))
    rows = F.array(
        *[F.struct(F.lit(n).alias(label), v.cast("double").alias(value)) for n, v in pairs]
    )
    out = one.select(F.inline(rows))
    return out.where(F.col(value) > 0) if positive_only else out


def global_means(df: DataFrame, means: Mapping[str, str], count_name: str = "n") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias(count_name), *[F.avg(c).alias(n) for n, c in means.items()]
    )


def count_distinct(
    df: DataFrame, columns: Sequence[str], out: str = "n", approx: bool = False
) -> DataFrame:
    """Distinct combinations without nulls; ``approx`` trades exactness for one small sketch."""
    if approx:
        whole = F.struct(*[F.col(c) for c in columns])
        present_all = F.lit(True)
        for c in columns:
            present_all = present_all & F.col(c).isNotNull()
        hashed = F.when(present_all, F.xxhash64(whole))
        return df.agg(F.approx_count_distinct(hashed).alias(out))
    return df.agg(F.count_distinct(*[F.col(c) for c in columns]).alias(out))


def bounds(df: DataFrame, column: str, cap=None, low: str = "low", high: str = "high") -> DataFrame:
    """Minimum, and maximum no higher than ``cap``."""
    top = F.max(column)
    return df.agg(
        F.min(column).alias(low),
        (top if cap is None else F.least(top, F.lit(cap))).alias(high),
    )


def duplicates(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows, rows with a non-empty value, and their share in percent (0 for no rows)."""
    has = F.count_if(present(column))
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_rows"),
        has.alias("n_present"),
        F.coalesce(round_to(F.try_divide(has * 100.0, n), 4), F.lit(0.0)).alias("pct_present"),
    )


def national_totals(state_stats: DataFrame) -> DataFrame:
    return state_stats.agg(
        F.count(F.lit(1)).alias("state_count"),
        _sum("school_count").alias("total_schools"),
    )
