"""Group statistics kept current while rows arrive.

Each micro-batch is reduced to its additive moments per key, stored under the batch
number. Statistics are merged from these, so no batch reads the earlier rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymark.functions.exprs import present, round_to
from tallymark.functions.stats import both
from tallymark.streaming import batches


def batch_moments(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Count, means and centred second moments of complete pairs per key."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    rows = df.where(both(x, y))
    for k in keys:
        rows = rows.where(present(k))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(fx).alias("mx"), F.avg(fy).alias("my"),
        F.regr_sxx(fy, fx).alias("sxx"), F.regr_syy(fy, fx).alias("syy"),
        F.regr_sxy(fy, fx).alias("sxy"),
    )


def combine_moments(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The moments of several batches as those of one.

    The spread of the batch means around the common mean is added to the spread
    inside the batches.
    """
    n = F.col("n").cast("double")
    common = moments.groupBy(*keys).agg(
        F.sum("n").alias("_n"),
        (F.sum(n * F.col("mx")) / F.sum(n)).alias("_gx"),
        (F.sum(n * F.col("my")) / F.sum(n)).alias("_gy"),
    )
    dx, dy = F.col("mx") - F.col("_gx"), F.col("my") - F.col("_gy")
    return moments.join(common, list(keys)).groupBy(
        *keys, F.col("_n").alias("n"), F.col("_gx").alias("mx"), F.col("_gy").alias("my")
    ).agg(
        F.sum(F.col("sxx") + n * dx * dx).alias("sxx"),
        F.sum(F.col("syy") + n * dy * dy).alias("syy"),
        F.sum(F.col("sxy") + n * dx * dy).alias("sxy"),
    )


def merge_moments(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Averages, Pearson r and count per key, from the moments of all batches."""
    merged = combine_moments(moments, keys)

    def varies(spread: str, mean: str):
        # rounding of the common mean leaves a trace of variance in a constant column
        return F.col(spread) > F.lit(1e-24) * F.col("n") * F.col(mean) * F.col(mean)

    scale = F.when(
        varies("sxx", "mx") & varies("syy", "my"), F.sqrt("sxx") * F.sqrt("syy")
    )
    r = round_to(F.try_divide(F.col("sxy"), scale), 4)
    return merged.select(
        *keys,
        round_to("my", 2).alias("avg_math_pct_prof"),
        round_to("mx", 2).alias("avg_pct_high_income"),
        F.when(F.col("n") >= 3, r).alias("pearson_r"),
        F.col("n").alias("school_count"),
    )


def live_stats(
    rows: DataFrame, keys: Sequence[str], x: str, y: str, target: str, checkpoint: str,
    merge_every: int = batches.MERGE_EVERY,
) -> StreamingQuery:
    """Reduce the stream to moments per batch."""
    return batches.store(
        rows, lambda b: batch_moments(b, keys, x, y), lambda m: combine_moments(m, keys), target, checkpoint, merge_every
    )


def read_live(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    return batches.read(spark, target, lambda m: merge_moments(m, keys))
