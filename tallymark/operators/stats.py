"""Group statistics: paired means and correlations, trends, and the insight table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.exprs import present, round_to
from tallymark.functions.stats import both, pair_count, paired_mean, pearson
from tallymark.operators.quantiles import quantiles
from tallymark.operators.windows import first_n_per
from tallymark.plans.lineage import settle


@dataclass(frozen=True)
class Metric:
    """A value paired with the main outcome, and the names of its three results."""

    x: str
    avg_name: str
    r_name: str
    n_name: str


def area_stats(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    y: str,
    metrics: Sequence[Metric] = (),
    avg_x: str = "avg_pct_high_income",
    avg_y: str = "avg_math_pct_prof",
    count_name: str = "school_count",
    digits: int = 2,
) -> DataFrame:
    """Averages, Pearson r and count of complete (x, y) pairs per key, plus each extra metric.

    Every metric pairs with ``y`` on its own, so its n differs from the main count.
    Rows with a missing or empty key are left out, and so are keys without a
    complete main pair. One hash aggregate; a heavy key is combined map-side.
    """
    rows = df
    for k in keys:
        rows = rows.where(present(k))
    found = rows.groupBy(*keys).agg(*_pair_aggregates(x, y, metrics, avg_x, avg_y, count_name, digits))
    return found.where(F.col(count_name) > 0)


def _pair_aggregates(
    x: str, y: str, metrics: Sequence[Metric], avg_x: str, avg_y: str, count_name: str, digits: int
) -> list[Column]:
    extra = []
    for m in metrics:
        extra += [
            paired_mean(m.x, y, digits).alias(m.avg_name),
            pearson(m.x, y).alias(m.r_name),
            pair_count(m.x, y).alias(m.n_name),
        ]
    return [
        paired_mean(y, x, digits).alias(avg_y),
        paired_mean(x, y, digits).alias(avg_x),
        pearson(x, y).alias("pearson_r"),
        pair_count(x, y).alias(count_name),
        *extra,
    ]


def area_levels(
    df: DataFrame,
    levels: Mapping[str, Sequence[str]],
    x: str,
    y: str,
    metrics: Sequence[Metric] = (),
    avg_x: str = "avg_pct_high_income",
    avg_y: str = "avg_math_pct_prof",
    count_name: str = "school_count",
    digits: int = 2,
) -> DataFrame:
    """``area_stats`` of several levels from one pass, with the name of the level; keys of other levels are null.

    Each level asks for its own keys only: a row without a county counts for its state.
    """
    keys = list(dict.fromkeys(k for of_level in levels.values() for k in of_level))
    found = df.groupingSets([list(v) for v in levels.values()], *keys).agg(
        F.grouping_id().alias("_set"), *_pair_aggregates(x, y, metrics, avg_x, avg_y, count_name, digits)
    )
    name, kept = F.lit(None), F.lit(False)
    for level, own in levels.items():
        here = F.col("_set") == sum(1 << i for i, k in enumerate(reversed(keys)) if k not in own)
        name = F.when(here, F.lit(level)).otherwise(name)
        kept = kept | reduce(lambda a, b: a & b, [present(k) for k in own], here)
    return found.where(kept & (F.col(count_name) > 0)).withColumn("level", name).drop("_set")


def trend_segment(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per key, cut to the bounding box of the points.

    The end points are null with fewer than three points, without variance in x,
    or where the line does not cross the box.
    """
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    fit = df.where(both(x, y)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(fy, fx).alias("slope"),
        F.regr_intercept(fy, fx).alias("intercept"),
        F.min(fx).alias("_x0"), F.max(fx).alias("_x1"),
        F.min(fy).alias("_y0"), F.max(fy).alias("_y1"),
    )
    at_y0 = F.try_divide(F.col("_y0") - F.col("intercept"), F.col("slope"))
    at_y1 = F.try_divide(F.col("_y1") - F.col("intercept"), F.col("slope"))
    # greatest/least skip nulls, so a flat line keeps its whole x range
    x0 = F.greatest("_x0", F.least(at_y0, at_y1))
    x1 = F.least("_x1", F.greatest(at_y0, at_y1))
    usable = (F.col("n") >= 3) & F.col("slope").isNotNull() & ((F.col("slope") == 0) | (x0 < x1))

    def line(v):
        return F.col("slope") * v + F.col("intercept")

    return fit.select(
        *keys, "n", "slope", "intercept",
        F.when(usable, x0).alias("x0"), F.when(usable, line(x0)).alias("y0"),
        F.when(usable, x1).alias("x1"), F.when(usable, line(x1)).alias("y1"),
    )


def ols(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Ordinary least squares of y on x."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*keys).agg(
        F.regr_slope(fy, fx).alias("slope"),
        F.regr_intercept(fy, fx).alias("intercept"),
        F.regr_r2(fy, fx).alias("r2"),
        F.regr_count(fy, fx).alias("n"),
    )


def insight_stats(
    df: DataFrame,
    x: str,
    y: str,
    name: str,
    keys: Sequence[str],
    precomputed: DataFrame | None = None,
    n: int = 3,
) -> DataFrame:
    """Facts about one view of the data per key.

    Row count, complete pairs, mean and median of both values (2 digits), Pearson
    (3 digits), the r stored in ``precomputed`` (keys, pearson_r) and the best and
    worst ``n`` names by y.
    """
    # the view is read once per fact below, so it is written once in its narrow form
    view = settle(df.select(
        *keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"),
        F.col(name).alias("_name"),
    ), "view")
    points = view.where(both("_x", "_y"))
    base = view.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        pair_count("_x", "_y").alias("paired_points"),
        paired_mean("_y", "_x", 2).alias("mean_y"),
        paired_mean("_x", "_y", 2).alias("mean_x"),
        pearson("_x", "_y", 3).alias("pearson_r_on_screen"),
    )
    long = points.unpivot([*keys], ["_x", "_y"], "_which", "_value")
    medians = (
        quantiles(long, "_value", [0.5], [*keys, "_which"])
        .groupBy(*keys)
        .agg(
            round_to(F.max(F.when(F.col("_which") == "_y", F.get("q", F.lit(0)))), 2).alias("median_y"),
            round_to(F.max(F.when(F.col("_which") == "_x", F.get("q", F.lit(0)))), 2).alias("median_x"),
        )
    )

    def listed(order, out):
        ranked = first_n_per(points, keys, order, n, "_rank")
        entry = F.struct("_rank", F.col("_name").alias("name"), F.col("_y").alias("y"), F.col("_x").alias("x"))
        # at most n entries per key
        return ranked.groupBy(*keys).agg(
            F.transform(
                F.sort_array(F.collect_list(entry)),
                lambda e: F.struct(e["name"].alias("name"), e["y"].alias("y"), e["x"].alias("x")),
            ).alias(out)
        )

    out = (
        base.join(medians, list(keys), "left")
        .join(listed([F.desc("_y"), F.asc("_name")], "top"), list(keys), "left")
        .join(listed([F.asc("_y"), F.desc("_name")], "bottom"), list(keys), "left")
    )
    if precomputed is not None:
        known = precomputed.select(*keys, F.col("pearson_r").alias("pearson_r_precomputed"))
        out = out.join(known, list(keys), "left")
    return out
