"""Exact quantiles and what is built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.exprs import band, round_to
from tallymark.functions.lookups import BRACKET_BANDS, BRACKET_EDGES
from tallymark.plans.lineage import settle
from tallymark.plans.skew import salted_join

# accuracy of the sketch, half width of a bracket, and rows below which a key is taken whole:
# the bracket is wider than the sketch's error and holds five positions on either side
ACCURACY, MARGIN, FEW = 10_000, 0.0005, 10_000
# different values of a bracket that are ordered in one task, and parts a larger bracket is cut in
MOST, PARTS = 100_000, 64


def quantiles(
    df: DataFrame,
    x: str,
    probs: Sequence[float],
    keys: Sequence[str] = (),
    out: str = "q",
    approx: bool = False,
) -> DataFrame:
    """Interpolated quantiles of ``x`` per key, as an array in the order of ``probs``.

    Also gives ``n``, ``min`` and ``max``. Exact without sorting or gathering a group: a sketch
    brackets each wanted position, a second pass counts what lies below a bracket and the values inside
    it (a thousandth of the rows; keys with few rows are taken whole). Brackets of more than ``MOST``
    different values are narrowed in rounds, each of which counts ``PARTS`` parts and keeps those that hold
    the position; only then are values ordered, at most ``MOST`` in a task. A key whose bracket misses is done
    again from its whole range. ``approx`` uses the sketch alone (no interpolation), for when one pass must do.
    """
    rows = df.where(F.col(x).isNotNull()).select(
        F.struct(*[F.col(k) for k in keys] or [F.lit(1).alias("one")]).alias("_k"), F.col(x).cast("double").alias("_x")
    )
    named = [F.col("_k")[k].alias(k) for k in keys]
    if approx:
        return rows.groupBy("_k").agg(
            F.approx_percentile("_x", [float(p) for p in probs]).alias(out),
            F.count(F.lit(1)).alias("n"), F.min("_x").alias("min"), F.max("_x").alias("max"),
        ).select(*named, out, "n", "min", "max")
    edges = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-MARGIN, MARGIN)})
    sketch = settle(rows.groupBy("_k").agg(
        F.count(F.lit(1)).alias("n"), F.min("_x").alias("min"), F.max("_x").alias("max"),
        F.approx_percentile("_x", edges, ACCURACY).alias("_s"),
    ), "sketch")

    def edge(p: float) -> Column:
        return F.when(F.col("n") >= FEW, F.get("_s", F.lit(edges.index(min(1.0, max(0.0, p))))))

    found = settle(_positions(rows, sketch, probs, [
        (F.coalesce(edge(p - MARGIN), "min"), F.coalesce(edge(p + MARGIN), "max")) for p in probs
    ]), "quantiles")
    missed = found.where(F.exists("_q", lambda v: v.isNull())).select("_k")
    if not missed.isEmpty():
        again = _positions(
            rows.join(missed, "_k", "left_semi"), sketch.join(missed, "_k", "left_semi"), probs,
            [(F.col("min"), F.col("max")) for _ in probs],
        )
        found = found.join(missed, "_k", "left_anti").unionByName(again)
    return found.select(*named, F.col("_q").alias(out), "n", "min", "max")


def _positions(
    rows: DataFrame, sketch: DataFrame, probs: Sequence[float], ends: Sequence[tuple[Column, Column]]
) -> DataFrame:
    """The values at the positions of ``probs``, looked up between the ``ends``; null where they are outside."""
    js = range(len(probs))
    bound = sketch.select("_k", *[c.alias(f"_{n}{j}") for j in js for n, c in zip("ab", ends[j])])
    placed = rows.join(bound, "_k")
    below = placed.groupBy("_k").agg(F.array(*[F.count_if(F.col("_x") < F.col(f"_a{j}")) for j in js]).alias("_b"))
    inside = [F.when((F.col("_x") >= F.col(f"_a{j}")) & (F.col("_x") <= F.col(f"_b{j}")), F.lit(j)) for j in js]
    values = placed.select("_k", "_x", F.explode(F.array_compact(F.array(*inside))).alias("_j")).groupBy("_k", "_j", "_x").agg(
        F.count(F.lit(1)).alias("_n")
    )
    # positions on both sides of each quantile, counted from 0
    at = (F.col("n") - 1) * F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("_j"))
    wanted = sketch.join(below, "_k").select("_k", "n", F.posexplode("_b").alias("_j", "_below")).select(
        "_k", "_j", "_below", F.floor(at).alias("_lo"), F.ceil(at).alias("_hi"), (at - F.floor(at)).alias("_part")
    )
    if (sketch.agg(F.max("n")).first()[0] or 0) > MOST:
        values, wanted = settle(values, "values"), settle(wanted, "wanted")
        while True:
            crowded = values.groupBy("_k", "_j").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > MOST)
            crowded = settle(crowded.drop("_c"), "crowded")
            if crowded.isEmpty():
                break
            values, wanted = _narrowed(values, wanted, crowded)
    earlier = Window.partitionBy("_k", "_j").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    counted = values.join(wanted, ["_k", "_j"]).withColumn("_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + F.col("_below"))

    def value(i: str) -> Column:
        return F.max(F.when((F.col("_run") <= F.col(i)) & (F.col(i) < F.col("_run") + F.col("_n")), F.col("_x")))

    ends_of = counted.groupBy("_k", "_j", "_part").agg(value("_lo").alias("_l"), value("_hi").alias("_h"))
    between = F.col("_l") + (F.col("_h") - F.col("_l")) * F.col("_part")
    picked = ends_of.groupBy("_k").agg(*[F.max(F.when(F.col("_j") == j, between)).alias(f"_q{j}") for j in js])
    return sketch.select("_k", "n", "min", "max").join(picked, "_k", "left").select(
        "_k", "n", "min", "max", F.array(*[f"_q{j}" for j in js]).alias("_q")
    )


def _narrowed(values: DataFrame, wanted: DataFrame, crowded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The values of crowded brackets in the parts that hold their positions, and what lies below these parts.

    Parts are bounded by quantiles of the different values, so each has about 1 / PARTS of them however
    they are spread, and at least two parts have some: every round gets somewhere.
    """
    key = ["_k", "_j"]
    here = values.join(crowded, key, "left_semi")
    cuts = [i / PARTS for i in range(1, PARTS)]
    edges = settle(here.groupBy(*key).agg(F.approx_percentile("_x", cuts, ACCURACY).alias("_edges")), "edges")
    # an edge ends the part before it, so that the largest value alone does not make the last part the whole
    numbered = here.join(edges, key).withColumn("_no", F.size(F.filter("_edges", lambda e: e < F.col("_x")))).drop("_edges")
    parts = numbered.groupBy(*key, "_no").agg(F.sum("_n").alias("_m"))
    earlier = Window.partitionBy(*key).orderBy("_no").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_m").over(earlier), F.lit(0)) + F.col("_below")
    held = parts.join(wanted, key).withColumn("_before", before).where(
        (F.col("_before") <= F.col("_hi")) & (F.col("_before") + F.col("_m") > F.col("_lo"))
    )
    held = settle(held.select(*key, "_no", "_before"), "parts")
    kept = numbered.join(held, [*key, "_no"], "left_semi").drop("_no")
    below = held.groupBy(*key).agg(F.min("_before").alias("_new"))
    moved = wanted.join(below, key, "left").withColumn("_below", F.coalesce("_new", "_below")).drop("_new")
    rest = values.join(crowded, key, "left_anti")
    return settle(rest.unionByName(kept), "values"), settle(moved, "wanted")


def quantile_cuts(
    df: DataFrame,
    x: str,
    probs: Sequence[float] = (0.2, 0.4, 0.6, 0.8),
    keys: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Quantiles rounded to 4 digits, equal neighbours merged, as ``cuts``."""
    q = quantiles(df, x, probs, keys, "_q", approx)
    rounded = F.array_distinct(F.transform("_q", lambda v: round_to(v, 4)))
    return q.select(*keys, rounded.alias("cuts"), "n", "min", "max")


def brackets(
    df: DataFrame,
    x: str,
    y: str,
    keys: Sequence[str],
    probs: Sequence[float] = (0.2, 0.4, 0.6, 0.8),
    edges: Sequence[float] = tuple(BRACKET_EDGES),
    bands: Sequence[str] = tuple(BRACKET_BANDS),
    min_points: int = 5,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Quantile brackets of ``x`` against bands of ``y``, per key.

    A point falls in bracket i when i cuts are at or below its x, which makes the
    last bracket closed. Gives the number of points, and per band the count and
    the percentage of the bracket. Keys with fewer than ``min_points`` points
    give no rows and empty brackets are left out. Pass a constant column as key
    for one table over everything.
    """
    salt = {f"_s{i}": F.col(c) for i, c in enumerate(salt_by or [x, y])}
    # read by the quantiles, the hot-key count and the join, so written once in its narrow form
    points = settle(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"),
        *[c.alias(n) for n, c in salt.items()],
    ), "points")
    cuts = quantile_cuts(points, "_x", probs, keys).where(F.col("n") >= min_points)
    placed = salted_join(
        points, cuts.drop("n"), keys, "inner", list(salt)
    ).withColumn(
        "bracket_no", F.size(F.filter("cuts", lambda c: c <= F.col("_x")))
    ).withColumn("_band", band("_y", edges, bands))
    counted = placed.groupBy(*keys, "bracket_no", "cuts", "min", "max").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("_band") == b).alias(f"n_{b}") for b in bands],
    )
    ends = F.concat(F.array("min"), F.col("cuts"), F.array("max"))
    low, high = F.get(ends, F.col("bracket_no")), F.get(ends, F.col("bracket_no") + 1)

    def whole(c: Column) -> Column:
        return F.round(c, 0).cast("bigint").cast("string")

    return counted.select(
        *keys,
        "bracket_no",
        F.concat(whole(low), F.lit("–"), whole(high), F.lit("%")).alias("bracket"),
        low.alias("low"),
        high.alias("high"),
        "n",
        *[f"n_{b}" for b in bands],
        *[(F.col(f"n_{b}") / F.col("n") * 100).alias(b) for b in bands],
    )


def histogram(df: DataFrame, x: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty ones included; the last is closed."""
    value = F.col(x).cast("double")
    rows = df.where(F.col(x).isNotNull()).select(value.alias("_x"))
    ends = rows.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    number = F.coalesce(F.least(F.width_bucket("_x", lo, hi, F.lit(bins)), F.lit(bins)), F.lit(1))
    counted = rows.groupBy(number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / F.lit(bins)
    all_bins = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counted, "bin", "left").select(
        "bin",
        (lo + width * (F.col("bin") - 1)).alias("low"),
        (lo + width * F.col("bin")).alias("high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def summary(df: DataFrame, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean, median and maximum: one row per key, without keys one row (of no values: 0 and nulls)."""
    mid = quantiles(df, x, [0.5], keys)
    if not keys:
        # one row, also of an empty table
        means = df.agg(F.avg(x).alias("mean"))
        found = mid.agg(F.coalesce(F.max("n"), F.lit(0)).alias("count"), F.max(F.get("q", F.lit(0))).alias("median"), F.max("max").alias("max"))
        return found.select("count", means.scalar().alias("mean"), "median", "max")
    means = df.where(F.col(x).isNotNull()).groupBy(*keys).agg(F.avg(x).alias("mean"))
    return mid.join(means, list(keys)).select(*keys, F.col("n").alias("count"), "mean", F.get("q", F.lit(0)).alias("median"), "max")
