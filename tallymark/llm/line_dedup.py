"""Line deduplication by site-relative frequency.

Pages are grouped by host. For each line of a host, the number of its pages that contain the
line is divided by the number of all its pages; lines above a ratio are boilerplate of that
site and are dropped wherever they stand on it.

Defined cases: a null host is a host of its own; a null text has no lines and stays null; blank
lines are layout and are never dropped; a line counts once per page however often it stands there;
repeated rows are pages of their own; an empty table gives an empty table. Columns of the
input are kept, and those named like a result column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.plans.lineage import settle

#: Share of a host's pages above which a line is boilerplate.
MAX_RATIO = 0.08
#: A line repeats if at least two pages hold it; beyond that the share alone decides, at every size of a host.
MIN_PAGES = 2


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _solid(line: Column) -> Column:
    return F.trim(line) != ""


def line_frequency(pages: DataFrame, host: str, text: str) -> DataFrame:
    """Per host and line (``line``: its digest): ``n_pages`` of the host with the line.

    Only digests are shuffled; a page's repeats go before the shuffle, and each task adds up
    its own pages first, so a host with a third of all pages is spread by its lines.
    """
    keys = F.array_distinct(F.transform(F.filter(_lines(text), _solid), _key))
    per_page = pages.select(F.struct(F.col(host).alias("host")).alias("site"), F.explode(keys).alias("line"))
    return per_page.groupBy("site", "line").agg(F.count(F.lit(1)).alias("n_pages"))


def boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Per host (``site``): digests of its boilerplate lines (``lines``).

    A host with l lines a page has at most l / max_ratio of them, whatever its number of pages.
    """
    site = F.struct(F.col(host).alias("host")).alias("site")
    totals = pages.groupBy(site).agg(F.count(F.lit(1)).alias("n_all"))
    frequent = line_frequency(pages, host, text).where(F.col("n_pages") >= min_pages)
    over = frequent.join(totals, "site").where(F.col("n_pages") > F.col("n_all") * F.lit(float(max_ratio)))
    return over.groupBy("site").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """The pages without their sites' boilerplate lines; adds ``n_lines`` and ``n_dropped``.

    The boilerplate table is written first. Its size is then known to the planner, which
    broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and else joins by host, where AQE
    splits a hot host.
    """
    bad = settle(boilerplate(pages, host, text, max_ratio, min_pages), "boilerplate")
    # the whole row in one column, so that its names meet none of ours
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.struct(F.col(host).alias("host")).alias("site"),
        F.col(text).alias("text"),
    ).join(bad.withColumnRenamed("lines", "bad"), "site", "left")
    lines = _lines("text")
    kept = F.filter(lines, lambda x: ~_solid(x) | ~F.array_contains("bad", _key(x)))
    rows = rows.withColumn("kept", F.when(F.col("bad").isNull(), lines).otherwise(kept))
    new = {
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_dropped": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines) - F.size("kept")).cast("long"),
        text: F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")),
    }
    return rows.select(*[
        (new[c] if c in new else F.col("row").getField(c)).alias(c) for c in dict.fromkeys([*pages.columns, "n_lines", "n_dropped"])
    ])
