"""Polygons from WKT, and the point-in-polygon join.

A polygon is its edges: ``ARRAY<STRUCT<x1, y1, x2, y2>>`` over all rings and parts.
Holes need no flag, the even-odd rule takes care of them.

The join is an equi-join on grid cells. Each polygon picks the grid level at which its bounding box
spans only a few cells (more for polygons of many edges), so small and huge polygons alike give a
bounded number of rows; a point is looked up once per level in use. A cell keeps the edges that
cross it and whether its lower left corner is inside. The way from this corner to a point of the cell
stays in the cell, so only these edges can change the answer; a cell without edges lies
inside or outside as a whole, and in the latter case is not kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.exprs import strip_fips
from tallymark.functions.lookups import FALLBACK_BOX
from tallymark.plans.lineage import settle
from tallymark.plans.skew import salted_join

SPLITS = 8


def wkt_rings(wkt: str) -> Column:
    """All rings of a POLYGON or MULTIPOLYGON column as ``ARRAY<ARRAY<STRUCT<x, y>>>``."""
    return F.expr(rf"""
        transform(regexp_extract_all(`{wkt}`, r'\(([^()]+)\)', 1),
            ring -> transform(split(ring, ','),
                p -> named_struct('x', CAST(split(trim(p), ' +')[0] AS DOUBLE),
                                  'y', CAST(split(trim(p), ' +')[1] AS DOUBLE))))""")


def ring_edges(rings: str) -> Column:
    """Edges between consecutive points of every ring, in one list."""
    return F.expr(f"""
        flatten(transform(`{rings}`, ring -> zip_with(
            slice(ring, 1, greatest(size(ring) - 1, 0)), slice(ring, 2, greatest(size(ring) - 1, 0)),
            (a, b) -> named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y))))""")


def with_edges(polygons: DataFrame, wkt: str = "geometry") -> DataFrame:
    """Replace the WKT column by ``edges`` and the box ``xmin, ymin, xmax, ymax``."""
    df = polygons.withColumn("_rings", wkt_rings(wkt)).withColumn("edges", ring_edges("_rings"))
    return df.drop(wkt, "_rings").selectExpr(
        "*",
        "array_min(edges.x1) AS xmin", "array_min(edges.y1) AS ymin",
        "array_max(edges.x1) AS xmax", "array_max(edges.y1) AS ymax",
    )


def _side(x: str, y: str) -> str:
    """Whether a point lies on the left of an edge. A point of the edge's line counts as moved right, then (by less) up."""
    turn = f"((e.x2 - e.x1) * ({y} - e.y1) - (e.y2 - e.y1) * ({x} - e.x1))"
    return f"""CASE WHEN {turn} > 0 THEN true WHEN {turn} < 0 THEN false
                    WHEN e.y1 = e.y2 THEN e.x2 > e.x1 ELSE e.y1 > e.y2 END"""


def strictly_inside(edges: str, corner_inside: str, x0: str, y0: str, x: str, y: str) -> Column:
    """Point in the interior: an odd change on the way right and up from the corner (x0, y0), and on no edge.

    Both legs ask for the side of the bend by the same expression, so rounding there cannot
    count an edge on one leg and miss it on the other.
    """
    crossed = f"""CAST(((e.y1 > {y0}) != (e.y2 > {y0})) AND (({_side(x0, y0)}) != ({_side(x, y0)})) AS INT)
                + CAST(((e.x1 > {x}) != (e.x2 > {x})) AND (({_side(x, y0)}) != ({_side(x, y)})) AS INT)"""
    return F.expr(f"""
        aggregate({edges}, CAST({corner_inside} AS INT), (n, e) -> n + {crossed}) % 2 = 1
        AND NOT exists({edges}, e ->
            (e.x2 - e.x1) * ({y} - e.y1) = (e.y2 - e.y1) * ({x} - e.x1)
            AND {x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
            AND {y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))""")


def _level(splits: int) -> str:
    """The finest grid level (cell width 2^level) at which the box is at most ``splits`` cells long.

    Polygons of many edges get up to as many cells as edges, so that a cell is crossed by few, but no
    cells shorter than their edges are on average, so that an edge crosses few cells.
    """
    extent, coarse = "greatest(xmax - xmin, ymax - ymin, 1e-9)", f"{float(splits)}D"
    length = """aggregate(edges, 0D, (s, e) -> s + greatest(abs(e.x2 - e.x1), abs(e.y2 - e.y1))) / greatest(size(edges), 1)"""
    width = f"greatest({extent} / greatest({coarse}, sqrt(size(edges))), least({extent} / {coarse}, {length}))"
    return f"CAST(ceil(log2({width})) AS INT)"


def _inside_corners(edges: DataFrame) -> DataFrame:
    """Cells (``_pid, cx, cy``) whose lower left corner is inside.

    Where an edge meets a grid line, corners up to some column ``k`` have it on their right. Sorted, these columns
    bound the stretches of corners with an odd number of edges to the right.
    """
    met = edges.selectExpr(
        "*", "explode(sequence(CAST(ceil(least(e.y1, e.y2) / _w) AS BIGINT), CAST(ceil(greatest(e.y1, e.y2) / _w) AS BIGINT) - 1)) AS cy"
    ).where("(e.y1 > cy * _w) != (e.y2 > cy * _w)")
    met = met.selectExpr("*", "CAST(floor((e.x1 + (cy * _w - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0D)) / _w) AS BIGINT) AS k")
    # the division may round to a neighbour, the side decides
    right = [f"({_side(f'(k + {d}) * _w', 'cy * _w')}) = (e.y2 > e.y1)" for d in (1, 0)]
    met = met.selectExpr("_pid", "cy", f"CASE WHEN {right[0]} THEN k + 1 WHEN {right[1]} THEN k ELSE k - 1 END AS k")
    lines = met.groupBy("_pid", "cy").agg(F.sort_array(F.collect_list("k"), asc=False).alias("ks"))
    odd = lines.selectExpr("_pid", "cy", "explode(sequence(0, size(ks) - 1, 2)) AS i", "ks").selectExpr(
        "_pid", "cy", "ks[i] AS k", "get(ks, i + 1) AS least").where("k > least")
    return odd.selectExpr("_pid", "explode(sequence(least + 1, k)) AS cx", "cy")


def polygon_cells(polygons: DataFrame, splits: int = SPLITS) -> DataFrame:
    """One row per polygon and cell (``level, cx, cy``): the ``edges`` that cross it, and ``corner_inside``.

    A polygon covers about (splits + 1)^2 cells, or as many as it has edges. Edges are rows on the way, so a
    polygon of any size is spread over tasks, and an edge is stored once per cell it crosses.
    """
    marked = polygons.where("xmin IS NOT NULL").selectExpr("*", f"{_level(splits)} AS level", "monotonically_increasing_id() AS _pid")
    # written, so that the numbers are the same for every reader
    marked = settle(marked, "polygons")
    edges = marked.selectExpr("_pid", "pow(2D, level) AS _w", "explode(edges) AS e")
    over = edges.selectExpr(
        "*", "explode(sequence(CAST(floor(least(e.x1, e.x2) / _w) AS BIGINT), CAST(floor(greatest(e.x1, e.x2) / _w) AS BIGINT))) AS cx"
    ).selectExpr(
        "*", "explode(sequence(CAST(floor(least(e.y1, e.y2) / _w) AS BIGINT), CAST(floor(greatest(e.y1, e.y2) / _w) AS BIGINT))) AS cy"
    )
    corners = [
        f"((e.x2 - e.x1) * ((cy + {j}) * _w - e.y1) - (e.y2 - e.y1) * ((cx + {i}) * _w - e.x1))" for i in (0, 1) for j in (0, 1)
    ]
    crossing = over.where(f"least({', '.join(corners)}) <= 0 AND greatest({', '.join(corners)}) >= 0")
    rows = crossing.select("_pid", "cx", "cy", "e").unionByName(_inside_corners(edges), allowMissingColumns=True)
    cells = rows.groupBy("_pid", "cx", "cy").agg(
        F.collect_list("e").alias("edges"), F.bool_or(F.col("e").isNull()).alias("corner_inside")
    )
    return cells.join(marked.drop("edges"), "_pid").drop("_pid")


def within_pairs(
    points: DataFrame, polygons: DataFrame, key: Sequence[str], lon: str, lat: str,
    columns: Sequence[str], splits: int = SPLITS,
) -> DataFrame:
    """(point key, polygon columns) for every polygon a point lies strictly inside. Starts a job for the cells."""
    cells = settle(polygon_cells(polygons, splits).select("level", "cx", "cy", "edges", "corner_inside", *columns), "cells")
    # levels are powers of two between the smallest and largest polygon: a few dozen at most
    levels = cells.agg(F.collect_set("level")).scalar()
    spots = points.select(
        *key, F.col(lon).cast("double").alias("_x"), F.col(lat).cast("double").alias("_y"),
        F.explode(levels).alias("level"),
    ).where("_x IS NOT NULL AND _y IS NOT NULL")
    spots = spots.selectExpr(
        "*", "floor(_x / pow(2D, level)) AS cx", "floor(_y / pow(2D, level)) AS cy"
    )
    met = salted_join(spots, cells, ["level", "cx", "cy"], "inner", list(key))
    inside = strictly_inside("edges", "corner_inside", "cx * pow(2D, level)", "cy * pow(2D, level)", "_x", "_y")
    return met.where(inside).select(*key, *columns)


def within_left(
    points: DataFrame, polygons: DataFrame, key: Sequence[str], lon: str, lat: str,
    columns: Mapping[str, str], splits: int = SPLITS,
) -> DataFrame:
    """Left point-in-polygon join.

    Unmatched points get nulls, points in several polygons are repeated.
    ``columns`` maps polygon columns to output names. ``key`` must be unique in ``points``.
    """
    source = polygons.select(
        "edges", "xmin", "ymin", "xmax", "ymax", *[F.col(c).alias(o) for c, o in columns.items()]
    )
    pairs = within_pairs(points, source, key, lon, lat, list(columns.values()), splits)
    return points.join(pairs, list(key), "left")


def geocode(
    points: DataFrame, states: DataFrame, counties: DataFrame, zctas: DataFrame,
    lat: str = "latitude", lon: str = "longitude", keep_unmatched_literal: bool = False,
) -> DataFrame:
    """Location table: state, county and zip of every distinct coordinate pair.

    Layers come from ``with_edges``. Codes lose leading zeros. Unmatched codes are
    empty, or ``'nan'`` when the literal is wanted.
    """
    missing = "nan" if keep_unmatched_literal else ""
    spots = points.select(
        F.col(lat).cast("double").alias("latitude"), F.col(lon).cast("double").alias("longitude")
    ).distinct()
    key = ["latitude", "longitude"]
    layers = [
        (states, {"name": "state", "state_fips": "state_fips"}),
        (counties, {"name": "county", "county_fips": "county_fips"}),
        (zctas, {"geoid": "zip"}),
    ]
    # each layer meets the distinct points, so repeats from one layer do not grow the next one's work
    out = spots
    for polygons, columns in layers:
        source = polygons.select(
            "edges", "xmin", "ymin", "xmax", "ymax",
            *[F.col(c).alias(o) for c, o in columns.items()],
        )
        pairs = within_pairs(spots, source, key, "longitude", "latitude", list(columns.values()))
        out = out.join(pairs, key, "left")
    empty = F.lit("")
    return out.select(
        *key,
        F.coalesce("zip", empty).alias("zip"),
        F.coalesce("county", empty).alias("county"),
        strip_fips("county_fips", missing).alias("county_fips"),
        F.coalesce("state", empty).alias("state"),
        strip_fips("state_fips", missing).alias("state_fips"),
    )


def bbox(
    polygons: DataFrame, keys: Sequence[str] = (),
    fallback: tuple[float, float, float, float] = FALLBACK_BOX,
) -> DataFrame:
    """Bounding box per key; ``fallback`` where there is no polygon."""
    names = ["lon_min", "lat_min", "lon_max", "lat_max"]
    raw = [F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")]
    return polygons.groupBy(*keys).agg(
        *[F.coalesce(r, F.lit(f)).alias(n) for r, f, n in zip(raw, fallback, names)]
    )
