"""Near-duplicate embeddings by a forest of random-projection trees.

A tree splits vectors by a random direction at the middle of their projections; those near the
middle go to both sides (spill), so that near vectors are seldom torn apart. Several trees are
grown; vectors that share a leaf and a label are compared by cosine in double precision, and
those at or above the threshold are linked. A pair is counted in the first leaf it shares only.

The splits of the upper levels are fitted on a bounded sample (``SAMPLE`` rows, by hash of the id);
every row is put in leaves. Equal vectors are compared once. Leaves of any size are compared in
tiles of ``TILE`` vectors; a tile sends on sums of links and a spanning forest, never its pairs.

Defined cases: vectors that are null or zero or hold null or non-finite numbers, and rows with a null
label or id, link with nothing and form their own component; vectors of different length link
with nothing, of any number of lengths; repeated rows link with each other; an empty table gives an empty table; further
columns are ignored. An id is taken to name one vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.components import components
from tallymark.plans.lineage import settle

LEAF, SAMPLE, SPILL, TILE = 512, 20_000, 0.05, 1024
#: Trees for vectors that are split up to so many times; deeper trees tear more pairs apart, so there are more of them.
TREES = {0: 1, 14: 10, 18: 16, 24: 36}
#: Lengths whose trees are fitted, the most frequent ones; others take the bands of a fitted tree's lower levels.
LENGTHS = 64
#: Levels a tree can have, levels fitted on the sample, fewest sample rows a split is fitted on.
DEPTH, FITTED, LEAST = 24, 10, 32


def trees_for(depth: int) -> int:
    """Trees that rows split ``depth`` times are put in."""
    return next(n for most, n in TREES.items() if depth <= most)


class Forest:
    """Directions per tree and level; per fitted node the band around its middle that goes both ways."""

    def __init__(self, sample: np.ndarray, width: int, depth: int = DEPTH, seed: int = 0):
        draw = np.random.default_rng([seed, width])
        trees = trees_for(depth)
        self.ways = draw.standard_normal((trees, DEPTH, width))
        self.ways /= np.linalg.norm(self.ways, axis=2, keepdims=True)
        size = 2 ** (FITTED + 1) - 1
        self.low = np.full((trees, size), -SPILL / np.sqrt(width))
        self.high = -self.low
        for t in range(trees if len(sample) else 0):
            nodes = {0: np.arange(len(sample))}
            for level in range(min(FITTED, depth)):
                below = {}
                for node, rows in nodes.items():
                    if len(rows) < LEAST:
                        continue
                    p = sample[rows] @ self.ways[t, level]
                    self.low[t, node], middle, self.high[t, node] = np.quantile(p, [0.5 - SPILL, 0.5, 0.5 + SPILL])
                    below[2 * node + 1], below[2 * node + 2] = rows[p <= middle], rows[p > middle]
                nodes = below
        self.default = SPILL / np.sqrt(width)

    def leaves(self, x: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of unit rows x, each split ``depth`` times; leaves are numbered by tree, then node."""
        out_row, out_leaf = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        trees = np.array([trees_for(d) for d in range(DEPTH + 1)])[depth]
        for t in range(int(trees.max(initial=0))):
            row = np.flatnonzero(trees > t)
            node = np.zeros(len(row), np.int64)
            for level in range(int(depth.max(initial=0)) + 1):
                done = depth[row] <= level
                out_row.append(row[done])
                out_leaf.append((t << 32) + node[done])
                row, node = row[~done], node[~done]
                if not len(row):
                    break
                p = np.einsum("ij,j->i", x[row], self.ways[t, level])
                if level < FITTED:
                    low, high = self.low[t, node], self.high[t, node]
                else:
                    low, high = -self.default, self.default
                left, right = p <= high, p >= low
                row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
        return np.concatenate(out_row), np.concatenate(out_leaf)


def _unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _leaf_rows(forests: dict[int, Forest]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column("width").to_numpy(zero_copy_only=False)
            depth = batch.column("depth").to_numpy(zero_copy_only=False)
            blobs = batch.column("vec").to_pylist()
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                x = _unit(np.frombuffer(b"".join(blobs[i] for i in at), np.float64).reshape(len(at), w))
                if int(w) not in forests:
                    forests[int(w)] = Forest(np.zeros((0, int(w))), int(w))
                row, leaf = forests[int(w)].leaves(x, depth[at])
                order = np.lexsort([leaf, row])
                row, leaf = row[order], leaf[order]
                row_at = np.searchsorted(row, np.arange(len(at) + 1))
                lists = pa.ListArray.from_arrays(row_at.astype(np.int32), pa.array(leaf))
                take = pa.array(at[row])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(take) for c in ("id", "label", "width", "size", "vec")], pa.array(leaf), lists.take(pa.array(row))],
                    names=["id", "label", "width", "size", "vec", "leaf", "leaves"],
                )

    return run


def _forest_edges(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of n nodes with a link, a pair (node, smallest node it can reach)."""
    top = np.arange(n)
    while True:
        least = np.minimum(top[i], top[j])
        new = top.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, top[i], least)
        np.minimum.at(new, top[j], least)
        new = new[new]
        if (new == top).all():
            break
        top = new
    at = np.flatnonzero(top != np.arange(n))
    return at, top[at]


def _compare(threshold: float):
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        """Links within a tile, or between the two parts of one: rows (a, links) and rows (a, b)."""
        here = int(tile["leaf"].iloc[0])
        x = _unit(np.frombuffer(b"".join(tile["vec"]), np.float64).reshape(len(tile), -1))
        ids, size, part = (tile[c].to_numpy() for c in ("id", "size", "part"))
        most = max(map(len, tile["leaves"]))
        codes = np.full((len(tile), most), -1, np.int64)
        for r, c in enumerate(tile["leaves"]):
            codes[r, : len(c)] = c
        codes[codes >= here] = -1  # earlier leaves only
        within = tile["part_a"].iloc[0] == tile["part_b"].iloc[0]
        first, second = (np.arange(len(x)),) * 2 if within else (np.flatnonzero(part == tile["part_a"].iloc[0]), np.flatnonzero(part == tile["part_b"].iloc[0]))
        links = np.zeros(len(x), np.int64)
        edges_i, edges_j = [], []
        for at in range(0, len(first), 256):
            rows = first[at : at + 256]
            near = (x[rows] @ x[second].T) >= threshold
            i, j = np.nonzero(near)
            i, j = rows[i], second[j]
            if within:
                i, j = i[i < j], j[i < j]
            edges_i.append(i)
            edges_j.append(j)
            met = np.zeros(len(i), bool)
            for c in range(most):
                own = codes[i, c]
                met |= (own >= 0) & (own[:, None] == codes[j]).any(axis=1)
            i, j = i[~met], j[~met]
            links += np.bincount(i, size[j], len(x)).astype(np.int64) + np.bincount(j, size[i], len(x)).astype(np.int64)
        a, b = _forest_edges(np.concatenate(edges_i), np.concatenate(edges_j), len(x)) if edges_i else (first[:0], first[:0])
        some = np.flatnonzero(links)
        return pd.DataFrame({
            "a": np.concatenate([ids[some], ids[a]]),
            "b": pd.array(np.concatenate([np.zeros(len(some), np.int64), ids[b]]), "Int64"),
            "links": np.concatenate([links[some], np.full(len(a), -1)]),
        })

    return run


def near_duplicates(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.93,
) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``."""
    vec = F.col(embedding).cast("array<double>")
    sound = (
        F.col(vec_id).isNotNull() & F.col(label).isNotNull() & (F.size(vec) > 0)
        & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vec, lambda v: v != 0)
    )
    all_ = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), vec.alias("v"),
        F.coalesce(sound, F.lit(False)).alias("sound"),
    ).withColumn("digest", F.when(F.col("sound"), F.unhex(F.md5(F.to_json(F.struct("v")).cast("binary")))))
    good = all_.where("sound")
    good = good.withColumn("width", F.size("v"))
    sizes = good.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n"))
    classes = good.groupBy("label", "digest").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("v").alias("v")
    ).withColumn("width", F.size("v"))
    depth = F.least(F.lit(DEPTH), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / F.lit(LEAF))))).cast("int")
    classes = settle(classes.join(sizes, ["label", "width"]).withColumn("depth", depth).drop("n"), "classes")
    # trees are fitted where there is something to split
    widths = classes.where("depth > 0").groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("depth"))
    forests = {}
    for w, _, deepest in widths.orderBy(F.desc("n"), "width").limit(LENGTHS).collect():
        some = classes.where(F.col("width") == w).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toPandas()["v"]
        forests[w] = Forest(_unit(np.stack(some.to_numpy())), w, deepest)
    classes = classes.drop("width")
    packed = classes.mapInArrow(_packed, "id long, label string, width int, depth int, size long, vec binary")
    placed = settle(packed.mapInArrow(
        _leaf_rows(forests), "id long, label string, width int, size long, vec binary, leaf long, leaves array<long>"
    ), "leaves")
    leaf = ["label", "width", "leaf"]
    parts = placed.groupBy(*leaf).agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE)).cast("int").alias("parts"))
    placed = placed.join(parts, leaf).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tiles = placed.withColumn("_other", other).withColumns({
        "part_a": F.least("part", "_other"), "part_b": F.greatest("part", "_other"),
    }).drop("_other", "parts")
    found = settle(
        tiles.groupBy(*leaf, "part_a", "part_b").applyInPandas(_compare(threshold), "a long, b long, links long"), "found"
    )
    links = found.where("links >= 0").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    # a class of copies is linked in itself
    groups = components(found.where("links < 0").select("a", "b"))
    per_class = classes.select("label", "digest", "id", "size").join(links, "id", "left").join(
        groups.withColumnRenamed("node", "id"), "id", "left"
    ).select(
        "label", "digest", F.coalesce("component", "id").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
    )
    out = all_.select("vec_id", "label", "digest").join(per_class, ["label", "digest"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("v")
        at, flat = np.asarray(lists.offsets), np.asarray(lists.values)
        blobs = [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), batch.column("label").cast(pa.string()), pa.array(np.diff(at).astype(np.int32)), batch.column("depth"),
            batch.column("size"), pa.array(blobs, pa.binary()),
        ], names=["id", "label", "width", "depth", "size", "vec"])
