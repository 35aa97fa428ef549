"""Hard-negative mining with exact integer scores by the method of the Four Russians.

Vectors become integers, floor(scale * x). A row is kept as bit planes: bit b of eight neighbouring dimensions is one
byte. For an anchor the sums of all 256 subsets of each eight dimensions are put in a table once; a score is then
made of look-ups by the row's bytes, added up plane by plane with a shift between, the sign plane taken off.
No product is computed, and the score is the whole inner product.

For each anchor the best rows of its own label are its positives. For each positive, rows of other labels whose score
lies between two shares of the positive's score are its hard negatives. Anchors and rows meet in tiles of at
most about ``ANCHORS`` by ``ROWS``, so a label with a third of all rows covers many tiles; a tile sends on the few best of
each anchor only. Positives are searched among rows of the same label, negatives among all.

Defined cases: rows with a null id, label or vector or with null or non-finite components take no part; vectors are
compared with those of their length, empty ones score 0; an id names one vector, of rows with the same id one counts (the
smallest label, then bits); ties go to the smaller id; scores are 64-bit numbers that wrap around beyond that, components
are cut at 2^62; an anchor with no positive, or a positive with no negative, gives no row; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.plans.lineage import settle

POSITIVES, NEGATIVES, SCALE = 5, 3, 256
#: Negatives score between these hundredths of their positive's score.
LEAST, MOST = 50, 95
#: Anchors and rows of a tile; of these, so many are scored at once.
ANCHORS, ROWS, SOME_ANCHORS, SOME_ROWS = 8192, 4096, 128, 512

PACKED = "id long, label string, width int, anchor boolean, bits int, planes binary"


def bit_planes(ints: np.ndarray) -> np.ndarray:
    """(row, plane, group of eight dimensions) -> byte, of two's complement numbers with as many planes as they need."""
    top = max(int(ints.max(initial=0)), ~int(ints.min(initial=0)))
    planes = [np.packbits((ints >> b & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(top.bit_length() + 1)]
    return np.stack(planes, axis=1)


def _widened(planes: np.ndarray, n: int) -> np.ndarray:
    """The same numbers with n planes: the sign plane is repeated."""
    return np.concatenate([planes, np.repeat(planes[:, -1:], n - planes.shape[1], axis=1)], axis=1)


def numbers(planes: np.ndarray) -> np.ndarray:
    """The integers of bit planes, their number rounded up to whole bytes."""
    weight = np.int64(1) << np.arange(planes.shape[1], dtype=np.int64)
    weight[-1] = -weight[-1]
    bits = np.unpackbits(planes, axis=2, bitorder="little")
    return np.einsum("nbd,b->nd", bits, weight, dtype=np.int64, casting="unsafe")


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(group, subset as a byte, anchor) -> sum of the anchor's dimensions in the subset."""
    n, width = anchors.shape
    dims = anchors.T.reshape(width // 8, 8, n).astype(kind)
    out = np.zeros((width // 8, 256, n), kind)
    for k in range(8):
        out[:, 1 << k : 2 << k] = out[:, : 1 << k] + dims[:, k : k + 1]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(anchor, row) -> inner product."""
    n_planes, out = planes.shape[1], []
    for at in range(0, len(planes), SOME_ROWS):
        some = planes[at : at + SOME_ROWS]
        sums = np.zeros((len(some), tables.shape[2]), tables.dtype)
        found = np.empty_like(sums)
        for b in range(n_planes - 1, -1, -1):
            sums <<= 1
            for g in range(len(tables)):
                np.take(tables[g], some[:, b, g], axis=0, out=found, mode="clip")
                if b == n_planes - 1:
                    sums -= found
                else:
                    sums += found
        out.append(sums.T)
    return np.concatenate(out, axis=1)


def _kind(anchors: np.ndarray, n_planes: int) -> type:
    """32 bits where no score or part of one can be larger."""
    most = int(np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0)) + 1
    return np.int32 if most << n_planes < 2**31 else np.int64


def _best(values: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of the n largest allowed values of each line, the first of equal ones first."""
    left = np.where(allowed, values, np.iinfo(values.dtype).min)
    many = allowed.sum(axis=1)
    lines, columns = [], []
    for k in range(min(n, left.shape[1])):
        some = np.flatnonzero(many > k)
        column = left[some].argmax(axis=1)
        lines.append(some)
        columns.append(column)
        left[some, column] = np.iinfo(values.dtype).min
    return (np.concatenate(lines), np.concatenate(columns)) if lines else (np.zeros(0, np.int64),) * 2


class Side:
    """The anchors or the rows of a tile, by id."""

    def __init__(self, tile: pa.Table, names: dict[str, int]):
        tile = tile.sort_by("id")
        self.tile, self.ids = tile, tile["id"].to_numpy()
        self.label = np.array([names.setdefault(x, len(names)) for x in tile["label"].to_pylist()], np.int64)
        width, bits = tile["width"][0].as_py() if len(tile) else 0, tile["bits"].to_numpy()
        groups, most = -(-width // 8), int(bits.max(initial=1))
        blobs = tile["planes"].to_pylist()
        self.planes = np.zeros((len(tile), most, groups), np.uint8)
        for b in np.unique(bits):
            at = np.flatnonzero(bits == b)
            raw = np.frombuffer(b"".join(blobs[i] for i in at), np.uint8)
            self.planes[at] = _widened(raw.reshape(len(at), b, groups), most)


def _scored(tile: pa.Table) -> Iterator[tuple[Side, Side, slice, np.ndarray]]:
    """(anchors, rows, which anchors, their scores with all rows) for some anchors at a time."""
    names: dict[str, int] = {}
    of_anchors = tile["as_anchor"].combine_chunks()
    anchors, rows = Side(tile.filter(of_anchors), names), Side(tile.filter(pa.compute.invert(of_anchors)), names)
    if not len(anchors.ids) or not len(rows.ids):
        return
    ints = numbers(anchors.planes)
    for at in range(0, len(ints), SOME_ANCHORS):
        which = slice(at, at + SOME_ANCHORS)
        yield anchors, rows, which, scores(subset_sums(ints[which], _kind(ints[which], rows.planes.shape[1])), rows.planes)


def _table(columns: dict[str, list[np.ndarray]]) -> pa.Table:
    return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for n, v in columns.items()})


def _positives(n: int):
    def run(tile: pa.Table) -> pa.Table:
        out = {"anchor_id": [], "positive_id": [], "positive_score": []}
        for anchors, rows, which, found in _scored(tile):
            ids = anchors.ids[which]
            allowed = (anchors.label[which][:, None] == rows.label) & (ids[:, None] != rows.ids)
            a, r = _best(found, allowed, n)
            for name, values in zip(out, (ids[a], rows.ids[r], found[a, r])):
                out[name].append(values.astype(np.int64))
        return _table(out)

    return run


def _bounds(score: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and largest integer between the hundredths of a score, without larger products."""
    whole, rest = score // 100, score % 100
    return least * whole - (-least * rest) // 100, most * whole + most * rest // 100


def _negatives(n: int, least: int, most: int):
    def run(tile: pa.Table) -> pa.Table:
        out = {"anchor_id": [], "positive_id": [], "positive_score": [], "negative_id": [], "negative_score": []}
        for anchors, rows, which, found in _scored(tile):
            ids, others = anchors.ids[which], anchors.label[which][:, None] != rows.label
            positives = anchors.tile["positives"].slice(which.start, len(ids)).to_pylist()
            for k in range(max(map(len, positives))):
                some = np.array([i for i, p in enumerate(positives) if len(p) > k])
                score = np.array([positives[i][k]["positive_score"] for i in some], np.int64)
                named = np.array([positives[i][k]["positive_id"] for i in some], np.int64)
                low, high = _bounds(score, least, most)
                values = found[some]
                a, r = _best(values, others[some] & (values >= low[:, None]) & (values <= high[:, None]), n)
                for name, v in zip(out, (ids[some][a], named[a], score[a], rows.ids[r], values[a, r])):
                    out[name].append(v.astype(np.int64))
        return _table(out)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("v")
        at, flat = np.asarray(lists.offsets), np.asarray(lists.values)
        width = np.diff(at)
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            planes = bit_planes(flat[at[rows][:, None] + np.arange(w)].astype(np.int64))
            some = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([
                some.column("id"), some.column("label"), pa.array(width[rows].astype(np.int32)), some.column("anchor"),
                pa.array(np.full(len(rows), planes.shape[1], np.int32)), pa.array([p.tobytes() for p in planes], pa.binary()),
            ], names=["id", "label", "width", "anchor", "bits", "planes"])


def _tiled(rows: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and anchors of each key, dealt to tiles: rows once per part of the anchors, anchors once per part of the rows."""
    of_anchors = anchors.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(ANCHORS)).cast("int").alias("a_parts"))
    of_rows = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(ROWS)).cast("int").alias("r_parts"))
    # written, so that its size is known and the planner can choose how to join it
    parts = settle(of_rows.join(of_anchors, keys), "parts")

    def dealt(side: DataFrame, own: str, other: str, as_anchor: bool) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.col(f"{own}_parts")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1))
        return side.join(parts, keys).withColumn(f"{own}_part", part).withColumn(f"{other}_part", every).withColumn(
            "as_anchor", F.lit(as_anchor)).drop("a_parts", "r_parts")

    tiles = dealt(rows, "r", "a", False).unionByName(dealt(anchors, "a", "r", True), allowMissingColumns=True)
    return tiles.groupBy(*keys, "a_part", "r_part")


def _first(found: DataFrame, keys: list[str], score: str, ident: str, n: int, rank: str = "rank") -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(ident))
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)


def hard_negatives(
    rows: DataFrame, anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str | Column = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE, least: int = LEAST, most: int = MOST,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor``: which rows are anchors. The first ``positives`` rows of an anchor's label, and for each the first
    ``negatives`` rows of other labels scoring from ``least`` to ``most`` hundredths of the positive's score.
    """
    vec = F.col(embedding).cast("array<double>")
    marked = rows.select(
        F.col(vec_id).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), vec.alias("v"),
    )
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    marked = marked.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(sound)
    edge = F.lit(float(1 << 62))
    whole = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * F.lit(float(scale)), edge), -edge)))
    packed = marked.withColumn("v", whole).mapInArrow(_packed, PACKED)
    one = packed.groupBy("id").agg(F.min(F.struct("label", "width", "bits", "planes", "anchor")).alias("one"))
    all_ = settle(one.select("id", "one.*"), "planes")
    anchors = all_.where("anchor").drop("anchor")
    all_ = all_.drop("anchor")

    near = _tiled(all_, anchors, ["width", "label"]).applyInArrow(
        _positives(positives), "anchor_id long, positive_id long, positive_score long"
    )
    near = _first(near, ["anchor_id"], "positive_score", "positive_id", positives)
    listed = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asking = settle(anchors.join(listed, "id"), "anchors")
    far = _tiled(all_, asking, ["width"]).applyInArrow(
        _negatives(negatives, least, most),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    best = _first(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
