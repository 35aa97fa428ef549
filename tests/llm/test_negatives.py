"""Hard negatives against plain Python, and the query against its SQL."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import bindings, hard_negatives
from tests.compare import connect, differences

SCHEMA = "vec_id long, embedding array<double>, label string, anchor_id string, planes string"


def plain(rows: list[tuple], every: int, positives: int = 5, negatives: int = 3) -> list[tuple]:
    sound = {}
    for i, v, y, *_ in rows:
        if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v):
            sound[i] = (y, [math.floor(256 * x) for x in v])
    out = []
    for a, (y, v) in sound.items():
        if a % every:
            continue
        score = {i: sum(p * q for p, q in zip(v, w)) for i, (_, w) in sound.items() if i != a and len(w) == len(v)}
        near = sorted((i for i in score if sound[i][0] == y), key=lambda i: (-score[i], i))[:positives]
        for p in near:
            far = [i for i in score if sound[i][0] != y and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            for k, i in enumerate(sorted(far, key=lambda i: (-score[i], i))[:negatives]):
                out.append((a, p, k + 1, i, score[p], score[i]))
    return sorted(out)


def vectors(n: int, width: int, seed: int, size: float = 1.0) -> list[tuple]:
    draw = random.Random(seed)
    centre = [draw.gauss(0, 1) for _ in range(width)]
    out = []
    for i in range(n):
        v = [size * (c + draw.gauss(0, 0.7)) / math.sqrt(width) for c in centre]
        out.append((i, v, "hot" if draw.random() < 0.4 else draw.choice("abc"), "x", "y"))
    return out


def mined(spark, rows: list[tuple], every: int, **more) -> list[tuple]:
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, hard_negatives.hard_negatives(frame, F.col("vec_id") % every == 0, **more).collect()))


@pytest.fixture
def small_tiles(monkeypatch):
    for name, n in (("ANCHORS", 7), ("ROWS", 20), ("SOME_ANCHORS", 3), ("SOME_ROWS", 8)):
        monkeypatch.setattr(hard_negatives, name, n)


def test_against_plain(spark):
    rows = vectors(300, 20, 1)
    want = plain(rows, 5)
    assert len(want) > 300 and mined(spark, rows, 5) == want
    assert mined(spark, rows, 5, positives=2, negatives=7) == plain(rows, 5, 2, 7)


def test_small_tiles(spark, small_tiles):
    rows = vectors(150, 16, 2)
    assert mined(spark, rows, 4) == plain(rows, 4)


def test_defined_cases(spark):
    rows = vectors(60, 9, 3)
    rows += [(None, [1.0] * 9, "a", "", ""), (100, None, "a", "", ""), (105, [0.1] * 9, None, "", ""), (110, [None] + [0.1] * 8, "a", "", "")]
    rows += [(115, [math.nan] * 9, "a", "", ""), (120, [math.inf] * 9, "a", "", ""), (125, [], "a", "", ""), (130, [], "b", "", ""), (135, [], "a", "", "")]
    rows += [(200 + i, rows[3][1], rows[3][2], "", "") for i in range(12)]  # ties
    rows += [(300 + i, [0.1 * i, 0.2, 0.3], "ab"[i % 2], "", "") for i in range(12)]  # another length
    rows += [(400, [0.0] * 9, "a", "", "")]
    want = plain(rows, 5)
    assert mined(spark, rows, 5) == want
    assert {125, 200} <= {r[0] for r in want} and any(300 <= r[0] < 312 for r in want)
    assert not {100, 105, 110, 115, 120} & {i for r in want for i in (r[0], r[1], r[3])}
    assert mined(spark, rows + rows[:40], 5) == want  # repeated rows
    assert mined(spark, [], 5) == []
    assert mined(spark, rows[:1], 1) == []


def test_large_components(spark):
    """Scores beyond 32 bits, and rows of few and many planes together."""
    rows = vectors(60, 12, 4, 1e5) + [(i + 60, [x / 1e5 for x in v], y, "", "") for i, v, y, *_ in vectors(60, 12, 4, 1e5)]
    assert max(r[4] for r in plain(rows, 3)) > 2**33 and mined(spark, rows, 3) == plain(rows, 3)


def test_scores():
    draw = np.random.default_rng(7)
    for width, size, kind in ((1, 1, np.int64), (8, 3, np.int32), (64, 300, np.int32), (13, 10**12, np.int64)):
        a, r = draw.integers(-size, size + 1, (5, width)), draw.integers(-size, size + 1, (600, width))
        planes = hard_negatives.bit_planes(r)
        padded = hard_negatives.numbers(hard_negatives.bit_planes(a))
        assert (padded[:, :width] == a).all() and not padded[:, width:].any()
        got = hard_negatives.scores(hard_negatives.subset_sums(padded, kind), planes)
        assert (got == a @ r.T).all()  # both wrap around where 64 bits are too few


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    name = "op12_hard_negatives"
    got = bindings.QUERIES[name](spark, folder)
    assert got.count() > 0
    assert differences(got, connect(folder), bindings.ORACLES[name]) == []
