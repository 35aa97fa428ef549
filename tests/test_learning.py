"""Linear models, bootstrap weights, components and clusters against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import linear

COLUMNS = ["a", "b", "c"]


@pytest.fixture
def data(frame):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, 3)) * [1, 5, 0.2] + [0, 20, 3]
    y = x @ [2.0, -1.0, 4.0] + 7 + draw.normal(size=400)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(400)]
    return frame(rows + [(400, None, 1.0, 1.0, 1.0), (401, 1.0, 1.0, 1.0, None)], "id int, a double, b double, c double, y double"), x, y


def by_numpy(x, y, penalty=0.0):
    xc = x - x.mean(axis=0)
    slopes = np.linalg.solve(xc.T @ xc + penalty * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    return np.concatenate([[y.mean() - x.mean(axis=0) @ slopes], slopes])


@pytest.mark.parametrize("penalty", [0.0, 10.0, 1e6])
def test_ridge(data, penalty):
    df, x, y = data
    m = linear.matrices(linear.product_sums(df, [*COLUMNS, "y"]))[0]
    fit = linear.ridge(m, penalty)
    assert fit == pytest.approx(by_numpy(x, y, penalty))
    assert linear.squared_error(m, fit) == pytest.approx(((y - fit[0] - x @ fit[1:]) ** 2).sum())


def test_cross_validation(data):
    df, x, y = data
    got = {(r.penalty, r.fold): (r.n, r.rmse) for r in linear.cross_validate(df, COLUMNS, "y", F.col("id") % 4, [0.0, 50.0]).collect()}
    assert len(got) == 8
    for (p, k), (n, rmse) in got.items():
        held = np.arange(400) % 4 == k
        fit = by_numpy(x[~held], y[~held], p)
        assert n == held.sum() and rmse == pytest.approx(math.sqrt(((y[held] - fit[0] - x[held] @ fit[1:]) ** 2).mean()))


def test_cross_validation_scans_once(data, monkeypatch):
    """However many folds and penalties there are, one aggregate is run."""
    df, *_ = data
    runs, plain = [], linear.matrices
    monkeypatch.setattr(linear, "matrices", lambda sums: runs.append(sums) or plain(sums))
    linear.cross_validate(df, COLUMNS, "y", F.col("id") % 20, [0.0, 1.0, 2.0, 3.0])
    assert len(runs) == 1


def test_equal_columns_have_a_fit(frame):
    df = frame([(float(i), float(i), 3.0 * i) for i in range(9)], "a double, b double, y double")
    m = linear.matrices(linear.product_sums(df, ["a", "b", "y"]))[0]
    assert linear.squared_error(m, linear.ridge(m)) == pytest.approx(0, abs=1e-6)


def test_bags(data):
    df, x, y = data
    drawn = linear.bags(df.withColumn("key", F.col("id").cast("string")), "key", 40).where("id < 400").groupBy("bag").agg(F.sum("weight").alias("n"), F.count("*").alias("rows")).collect()
    assert len(drawn) == 40 and 0.95 < np.mean([r.n for r in drawn]) / 400 < 1.05 and 0.6 < np.mean([r.rows for r in drawn]) / 400 < 0.67
    keyed = df.withColumn("key", F.col("id").cast("string"))
    fit = linear.bagged_ridge(keyed, COLUMNS, "y", "key", 20)
    assert list(fit) == list(linear.bagged_ridge(keyed.repartition(7), COLUMNS, "y", "key", 20)) or fit == pytest.approx(linear.bagged_ridge(keyed.repartition(7), COLUMNS, "y", "key", 20))
    assert fit == pytest.approx(by_numpy(x, y), rel=0.2)


def test_components(data):
    df, x, _ = data
    value, way, mean = linear.components(df.where("id < 400"), COLUMNS)
    want = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert value == pytest.approx(want) and mean == pytest.approx(x.mean(axis=0))
    assert (way[np.abs(way).argmax(axis=0), range(3)] > 0).all()
    scores = np.array([[r.pc1, r.pc2] for r in linear.component_scores(df.where("id < 400"), COLUMNS, 2).orderBy("id").collect()])
    assert scores.var(axis=0, ddof=1) == pytest.approx(want[:2]) and np.corrcoef(scores.T)[0, 1] == pytest.approx(0, abs=1e-9)


def test_kmeans(frame):
    r = random.Random(5)
    rows = [(i, 10.0 * (i % 3) + r.gauss(0, 0.5), 5.0 * (i % 3) + r.gauss(0, 0.5)) for i in range(300)]
    df = frame(rows, "id int, a double, b double")
    placed, centres = linear.kmeans(df, ["a", "b"], 5)
    got = placed.collect()
    assert len(got) == 300 and len(centres) == 5
    for x in got:
        far = [(x.a - c.a) ** 2 + (x.b - c.b) ** 2 for c in centres]
        assert x.distance == pytest.approx(min(far)) and far[x.cluster] == min(far)
    for c in centres:
        own = [(x.a, x.b) for x in got if x.cluster == c.cluster]
        assert not own or (c.a, c.b) == pytest.approx(tuple(np.mean(own, axis=0)))
    assert linear.kmeans(df.where("false"), ["a", "b"], 3)[0].count() == 0
    assert [x.cluster for x in linear.kmeans(df.repartition(5), ["a", "b"], 5)[0].orderBy("id").collect()] == [x.cluster for x in sorted(got, key=lambda x: x.id)]
