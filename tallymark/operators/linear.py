"""Linear models, principal components and clusters from sums.

Sums of the products of all pairs of columns say everything a linear model needs. They are taken in one
aggregate over the rows, per fold or bag, and combined map-side; what reaches the driver is one small
matrix for each. So cross-validation over any number of folds and penalties, or a bag of models,
costs one scan. Random choices come from hashes of the row's key and are the same in every run.

Rows with a null in a used column are left out.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Groups (folds, bags) whose sums are brought to the driver at most.
MOST_GROUPS = 10_000


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def product_sums(df: DataFrame, columns: Sequence[str], group: Column | None = None, weight: Column | None = None) -> DataFrame:
    """Per group: ``products``, the (weighted) sums of z_i z_j for i <= j, where z is 1 and then the columns."""
    z = [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]
    w = F.lit(1.0) if weight is None else weight.cast("double")
    sums = [F.sum(w * z[i] * z[j]) for i in range(len(z)) for j in range(i, len(z))]
    rows = _complete(df, columns).withColumn("group", F.lit(0) if group is None else group)
    return rows.groupBy("group").agg(F.array(*sums).alias("products"))


def matrices(sums: DataFrame) -> dict:
    """The symmetric matrix of each group of ``product_sums``."""
    rows = sums.limit(MOST_GROUPS + 1).collect()
    if len(rows) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups")
    out = {}
    for r in rows:
        n = int((math.sqrt(8 * len(r.products) + 1) - 1) / 2)
        m = np.zeros((n, n))
        m[np.triu_indices(n)] = r.products
        out[r.group] = m + np.triu(m, 1).T
    return out


def centred(m: np.ndarray) -> np.ndarray:
    """Sums of products of deviations from the means, of the columns after the first."""
    return m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) / m[0, 0]


def ridge(m: np.ndarray, penalty: float = 0.0) -> np.ndarray:
    """Intercept and coefficients for the last column; the penalty is added to the centred sums of squares."""
    c = centred(m)
    slopes = np.linalg.pinv(c[:-1, :-1] + penalty * np.eye(len(c) - 1)) @ c[:-1, -1]
    return np.concatenate([[(m[0, -1] - m[0, 1:-1] @ slopes) / m[0, 0]], slopes])


def squared_error(m: np.ndarray, fit: np.ndarray) -> float:
    """Sum of squared residuals of a fit on the rows of a matrix."""
    v = np.append(-fit, 1.0)
    return max(0.0, float(v @ m @ v))


def predicted(fit: Sequence[float], features: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.lit(float(b)) * F.col(c) for b, c in zip(fit[1:], features)], F.lit(float(fit[0])))


def cross_validate(
    df: DataFrame, features: Sequence[str], label: str, fold: Column, penalties: Sequence[float]
) -> DataFrame:
    """``penalty, fold, n, rmse`` of ridge models fitted without a fold and scored on it. One scan for all of them."""
    by_fold = matrices(product_sums(df, [*features, label], fold))
    whole = sum(by_fold.values())
    rows = []
    for k, held in by_fold.items():
        for p in penalties:
            fit = ridge(whole - held, float(p))
            rows.append((float(p), int(k), int(held[0, 0]), math.sqrt(squared_error(held, fit) / held[0, 0])))
    return df.sparkSession.createDataFrame(rows, "penalty double, fold int, n long, rmse double")


def compare_linear(df: DataFrame, models: Mapping[str, Sequence[str]], label: str, held_out: Column) -> DataFrame:
    """Hold-out ``rmse, mae, r2`` of least-squares models on different features, and the number of rows scored.

    One scan fits all of them, on rows where every column is present; a second one scores all.
    """
    every = list(dict.fromkeys(c for m in models.values() for c in m))
    rows = _complete(df, [*every, label])
    train = matrices(product_sums(rows.where(~held_out), [*every, label]))[0]
    errors, test = {}, rows.where(held_out)
    for name, features in models.items():
        at = [0, *[1 + every.index(c) for c in features], len(every) + 1]
        errors[name] = F.col(label) - predicted(ridge(train[np.ix_(at, at)]), features)
    scores = [
        F.struct(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
            (1 - F.try_divide(F.avg(e * e), F.var_pop(label))).alias("r2"),
        )
        for name, e in errors.items()
    ]
    return test.agg(F.array(*scores).alias("s")).select(F.inline("s"))


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from a hash of the parts' text, the same in every run."""
    digits = F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def poisson_weight(*parts: Column | str, most: int = 12) -> Column:
    """How often a row is drawn into a bootstrap sample: Poisson with mean 1, by hash."""
    below, steps, u = math.exp(-1.0), [], uniform(*parts)
    total = below
    for k in range(1, most + 1):
        steps.append(total)
        below /= k
        total += below
    return reduce(lambda a, b: a + b, [(u >= F.lit(s)).cast("int") for s in steps])


def bags(df: DataFrame, key: str, k: int) -> DataFrame:
    """Every row once per bag that draws it, with ``bag`` and ``weight``: K samples from one pass."""
    drawn = F.array(*[F.struct(F.lit(b).alias("bag"), poisson_weight(key, F.lit(b)).alias("weight")) for b in range(k)])
    return df.select("*", F.inline(F.filter(drawn, lambda s: s["weight"] > 0)))


def bagged_ridge(
    train: DataFrame, features: Sequence[str], label: str, key: str, k: int, penalty: float = 0.0
) -> np.ndarray:
    """Intercept and coefficients averaged over ``k`` bootstrap samples, whose mean prediction they give."""
    found = matrices(product_sums(bags(train, key, k), [*features, label], F.col("bag"), F.col("weight")))
    return np.mean([ridge(m, penalty) for m in found.values()], axis=0)


def components(df: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(variances, directions as columns, means) of the principal components, largest first.

    Each direction's largest entry is positive, so that the signs are the same in every run.
    """
    m = matrices(product_sums(df, features))[0]
    value, way = np.linalg.eigh(centred(m) / (m[0, 0] - 1))
    order = np.argsort(-value)
    value, way = value[order], way[:, order]
    way = way * np.sign(way[np.abs(way).argmax(axis=0), np.arange(len(value))])
    return value, way, m[0, 1:] / m[0, 0]


def component_scores(df: DataFrame, features: Sequence[str], k: int, key: str = "id") -> DataFrame:
    """Scores of every row on the first ``k`` components, as ``pc1, pc2, ...``."""
    _, way, mean = components(df, features)
    rows = _complete(df, features)
    return rows.select(key, *[
        predicted([-(mean @ way[:, i]), *way[:, i]], features).alias(f"pc{i + 1}") for i in range(k)
    ])


def _nearest(centres: Sequence[Sequence[float]], features: Sequence[str]) -> Column:
    """(squared distance, number) of the nearest centre."""
    def squared(c: Sequence[float]) -> Column:
        return reduce(lambda a, b: a + b, [F.pow(F.col(f) - F.lit(float(v)), 2) for f, v in zip(features, c)])

    return F.array_min(F.array(*[F.struct(squared(c).alias("d"), F.lit(i).alias("cluster")) for i, c in enumerate(centres)]))


def kmeans(
    df: DataFrame, features: Sequence[str], k: int, key: str = "id", rounds: int = 20
) -> tuple[DataFrame, list[Row]]:
    """Rows with ``cluster`` and ``distance`` (squared), and the centres. Seeds are the rows with the smallest hashes.

    A round is one aggregate; it ends early when no centre moves.
    """
    rows = _complete(df, features).select(key, *[F.col(f).cast("double").alias(f) for f in features])
    centres = [tuple(r) for r in rows.orderBy(uniform(key), key).limit(k).select(*features).collect()]
    for _ in range(rounds if centres else 0):
        means = [F.avg(f).alias(f) for f in features]
        moved = {r.cluster: r for r in rows.groupBy(_nearest(centres, features)["cluster"].alias("cluster")).agg(*means).collect()}
        # a centre without rows stays where it is
        new = [tuple(moved[i][f] for f in features) if i in moved else c for i, c in enumerate(centres)]
        if new == centres:
            break
        centres = new
    if not centres:
        return rows.select(key, F.lit(0).alias("cluster"), F.lit(0.0).alias("distance")), []
    near = _nearest(centres, features)
    placed = rows.select(key, *features, near["cluster"].alias("cluster"), near["d"].alias("distance"))
    return placed, [Row(cluster=i, **dict(zip(features, c))) for i, c in enumerate(centres)]
