"""Queries for model training. Those with a closed form are held against SQL; the rows of others depend on the fit."""

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tallymark.bindings.registry import register, rounded
from tallymark.operators import linear, ml
from tallymark.plans.lineage import scratch_path, settle

NUMERIC = ["enrollment", "grade_eight_enrollment", "schools_in_zip", "math_counts", "math_low_pct", "read_counts", "read_high_pct",
           "read_low_pct", "avg_natwalkind", "total_10_14", "pct_10_14", "total_pop", "hhi_150k_200k", "hhi_220k_plus",
           "pct_hhi_150k_200k", "pct_hhi_220k_plus"]


def prepared(t):
    rows = t("features").withColumn("id", F.col("school_id"))
    return ml.prepare(rows, "math_high_pct", NUMERIC, ["school_type"], ["school_name", "ncessch", "dupe_rank"], keep_features=8,
                      held_out=F.col("school_id") % 10 < 3)[0]


def _split(t):
    rows = _features(t)
    return rows.where(~F.col(ml.HELD_OUT)), rows.where(ml.HELD_OUT)


def _features(t):
    """Feature rows, written once: the fits go over them many times."""
    return settle(prepared(t).select("id", ml.LABEL, ml.HELD_OUT, ml.FEATURES), "features")


def _forest(seed=123):
    return RandomForestRegressor(featuresCol=ml.FEATURES, labelCol=ml.LABEL, numTrees=10, maxDepth=4, seed=seed)


def _prepare(t):
    df = prepared(t)
    values = vector_to_array(ml.FEATURES)
    return df.select("id", ml.LABEL, *[F.get(values, F.lit(i)).alias(f"f{i}") for i in range(8)])


register("ml_prepare", _prepare)


_PLAIN = ["enrollment", "math_counts", "total_10_14"]


def _scaled(t):
    """Logarithm, outliers and scaling, fitted on the rows that are not held out."""
    rows = t("golden").select(F.col("school_id").alias("id"), "math_high_pct", *_PLAIN)
    out = ml.prepare(rows, "math_high_pct", _PLAIN, held_out=F.col("id") % 10 < 3)[0]
    values = vector_to_array(ml.FEATURES)
    return rounded(out.select("id", ml.HELD_OUT, *[F.get(values, F.lit(i)).alias(c) for i, c in enumerate(_PLAIN)]), 6)


register(
    "ml_scaled", _scaled,
    f"""WITH l AS (SELECT school_id AS id, school_id % 10 < 3 AS held_out, {', '.join(f'sign({c}) * ln(1 + abs({c})) AS {c}' for c in _PLAIN)}
                   FROM <golden> WHERE math_high_pct IS NOT NULL),
          f AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in _PLAIN)} FROM l WHERE NOT held_out),
          k AS (SELECT l.* FROM l, f WHERE held_out OR ({' AND '.join(f'abs({c} - m_{c}) / s_{c} <= 4' for c in _PLAIN)})),
          g AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in _PLAIN)} FROM k WHERE NOT held_out)
        SELECT id, held_out, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) AS {c}' for c in _PLAIN)} FROM k, g""",
)


def _line(t):
    """A fit on one feature, saved and loaded again."""
    rows = t("golden").where("math_high_pct IS NOT NULL AND read_high_pct IS NOT NULL").select(
        F.col("math_high_pct").alias(ml.LABEL), "read_high_pct")
    stages = [VectorAssembler(inputCols=["read_high_pct"], outputCol=ml.FEATURES), LinearRegression(featuresCol=ml.FEATURES, labelCol=ml.LABEL)]
    path = scratch_path(t.spark, "line")
    ml.finalize(rows, Pipeline(stages=stages), path)
    fit = PipelineModel.load(path).stages[-1]
    error = F.col(ml.LABEL) - F.col(ml.PREDICTION)
    facts = PipelineModel.load(path).transform(rows).agg(
        F.count(F.lit(1)).alias("n"), (F.abs(F.avg(error)) < 1e-6).alias("centred"))
    return rounded(facts.select("n", "centred", F.lit(float(fit.coefficients[0])).alias("slope"), F.lit(fit.intercept).alias("intercept")), 5)


register(
    "ml_line", _line,
    """SELECT count(*) AS n, true AS centred, round(regr_slope(math_high_pct, read_high_pct), 5) AS slope,
              round(regr_intercept(math_high_pct, read_high_pct), 5) AS intercept
       FROM <golden> WHERE math_high_pct IS NOT NULL AND read_high_pct IS NOT NULL""",
)
register("ml_compare_trees", lambda t: ml.compare(*_split(t)))


def _tune(t):
    train, _ = _split(t)
    return ml.tune(train, _forest(), {"numTrees": [5, 10], "maxDepth": [3, 5]}, folds=2)[1]


register("ml_tune_forest", _tune)


def _finalize(t):
    df = _features(t)
    path = scratch_path(t.spark, "model")
    ml.finalize(df, Pipeline(stages=[LinearRegression(featuresCol=ml.FEATURES, labelCol=ml.LABEL)]), path)
    return ml.residuals(PipelineModel.load(path).transform(df))


register("ml_finalize_all", _finalize)
register("ml_ensemble_forest", lambda t: ml.score(ml.bag(*_split(t), _forest(), k=3)))


def _diagnostics(t):
    train, _ = _split(t)
    return ml.importances(_forest().fit(train), train)


register("ml_diagnostics_forest", _diagnostics)


def _unsupervised(t):
    df = _features(t)
    return ml.pca(df, 2).join(ml.kmeans(df, 4), "id").join(ml.gmm(df, 2), "id")


register("ml_unsupervised_models", _unsupervised)


# Models with a closed form: their results are held against SQL.
_LABEL, _ONE, _TWO = "math_high_pct", "read_high_pct", "math_low_pct"
_HELD = "school_id % 10 < 3"
_TRAIN = f"""d AS (SELECT school_id AS id, school_id % 10 < 3 AS held, {_ONE} AS x, {_TWO} AS z, {_LABEL} AS y FROM <features>
                  WHERE {_ONE} IS NOT NULL AND {_TWO} IS NOT NULL AND {_LABEL} IS NOT NULL)"""


def _facts(where: str, by: str = "1", weight: str = "1") -> str:
    """Means and centred sums of products of x, z and y, weighted."""
    sums = {f"{a}{b}": f"sum({weight} * {a} * {b}) - sum({weight} * {a}) * sum({weight} * {b}) / sum({weight})" for a, b in ("xx", "xz", "zz", "xy", "zy")}
    means = ", ".join(f"sum({weight} * {c}) / sum({weight}) AS m{c}" for c in "xzy")
    return f"SELECT {by} AS k, {means}, {', '.join(f'{e} AS {n}' for n, e in sums.items())} FROM {where} GROUP BY 1"


register(
    "ml_compare",
    lambda t: rounded(linear.compare_linear(t("features"), {"mean": [], "one": [_ONE], "two": [_ONE, _TWO]}, _LABEL, F.expr(_HELD)), 6),
    f"""WITH {_TRAIN}, f AS ({_facts('d WHERE NOT held')}),
          c AS (SELECT *, xx * zz - xz * xz AS det FROM f),
          e AS (SELECT unnest([{{'model': 'mean', 'e': y - my}}, {{'model': 'one', 'e': y - my - xy / xx * (x - mx)}},
                      {{'model': 'two', 'e': y - my - (xy * zz - xz * zy) / det * (x - mx) - (xx * zy - xz * xy) / det * (z - mz)}}]) AS s, y FROM d, c WHERE held)
        SELECT s.model AS model, count(*) AS n, round(sqrt(avg(s.e * s.e)), 6) AS rmse, round(avg(abs(s.e)), 6) AS mae,
               round(1 - avg(s.e * s.e) / var_pop(y), 6) AS r2 FROM e GROUP BY 1""",
)
_PENALTIES = [0.0, 1000.0, 100000.0]
register(
    "ml_tune",
    lambda t: rounded(linear.cross_validate(t("features").where(f"{_TWO} IS NOT NULL"), [_ONE], _LABEL, F.col("school_id") % 3, _PENALTIES), 6),
    f"""WITH {_TRAIN}, g AS (SELECT CAST(range AS INT) AS fold FROM range(3)), r AS (SELECT g.fold, d.* FROM g JOIN d ON d.id % 3 <> g.fold),
          f AS ({_facts('r', 'fold')}), p AS (SELECT unnest([{', '.join(f'{p}e0' for p in _PENALTIES)}]) AS penalty)
        SELECT penalty, k AS fold, count(*) AS n, round(sqrt(avg((y - my - xy / (xx + penalty) * (x - mx)) ** 2)), 6) AS rmse
        FROM f, p, d WHERE d.id % 3 = k GROUP BY 1, 2""",
)


def _finalized(t):
    """A fit on all rows, saved, loaded and applied: one residual per row."""
    rows = t("features").where(f"{_LABEL} IS NOT NULL AND {_ONE} IS NOT NULL AND {_TWO} IS NOT NULL").select(
        F.col("school_id").alias("id"), F.col(_LABEL).alias(ml.LABEL), _ONE, _TWO)
    stages = [VectorAssembler(inputCols=[_ONE, _TWO], outputCol=ml.FEATURES), LinearRegression(featuresCol=ml.FEATURES, labelCol=ml.LABEL)]
    path = scratch_path(t.spark, "final")
    ml.finalize(rows, Pipeline(stages=stages), path)
    return rounded(ml.residuals(PipelineModel.load(path).transform(rows)), 5)


_PLANE = "my + (xy * zz - xz * zy) / (xx * zz - xz * xz) * (x - mx) + (xx * zy - xz * xy) / (xx * zz - xz * xz) * (z - mz)"
register(
    "ml_finalize", _finalized,
    f"""WITH {_TRAIN}, f AS ({_facts('d')})
        SELECT id, round(y, 5) AS label, round({_PLANE}, 5) AS prediction, round({_PLANE} - y, 5) AS residual FROM d, f""",
)
_BAGS = 5
_DRAW = "('0x' || substr(md5(id || '/' || b), 1, 8))::BIGINT / 4294967296e0"
_STEPS = [sum(math.exp(-1.0) / math.factorial(j) for j in range(k + 1)) for k in range(12)]
_DRAWN = f"""b AS (SELECT CAST(range AS INT) AS b FROM range({_BAGS})), u AS (SELECT d.*, b, {_DRAW} AS u FROM d, b WHERE NOT held),
             w AS (SELECT *, {' + '.join(f'(u >= {s!r})::INT' for s in _STEPS)} AS w FROM u)"""


def _bagged(t):
    """Least squares on bootstrap samples: mean coefficients, and the score of their mean prediction on held-out rows."""
    rows = t("features").withColumn("id", F.col("school_id").cast("string"))
    fit = linear.bagged_ridge(rows.where(f"NOT ({_HELD})"), [_ONE, _TWO], _LABEL, "id", _BAGS)
    test = rows.where(F.expr(_HELD) & F.col(_ONE).isNotNull() & F.col(_TWO).isNotNull() & F.col(_LABEL).isNotNull())
    scored = ml.score(test.select(F.col(_LABEL).alias(ml.LABEL), linear.predicted(fit, [_ONE, _TWO]).alias(ml.PREDICTION)))
    return rounded(scored.withColumns({"slope_one": F.lit(float(fit[1])), "slope_two": F.lit(float(fit[2]))}), 6)


register(
    "ml_ensemble", _bagged,
    f"""WITH {_TRAIN}, {_DRAWN}, f AS ({_facts('w WHERE w > 0', 'b', 'w')}),
          c AS (SELECT (xy * zz - xz * zy) / (xx * zz - xz * xz) AS p, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS q, mx, mz, my FROM f),
          a AS (SELECT avg(p) AS p, avg(q) AS q, avg(my - p * mx - q * mz) AS i FROM c), e AS (SELECT y, y - i - p * x - q * z AS e, p, q FROM d, a WHERE held)
        SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, round(1 - avg(e * e) / var_pop(y), 6) AS r2,
               round(any_value(p), 6) AS slope_one, round(any_value(q), 6) AS slope_two FROM e""",
)


def _weights(t):
    rows = t("features").where(f"{_ONE} IS NOT NULL AND {_TWO} IS NOT NULL AND {_LABEL} IS NOT NULL").where(f"NOT ({_HELD})")
    drawn = linear.bags(rows.withColumn("id", F.col("school_id").cast("string")), "id", _BAGS)
    w = F.col("weight")
    return rounded(drawn.groupBy("bag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("weight").alias("n_drawn"), F.max("weight").alias("most"),
        (F.sum(w * F.col(_LABEL)) / F.sum("weight")).alias("mean")), 6)


register(
    "ml_bag_weights", _weights,
    f"""WITH {_TRAIN}, {_DRAWN} SELECT b AS bag, count(*) AS n_rows, CAST(sum(w) AS BIGINT) AS n_drawn, max(w) AS most,
               round(sum(w * y) / sum(w), 6) AS mean FROM w WHERE w > 0 GROUP BY 1""",
)


def _diagnosed(t):
    """Standardised coefficients as importances, and what the residuals add up to."""
    rows = t("features").where(f"NOT ({_HELD})")
    m = linear.matrices(linear.product_sums(rows, [_ONE, _TWO, _LABEL]))[0]
    fit, c = linear.ridge(m), linear.centred(m)
    facts = [(n, float(abs(fit[i + 1]) * math.sqrt(c[i, i] / c[-1, -1])), 1 - linear.squared_error(m, fit) / float(c[-1, -1]))
             for i, n in enumerate((_ONE, _TWO))]
    return rounded(t.spark.createDataFrame(facts, "feature string, importance double, r2 double"), 6)


register(
    "ml_diagnostics", _diagnosed,
    f"""WITH {_TRAIN}, f AS ({_facts('d WHERE NOT held')}), s AS (SELECT var_pop(y) * count(*) AS yy FROM d WHERE NOT held),
          c AS (SELECT *, (xy * zz - xz * zy) / (xx * zz - xz * xz) AS p, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS q FROM f, s),
          r AS (SELECT *, (p * xy + q * zy) / yy AS r2 FROM c)
        SELECT '{_ONE}' AS feature, round(abs(p) * sqrt(xx / yy), 6) AS importance, round(r2, 6) AS r2 FROM r
        UNION ALL SELECT '{_TWO}', round(abs(q) * sqrt(zz / yy), 6), round(r2, 6) FROM r""",
)


def _structure(t):
    """Variances of two principal components, taken from the scores; and of clusters what holds for any clustering.

    Squares within and between clusters add up to the whole, no row has a nearer centre, and centres are means.
    """
    rows = t("features").withColumnRenamed("school_id", "id")
    scores = linear.component_scores(rows, [_ONE, _TWO], 2).agg(F.var_samp("pc1").alias("a"), F.var_samp("pc2").alias("b"), F.corr("pc1", "pc2").alias("r"))
    placed, centres = linear.kmeans(rows, [_ONE, _TWO], 4)
    placed = settle(placed, "placed")
    near = placed.select("distance", F.array_min(F.array(*[
        F.pow(F.col(_ONE) - c[_ONE], 2) + F.pow(F.col(_TWO) - c[_TWO], 2) for c in centres])).alias("best"))
    mean = placed.agg(F.avg(_ONE).alias("x"), F.avg(_TWO).alias("z")).first()
    between = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg(_ONE).alias("x"), F.avg(_TWO).alias("z"), F.sum("distance").alias("d"))
    whole = between.agg(
        F.sum("n").alias("n"), F.sum(F.col("d") + F.col("n") * (F.pow(F.col("x") - mean.x, 2) + F.pow(F.col("z") - mean.z, 2))).alias("squares"),
        (F.count(F.lit(1)) == len(centres)).alias("all_used"))
    closest = near.agg(F.bool_and(F.abs(F.col("distance") - F.col("best")) < 1e-9)).scalar()
    of_scores = scores.select(F.struct("a", "b", "r")).scalar()
    facts = whole.withColumn("nearest", closest).withColumn("s", of_scores).select("*", "s.*")
    return rounded(facts.select("n", "squares", "all_used", "nearest", (F.abs("r") < 1e-6).alias("uncorrelated"), F.col("a").alias("first"),
                                F.col("b").alias("second"), (F.col("a") / (F.col("a") + F.col("b"))).alias("share")), 3)


register(
    "ml_unsupervised", _structure,
    f"""WITH d AS (SELECT {_ONE} AS x, {_TWO} AS z FROM <features> WHERE {_ONE} IS NOT NULL AND {_TWO} IS NOT NULL),
          v AS (SELECT count(*) AS n, (var_pop(x) + var_pop(z)) * count(*) AS squares, var_samp(x) AS a, covar_samp(x, z) AS b, var_samp(z) AS c FROM d),
          e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) AS p, (a + c) / 2 - sqrt(((a - c) / 2) ** 2 + b * b) AS q FROM v)
        SELECT n, round(squares, 3) AS squares, true AS all_used, true AS nearest, true AS uncorrelated, round(p, 3) AS first, round(q, 3) AS second,
               round(p / (p + q), 3) AS share FROM e""",
)
