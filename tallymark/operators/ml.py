"""Regression on the school feature table, and unsupervised views of it, with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    PCA, Imputer, OneHotEncoder, StandardScaler, StringIndexer, UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.linear import poisson_weight
from tallymark.plans.lineage import settle

LABEL, FEATURES, PREDICTION, HELD_OUT = "label", "features", "prediction", "held_out"


def _within(fit_on: DataFrame, columns: Sequence[str], limit: float) -> Column:
    """Whether every value is within ``limit`` standard deviations of its mean in ``fit_on``."""
    parts = [F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in columns]
    facts = fit_on.agg(F.struct(*parts)).scalar()
    keep = F.lit(True)
    for c in columns:
        z = F.try_divide(F.abs(F.col(c) - facts.getField(c).getField("m")), facts.getField(c).getField("s"))
        keep = keep & (F.coalesce(z, F.lit(0.0)) <= limit)
    return keep


def drop_outliers(df: DataFrame, columns: Sequence[str], limit: float = 4.0) -> DataFrame:
    """Rows with every value within ``limit`` standard deviations of its mean."""
    return df.where(_within(df, columns, limit))


def prepare(
    df: DataFrame,
    target: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    ignore: Sequence[str] = (),
    keep_features: int | None = None,
    held_out: Column | None = None,
) -> tuple[DataFrame, PipelineModel]:
    """Feature vectors, whether a row is ``held_out``, and the fitted pipeline that makes the vectors.

    Rows without target are dropped, numbers are compressed with a signed logarithm,
    outliers removed, gaps filled with the median, categories one-hot encoded, everything
    scaled, and with ``keep_features`` only the best features by F-test are kept. All of this is
    fitted on the rows that are not held out; held-out rows are transformed only, and none
    of them is removed.
    """
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = df.withColumn(HELD_OUT, held).drop(*ignore).where(F.col(target).isNotNull())
    rows = rows.withColumns({
        c: F.signum(F.col(c).cast("double")) * F.log1p(F.abs(F.col(c).cast("double"))) for c in numeric
    }).withColumn(LABEL, F.col(target).cast("double"))
    # every stage goes over the rows to be fitted
    rows = settle(rows.where(F.col(HELD_OUT) | _within(rows.where(~F.col(HELD_OUT)), numeric, 4.0)), "training")
    filled = [f"{c}_filled" for c in numeric]
    coded = [f"{c}_index" for c in categorical]
    hot = [f"{c}_hot" for c in categorical]
    stages = [Imputer(strategy="median", inputCols=list(numeric), outputCols=filled)]
    if categorical:
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=coded, handleInvalid="keep"),
            OneHotEncoder(inputCols=coded, outputCols=hot),
        ]
    stages += [
        VectorAssembler(inputCols=[*filled, *hot], outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_scaled" if keep_features else FEATURES,
                       withMean=True, withStd=True),
    ]
    if keep_features:
        select = UnivariateFeatureSelector(
            featuresCol="_scaled", labelCol=LABEL, outputCol=FEATURES, selectionMode="numTopFeatures"
        )
        select.setFeatureType("continuous").setLabelType("continuous")
        stages.append(select.setSelectionThreshold(keep_features))
    model = Pipeline(stages=stages).fit(rows.where(~F.col(HELD_OUT)))
    return model.transform(rows), model


def baselines(seed: int = 123) -> dict:
    return {
        "linear": LinearRegression(featuresCol=FEATURES, labelCol=LABEL),
        "tree": DecisionTreeRegressor(featuresCol=FEATURES, labelCol=LABEL, seed=seed),
        "forest": RandomForestRegressor(featuresCol=FEATURES, labelCol=LABEL, numTrees=20, seed=seed),
        "boosted": GBTRegressor(featuresCol=FEATURES, labelCol=LABEL, maxIter=10, seed=seed),
    }


def score(predicted: DataFrame) -> DataFrame:
    """rmse, mae and r2 of predictions, in one pass."""
    err = F.col(LABEL) - F.col(PREDICTION)
    return predicted.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.try_divide(F.avg(err * err), F.var_pop(LABEL))).alias("r2"),
    )


def compare(train: DataFrame, test: DataFrame, estimators: Mapping | None = None) -> DataFrame:
    """Hold-out scores of each estimator, best first."""
    fits = estimators or baselines()
    scored = [
        score(est.fit(train).transform(test)).withColumn("model", F.lit(name))
        for name, est in fits.items()
    ]
    return reduce(DataFrame.unionByName, scored).orderBy("rmse")


def tune(df: DataFrame, estimator, grid: Mapping[str, Sequence], folds: int = 3, seed: int = 123):
    """Grid search with cross-validation; gives the fitted search and its score table."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, numFolds=folds, seed=seed, parallelism=2,
        evaluator=RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION, metricName="rmse"),
    ).fit(df)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in m.items()), float(s))
        for m, s in zip(maps, search.avgMetrics)
    ]
    return search, df.sparkSession.createDataFrame(rows, "params string, rmse double")


def finalize(df: DataFrame, pipeline: Pipeline, path: str) -> PipelineModel:
    """Fit on all rows and save."""
    model = pipeline.fit(df)
    model.write().overwrite().save(path)
    return model


def bag(df: DataFrame, test: DataFrame, estimator, k: int = 5, key: str = "id") -> DataFrame:
    """Average prediction of ``k`` models fitted on bootstrap samples.

    A sample is a weight per row, drawn by a hash of the row's key and the model's number, so no sample is
    written and the models are the same in every run. Each model adds a prediction column to the rows, so nothing is joined.
    """
    out, names = test, []
    for i in range(k):
        name, weight = f"_p{i}", poisson_weight(key, F.lit(i)).cast("double")
        drawn = df.withColumn("_weight", weight).where("_weight > 0")
        fitted = estimator.copy({estimator.predictionCol: name, estimator.weightCol: "_weight"}).fit(drawn)
        out = fitted.transform(out)
        names.append(name)
    mean = reduce(lambda a, b: a + b, [F.col(n) for n in names]) / F.lit(k)
    return out.select(key, LABEL, mean.alias(PREDICTION))


def residuals(predicted: DataFrame, key: str = "id") -> DataFrame:
    return predicted.select(
        key, LABEL, PREDICTION, (F.col(PREDICTION) - F.col(LABEL)).alias("residual")
    )


def importances(model, df: DataFrame) -> DataFrame:
    """Feature importance by position in the feature vector."""
    rows = [(i, float(v)) for i, v in enumerate(model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature int, importance double")


def pca(df: DataFrame, k: int, key: str = "id") -> DataFrame:
    """Scores on the first ``k`` components."""
    scored = PCA(k=k, inputCol=FEATURES, outputCol="_pca").fit(df).transform(df)
    values = vector_to_array("_pca")
    return scored.select(key, *[F.get(values, F.lit(i)).alias(f"pc{i + 1}") for i in range(k)])


def kmeans(df: DataFrame, k: int, key: str = "id", seed: int = 123) -> DataFrame:
    fitted = KMeans(k=k, seed=seed, featuresCol=FEATURES, predictionCol="cluster").fit(df)
    return fitted.transform(df).select(key, "cluster")


def gmm(df: DataFrame, k: int, key: str = "id", seed: int = 123) -> DataFrame:
    fitted = GaussianMixture(k=k, seed=seed, featuresCol=FEATURES, predictionCol="component").fit(df)
    return fitted.transform(df).select(
        key, "component", F.array_max(vector_to_array("probability")).alias("probability")
    )
