"""Random-forest regression: grid search, held-out evaluation, importances, saved models."""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windward.operators.features import SEED, assemble
from windward.session import delete_staged

MAX_BINS = 256

# The parameter grids searched.
GRID_V1 = {
    "n_estimators": [100, 200, 300],
    "max_depth": [10, 20, 30],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
}
GRID_V2 = {
    "n_estimators": [100, 200],
    "max_depth": [10, 20, 30],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4, 8],
    "max_features": ["sqrt", "log2", 1.0],
    "bootstrap": [True, False],
}


def forest_params(point: dict) -> dict:
    """A grid point in the names of Spark's forest.

    Spark has no minimum size for splitting a node. Half of it, as a minimum
    for each child, is the stand-in: stricter, never looser.
    """
    leaf = point.get("min_samples_leaf", 1)
    split = point.get("min_samples_split", 2)
    return {
        "numTrees": point.get("n_estimators", 100),
        "maxDepth": point.get("max_depth", 20),
        "minInstancesPerNode": max(leaf, math.ceil(split / 2)),
        "featureSubsetStrategy": str(point.get("max_features", 1.0)),
        "bootstrap": point.get("bootstrap", True),
    }


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def _forest(params: dict, seed: int = SEED) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol="label", seed=seed, maxBins=MAX_BINS,
        cacheNodeIds=True, checkpointInterval=10, **params,
    )


def forest(point: dict, seed: int = SEED) -> RandomForestRegressor:
    return _forest(forest_params(point), seed)


def fit_forest(train: DataFrame, features: list[str], target: str, point: dict) -> RandomForestRegressionModel:
    return forest(point).fit(assemble(train, features, target))


@dataclass
class GridResult:
    model: RandomForestRegressionModel
    best: dict
    best_score: float
    scores: list[tuple[dict, float]]
    seconds: float


def _distinct_fits(points: list[dict]) -> tuple[list[tuple], list[int]]:
    """The fits that a list of points needs, and which fit each point has; points that mean the same to Spark share one."""
    fits: dict[tuple, int] = {}
    fit_of = [fits.setdefault(tuple(sorted(forest_params(p).items())), len(fits)) for p in points]
    return list(fits), fit_of


LEDGER = "fit string, fold int, score double, seconds double"


def fitted_folds(spark: SparkSession, ledger: str) -> dict[tuple[str, int], float]:
    """(fit, fold) -> score of what a search has written so far; a search has few rows, one per fit and fold."""
    if not exists(spark, ledger):
        return {}
    return {(r.fit, r.fold): r.score for r in spark.read.schema(LEDGER).parquet(f"{ledger}/*").collect()}


def grid_search(
    train: DataFrame, features: list[str], target: str, grid: dict[str, list],
    fold: str = "fold", folds: int = 3, parallelism: int = 4, ledger: str | None = None, resume: bool = False,
) -> GridResult:
    """Every grid point on every fold, scored by R2; the best is fitted on all of ``train``.

    Points that mean the same to Spark share their fits; each has its score. Folds come from a hash column, so no random
    state is carried. Fits run as concurrent Spark jobs over one cached matrix. Each fold's score is written
    to the folder ``ledger`` as soon as it is known; a search that resumes fits only what the ledger lacks.
    """
    spark = train.sparkSession
    points = grid_points(grid)
    fits, fit_of = _distinct_fits(points)
    started = time.time()
    done: dict[tuple[str, int], float] = {}
    if ledger and resume:
        done = fitted_folds(spark, ledger)
    elif ledger:
        delete_staged(spark, [(ledger, None)])
    data = assemble(train, features, target).select("features", "label", fold).persist()
    judge = RegressionEvaluator(metricName="r2")

    def one(job: tuple[int, int]) -> None:
        fit, part = job
        begun = time.time()
        model = _forest(dict(fits[fit])).fit(data.where(F.col(fold) != part))
        score = float(judge.evaluate(model.transform(data.where(F.col(fold) == part))))
        done[repr(fits[fit]), part] = score
        if ledger:
            row = spark.createDataFrame([(repr(fits[fit]), part, score, time.time() - begun)], LEDGER)
            row.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/fit-{fit}-fold-{part}")

    try:
        left = [(i, part) for i in range(len(fits)) for part in range(folds) if (repr(fits[i]), part) not in done]
        with ThreadPoolExecutor(parallelism) as pool:
            list(pool.map(inheritable_thread_target(spark)(one), left))  # raises what a fit has raised
        mean = [sum(done[repr(f), part] for part in range(folds)) / folds for f in fits]
        scored = [(p, mean[i]) for p, i in zip(points, fit_of)]
        best, score = max(scored, key=lambda s: s[1])
        model = forest(best).fit(data)
    finally:
        data.unpersist()
    return GridResult(model, best, score, scored, time.time() - started)


def predict(model: RandomForestRegressionModel, data: DataFrame, features: list[str], target: str) -> DataFrame:
    return model.transform(assemble(data, features, target)).drop("features")


def regression_metrics(pred: DataFrame, label: str | Column = "label", prediction: str | Column = "prediction") -> DataFrame:
    """MAE, MSE, RMSE and R2 in one aggregate; R2 is null for a constant target."""
    y = F.col(label) if isinstance(label, str) else label
    e = y - (F.col(prediction) if isinstance(prediction, str) else prediction)
    mse = F.avg(e * e)
    return pred.agg(
        F.count("*").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (1 - mse / F.nullif(F.var_pop(y), F.lit(0.0))).alias("r2"),
    )


def importances(spark: SparkSession, model: RandomForestRegressionModel, features: list[str]) -> DataFrame:
    """One row per feature, the most important first."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    schema = T.StructType([
        T.StructField("variable", T.StringType()), T.StructField("importance", T.DoubleType())
    ])
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), "variable")


def run_tables(
    spark: SparkSession, found: GridResult | None, metrics: DataFrame, ranked: DataFrame, data: DataFrame
) -> dict[str, DataFrame]:
    """The tables of one run: matrix, importances and test metrics, and of a search the best point
    with its score and training time, and all scores."""
    tables = {"data": data, "importances": ranked, "metrics": metrics}
    if found is not None:
        best = [("best_params", repr(found.best)), ("best_r2", repr(found.best_score)), ("seconds", repr(found.seconds))]
        scores = [(repr(point), score) for point, score in found.scores]
        tables["best"] = spark.createDataFrame(best, "name string, value string")
        tables["scores"] = spark.createDataFrame(scores, "params string, cv_r2 double")
    return tables


def data_version(data: DataFrame) -> str:
    """A short text that changes with the rows, whatever their order."""
    total = data.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*data.columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{total.n}-{total.h}"


def model_path(root: str, features: list[str], target: str, grid: dict, version: str = "") -> str:
    """A folder name that changes with the feature list, the target, the grid and the data."""
    said = repr((features, target, sorted(grid.items()), version))
    return os.path.join(root, "forest-" + hashlib.sha256(said.encode()).hexdigest()[:16])


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def load_or_fit(spark: SparkSession, path: str, fit, resume: bool = False) -> tuple[RandomForestRegressionModel, GridResult | None]:
    """A newly searched and saved model, or, to resume, the one at ``path`` if there is one."""
    if resume and exists(spark, path):
        return RandomForestRegressionModel.load(path), None
    found = fit()
    found.model.write().overwrite().save(path)
    return found.model, found


def save_pipeline(fitted: RandomForestRegressionModel, stages: list[Transformer], path: str) -> PipelineModel:
    """Encoders, assembler and forest as one saved model, which takes the rows as they are."""
    whole = PipelineModel([*stages, fitted])
    whole.write().overwrite().save(path)
    return whole
