"""From the processed layer to a saved model and its result tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame

from windward.operators import features, model
from windward.session import stage
from windward.sources.tables import write_run

RUN_STAMP = "%Y-%m-%d_%H-%M-%S"  # fixed value: how a run is named


def train(
    processed: DataFrame,
    key: list[str],
    by: Column,
    grid: dict[str, list],
    root: str,
    preset: str = features.DEFAULT_PRESET,
    parallelism: int = 4,
    run_ts: str | None = None,
    values: dict[str, list] | None = None,
    resume: bool = False,
) -> tuple[RandomForestRegressionModel, DataFrame]:
    """Search, save and evaluate a forest; returns it with its held-out metrics.

    ``by`` is the row key that decides split and fold; rows that must not be
    torn apart, such as one race's, share it. The matrix is written once and
    every fit reads that table. With ``resume`` a model saved for the same data,
    features, target and grid is loaded instead, and a search of these that was broken off fits only what it
    had not scored yet. Run tables are written either way, and beside the forest the whole model, encoding included
    (``-pipeline``), which takes processed rows as they are.
    """
    spark = processed.sparkSession
    target = features.PRESETS[preset].target
    matrix = features.model_matrix(processed, preset, values, keep=key)
    names = features.feature_names(matrix, target, key)
    data = stage(features.with_fold(features.with_split(matrix, by), by), "matrix")
    train_rows, test_rows = data.where("is_train"), data.where("not is_train")
    path = model.model_path(root, names, target, grid, model.data_version(train_rows))
    fitted, found = model.load_or_fit(
        spark, path,
        lambda: model.grid_search(train_rows, names, target, grid, parallelism=parallelism, ledger=f"{path}-scores", resume=resume), resume,
    )
    if found is not None:
        model.save_pipeline(fitted, features.encoder_stages(preset, names, values), f"{path}-pipeline")
    metrics = model.regression_metrics(model.predict(fitted, test_rows, names, target))
    tables = model.run_tables(spark, found, metrics, model.importances(spark, fitted, names), data)
    write_run(tables, f"{root}/runs", run_ts or datetime.now().strftime(RUN_STAMP))
    return fitted, metrics
