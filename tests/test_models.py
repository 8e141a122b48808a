"""Feature matrix, split, forest, grid, metrics, saved models."""

import os
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from windward.operators import features, model
from windward.plans import train


def processed(spark, n=400):
    """Ranks follow wind and entry rank, with a little noise."""
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        wind, entry = rnd.uniform(6, 20), rnd.randint(1, 30)
        rows.append((
            i, f"{wind:.2f}".replace(".", ","), 20.0, 1010, 50, 0.0, entry, rnd.choice(["Men", "Women", None]),
            rnd.choice(["U17", "U19", "Senior"]), rnd.choice(["Reaching", "Vent debout"]), rnd.choice([0.0, 90.0, 180.0, 360.0]),
            int(2 * wind + entry + rnd.random()),
        ))
    return spark.createDataFrame(rows, (
        "rid int, wind_speed_kn string, temperature_c double, pressure_hpa int, humidity_pct int, rain_mm double, "
        "rank_entry int, sex string, age_class string, point_of_sail string, wind_dir_site double, rank_segment int"
    ))


def test_matrix_drops_before_or_after_encoding(spark):
    df = processed(spark)
    young = df.where("age_class <> 'Senior'")
    v2 = features.model_matrix(df, "rank_v2", keep=["rid"])
    assert v2.count() == young.where("sex is not null").count()
    assert "pressure_hpa" not in v2.columns and "wind_dir_site" not in v2.columns and "age_class_Senior" not in v2.columns
    after = features.Preset("rank_segment", ["wind_speed_kn", "rank_entry"], ["sex", "age_class"], drop_before_encode=False)
    v1 = features.model_matrix(df, after, keep=["rid"])
    assert v1.count() == young.count()
    assert v1.where("sex_Men + sex_Women = 0").count() == young.where("sex is null").count()
    assert dict(v1.dtypes)["sex_Men"] == "int" and dict(v1.dtypes)["wind_speed_kn"] == "double"


def test_presets_name_their_columns():
    assert len(features.PRESETS["rank_v1"].columns) == 16 and len(features.PRESETS["rank_v2"].columns) == 11
    assert len(features.PRESETS["readme_vmc"].columns) == 9


def test_category_table_holds_all_values(spark):
    df = spark.range(3000).selectExpr("id a", "nullif(id % 3, 0) b")
    got = features.category_table(df, ["a", "b"]).groupBy("column").count().collect()
    assert {r["column"]: r["count"] for r in got} == {"a": 3000, "b": 2}


def test_split_is_the_same_in_any_order(spark):
    df = spark.range(2000)
    one = features.with_split(df, F.col("id"))
    two = features.with_split(df.repartition(7).orderBy(F.desc("id")), F.col("id"))
    assert one.exceptAll(two).isEmpty()
    share = one.where("is_train").count() / 2000
    assert 0.76 < share < 0.84
    folds = features.with_fold(df, F.col("id")).groupBy("fold").count().collect()
    assert sorted(r[0] for r in folds) == [0, 1, 2] and min(r[1] for r in folds) > 550


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "label double, prediction double")
    m = model.regression_metrics(df).first()
    assert m["mae"] == pytest.approx(0.5) and m["mse"] == pytest.approx(1.25 / 3) and m["rmse"] == pytest.approx((1.25 / 3) ** 0.5)
    mean = 7 / 3
    assert m["r2"] == pytest.approx(1 - 1.25 / sum((y - mean) ** 2 for y in (1, 2, 4)))
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    assert model.regression_metrics(flat).first()["r2"] is None


def test_grid_points():
    assert len(model.grid_points({"min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2]})) == 6
    assert model.forest_params({"min_samples_split": 10, "min_samples_leaf": 2})["minInstancesPerNode"] == 5
    full = 1
    for values in model.GRID_V2.values():
        full *= len(values)
    assert full == 432 == len(model.grid_points(model.GRID_V2)) and len(model.grid_points(model.GRID_V1)) == 81


def test_forest_learns_and_is_reloaded(spark, tmp_path):
    data = features.with_fold(features.with_split(
        features.model_matrix(processed(spark), "rank_v2", keep=["rid"]), F.col("rid")), F.col("rid"))
    names = [n for n in features.feature_names(data, "rank_segment", ["rid"]) if n not in ("is_train", "fold")]
    grid = {"n_estimators": [10], "max_depth": [2, 6], "min_samples_split": [2, 4], "min_samples_leaf": [2]}
    train, test = data.where("is_train"), data.where("not is_train")
    path = model.model_path(str(tmp_path), names, "rank_segment", grid)
    assert path != model.model_path(str(tmp_path), names[1:], "rank_segment", grid)
    fit = lambda: model.grid_search(train, names, "rank_segment", grid, parallelism=2)
    fitted, found = model.load_or_fit(spark, path, fit)
    assert found.best["max_depth"] == 6 and len(found.scores) == 4 and found.seconds > 0
    assert found.scores[0][1] == found.scores[1][1]  # points that mean the same share a fit and both have a score
    again, none = model.load_or_fit(spark, path, fit, resume=True)
    assert none is None and again.getNumTrees == fitted.getNumTrees
    m = model.regression_metrics(model.predict(again, test, names, "rank_segment")).first()
    assert m["r2"] > 0.6
    top = model.importances(spark, again, names).collect()
    assert {top[0][0], top[1][0]} == {"wind_speed_kn", "rank_entry"}
    assert sum(r[1] for r in top) == pytest.approx(1.0)
    assert [r[1] for r in top] == sorted((r[1] for r in top), reverse=True)


def test_training_writes_its_tables(spark, tmp_path):
    grid = {"n_estimators": [4], "max_depth": [3]}
    run = lambda ts="2024-01-01_00-00-00", rows=None, resume=False: train.train(
        processed(spark) if rows is None else rows, ["rid"], F.col("rid"), grid, str(tmp_path), run_ts=ts, resume=resume
    )
    fitted, metrics = run()
    assert metrics.first()["n"] > 0
    read = lambda name: spark.read.parquet(str(tmp_path / "runs" / name))
    best = dict(read("best").select("name", "value").collect())
    assert eval(best["best_params"]) == {"n_estimators": 4, "max_depth": 3} and float(best["seconds"]) > 0
    assert read("metrics").count() == 1 and read("importances").count() == len(fitted.featureImportances.toArray())
    assert read("data").count() > 100
    run("resumed", resume=True)
    assert read("best").count() == 3 and read("metrics").count() == 2  # a loaded model has metrics, and no search
    run("other", processed(spark).where("rid % 5 > 0"), resume=True)
    assert read("best").count() == 6  # other data, another model
    run("again")
    assert read("best").count() == 9


def test_a_search_broken_off_fits_only_the_rest(spark, tmp_path, monkeypatch):
    data = features.with_fold(features.model_matrix(processed(spark), "rank_v2", keep=["rid"]), F.col("rid"))
    names = [n for n in features.feature_names(data, "rank_segment", ["rid"]) if n != "fold"]
    grid = {"n_estimators": [3], "max_depth": [2, 3, 4], "min_samples_leaf": [2]}
    ledger, fitted = str(tmp_path / "scores"), []

    class Counting:
        def __init__(self, inner, stop_after):
            self.inner, self.stop_after = inner, stop_after

        def fit(self, rows):
            if len(fitted) >= self.stop_after:
                raise RuntimeError("killed")
            fitted.append(1)
            return self.inner.fit(rows)

    real = model._forest
    search = lambda resume: model.grid_search(data, names, "rank_segment", grid, parallelism=1, ledger=ledger, resume=resume)
    monkeypatch.setattr(model, "_forest", lambda *a, **k: Counting(real(*a, **k), 4))
    with pytest.raises(RuntimeError, match="killed"):
        search(False)
    assert len(model.fitted_folds(spark, ledger)) == 4
    fitted.clear()
    monkeypatch.setattr(model, "_forest", lambda *a, **k: Counting(real(*a, **k), 100))
    found = search(True)
    assert len(fitted) == 3 * 3 - 4 + 1 and len(found.scores) == 3  # the folds left, and the best on all rows
    fitted.clear()
    again = search(True)
    assert len(fitted) == 1 and again.scores == found.scores
    fitted.clear()
    assert len(search(False).scores) == 3 and len(fitted) == 10  # without resume from the start


def test_the_saved_pipeline_takes_processed_rows(spark, tmp_path):
    rows = processed(spark)
    fitted, _ = train.train(rows, ["rid"], F.col("rid"), {"n_estimators": [4], "max_depth": [3]}, str(tmp_path), run_ts="x")
    saved = [p for p in os.listdir(tmp_path) if p.endswith("-pipeline")]
    whole = PipelineModel.load(str(tmp_path / saved[0]))
    matrix = features.model_matrix(rows, "rank_v2", keep=["rid"])
    names = features.feature_names(matrix, "rank_segment", ["rid"])
    want = dict(model.predict(fitted, matrix, names, "rank_segment").select("rid", "prediction").collect())
    got = dict(whole.transform(rows.where("age_class in ('U17', 'U19')").na.drop(subset=["sex", "point_of_sail", "rank_segment"])).select("rid", "prediction").collect())
    assert want and got == want
