"""Stored models, the version log over several trainings, scoring by stage, and permutation importance."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators import registry
from gridcast.operators.model_store import load_model, production_model
from gridcast.operators.naive import fit_naive
from gridcast.operators.permutation import number_by_digest, permutation_importance, permuted
from gridcast.operators.quality import Check
from gridcast.operators.structural import fit_structural
from gridcast.params import Axis, BoostParams, CleanParams, FeatureParams, SplitParams, TrainParams
from gridcast.plans.jobs import full, inference
from gridcast.sources.tables import TableLayout

from conftest import hourly

STAGES = registry.VERSION_LOG_SCHEMA


@pytest.fixture(scope="module")
def panel(spark):
    n = 24 * 30
    t = np.arange(n)
    parts = [pd.DataFrame({"series_id": s, "ts": hourly("2019-01-01", n), "y": 100.0 * k + 10 * np.cos(2 * np.pi * t / 24) + t % 5}) for k, s in enumerate("ab", 1)]
    return spark.createDataFrame(pd.concat(parts)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def scores(model, rows):
    return sorted((r["series_id"], str(r["ts"]), round(r["predicted"], 9)) for r in model.score(rows).collect())


def test_naive_model_repeats_the_last_season(panel, spark, tmp_path):
    train, later = panel.where("ts < timestamp_ntz '2019-01-20'"), panel.where("ts >= timestamp_ntz '2019-01-20'")
    model = fit_naive(train, Axis(), "y", 24)
    pdf = panel.toPandas().set_index(["series_id", "ts"])["y"]
    for r in model.score(later).collect():
        day = pd.Timestamp("2019-01-19") + pd.Timedelta(hours=pd.Timestamp(r["ts"]).hour)
        assert r["predicted"] == pdf[r["series_id"], day]
    model.save(str(tmp_path / "naive"))
    assert scores(load_model(spark, str(tmp_path / "naive")), later) == scores(model, later)
    other = later.withColumn("series_id", F.lit("unseen"))
    assert {r["predicted"] for r in model.score(other).collect()} == {None}


def test_naive_model_with_gaps_and_nulls(spark):
    rows = [("a", "2019-01-01 00:00:00", 1.0), ("a", "2019-01-01 01:00:00", None), ("a", "2019-01-01 03:00:00", 4.0)]
    df = spark.createDataFrame(rows, "series_id string, ts string, y double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    later = df.withColumn("ts", F.expr("ts + interval 4 hours"))
    got = {str(r["ts"])[11:13]: r["predicted"] for r in fit_naive(df, Axis(), "y", 4).score(later).collect()}
    assert got == {"04": 1.0, "05": None, "07": 4.0}


def test_structural_round_trip(panel, spark, tmp_path):
    train, later = panel.where("ts < timestamp_ntz '2019-01-20'"), panel.where("ts >= timestamp_ntz '2019-01-20'")
    model = fit_structural(train, Axis(), TrainParams(target="y", changepoints=3))
    model.save(str(tmp_path / "structural"))
    stored = load_model(spark, str(tmp_path / "structural"))
    assert scores(stored, later) == scores(model, later)
    assert (stored.start, stored.span, stored.changepoints, stored.multiplicative, stored.axis) == (model.start, model.span, 3, True, Axis())


def test_loading_the_wrong_kind_raises(panel, spark, tmp_path):
    fit_naive(panel, Axis(), "y", 24).save(str(tmp_path / "m"))
    from gridcast.operators.structural import StructuralModel

    with pytest.raises(ValueError, match="seasonal_naive"):
        StructuralModel.load(spark, str(tmp_path / "m"))


def training(spark, number, errors, log, require=False, before=None):
    """One training of two models with given errors; returns the grown log and all runs."""
    runs, paths = before, {}
    for name, error in errors.items():
        rows = registry.run_rows(spark, f"{name}{number}", name, name, {"val_mape": error, "val_rmse": error, "val_mae": error})
        runs = rows if runs is None else runs.unionByName(rows)
        paths[f"{name}{number}"] = f"/models/{name}/{number}"
    selection, changes = registry.record_training(runs, paths, log, require_improvement=require)
    return log.unionByName(changes), runs, selection


def stages(log):
    return {r["run_id"]: (r["version"], r["stage"]) for r in registry.current_versions(log).collect()}


def test_version_log(spark):
    log, runs, first = training(spark, 1, {"p": 3.0, "q": 2.0}, spark.createDataFrame([], STAGES))
    assert stages(log) == {"p1": (1, "None"), "q1": (2, "Production")} and [r["promoted"] for r in first.collect()] == [True, False]
    log, runs, _ = training(spark, 2, {"p": 1.0, "q": 4.0}, log, before=runs)
    assert stages(log) == {"p1": (1, "None"), "q1": (2, "Archived"), "p2": (3, "Production"), "q2": (4, "None")}
    assert registry.production_path(log) == "/models/p/2"
    assert log.count() == 5 and {r["change"] for r in log.collect()} == {1, 2}
    worse, runs_, selection = training(spark, 3, {"p": 5.0, "q": 6.0}, log, True, runs)  # no better than what is in production
    assert stages(worse)["p2"] == (3, "Production") and {r["run_id"] for r in selection.collect()} == {"p3", "q3"}
    assert not any(r["promoted"] for r in selection.collect())
    better, _, _ = training(spark, 3, {"p": 0.5, "q": 6.0}, log, True, runs)
    assert stages(better)["p2"] == (3, "Archived") and stages(better)["p3"] == (5, "Production")
    with pytest.raises(ValueError, match="in production"):
        registry.production_path(spark.createDataFrame([], STAGES))


def test_two_full_runs(spark, tmp_path, raw_readings):
    """Versions 1 to 6, one in production, the earlier winner archived; the stored winner scores, whichever kind it is."""
    raw = spark.createDataFrame(raw_readings.astype(str))
    layout = TableLayout(str(tmp_path / "tables"))
    checks = [Check("exists", "utc_timestamp"), Check("row_count", limit=1000)]
    features = FeatureParams(lags=(1, 24), windows=(6,), fourier_periods=(24,), fourier_order=1)
    train = TrainParams(folds=2, boost=BoostParams(trees=4, learning_rate=0.3, max_depth=3, min_leaf=5), changepoints=3, explain_rows=5)
    split = SplitParams("2019-02-10 23:00:00", "2019-02-18 23:00:00")
    first = full(raw, Axis(), layout, CleanParams(), features, split, train, checks=checks, forest_trees=3)
    won = registry.production_path(first.versions)
    # The second training has no useful trees, so another kind of model wins.
    weak = replace(train, boost=replace(train.boost, trees=1, max_depth=0))
    second = full(raw, Axis(), layout, CleanParams(), features, split, weak, checks=checks, forest_trees=3)
    now = registry.current_versions(second.versions).collect()
    assert sorted(r["version"] for r in now) == [1, 2, 3, 4, 5, 6]
    assert [r["stage"] for r in now].count("Production") == 1
    assert {r["path"]: r["stage"] for r in now}[won] == "Archived"
    assert layout.read(spark, "runs").where("parent_run_id IS NULL").select("run_id").distinct().count() == 6
    path = registry.production_path(second.versions)
    assert "boosted_trees" in won and "boosted_trees" not in path
    predictions = layout.read(spark, "predictions")
    labelled = layout.read(spark, "model_input")
    want = {r["ts"]: r["predicted"] for r in production_model(spark, second.versions).score(labelled.where("split = 'test'")).collect()}
    assert {r["ts"]: r["predicted"] for r in predictions.collect()} == want and len(want) > 0
    assert {"y_lower", "upper_bound", "lower_aci"} <= set(predictions.columns) and predictions.where("y_lower IS NOT NULL").count() == 0
    again = inference(load_model(spark, won), labelled, Axis(), layout)  # an archived version still scores
    assert again.where("lower_aci IS NULL").count() == 0


# ---- permutation importance -------------------------------------------------------------------------------------------


def rows_with_keys(spark, n=3000):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"k": np.arange(n), "a": rng.normal(size=n), "b": rng.integers(0, 9, n), "c": rng.normal(size=n)})
    pdf["y"] = 5 * pdf["a"] + pdf["b"] + 100
    return spark.createDataFrame(pdf), pdf


def test_numbers_are_dense(spark):
    df, _ = rows_with_keys(spark)
    got = number_by_digest(df, F.md5(F.col("k").cast("string")), ["k"]).select("k", "_at", F.md5(F.col("k").cast("string")).alias("d")).orderBy("d").collect()
    assert [r["_at"] for r in got] == list(range(3000))


def test_each_value_is_dealt_once(spark):
    df, pdf = rows_with_keys(spark)
    out = permuted(df, ["k"], ["a", "b"], repeats=2).toPandas()
    assert len(out) == 4 * len(pdf)
    for (feature, _), part in out.groupby(["_feature", "_repeat"]):
        part, other = part.sort_values("k"), {"a": "b", "b": "a"}[feature]
        assert sorted(part[feature]) == sorted(pdf[feature]) and (part[other].to_numpy() == pdf[other].to_numpy()).all()
        assert (part[feature].to_numpy() != pdf[feature].to_numpy()).mean() > 0.5
    again = permuted(df.repartition(7), ["k"], ["a", "b"], repeats=2).toPandas()
    key = ["_feature", "_repeat", "k"]
    assert out.sort_values(key, ignore_index=True).equals(again.sort_values(key, ignore_index=True)[out.columns])


def test_importance_of_a_linear_model(spark):
    df, pdf = rows_with_keys(spark)
    linear = lambda d: d.withColumn("predicted", 5 * F.col("a") + F.col("b") + 100)
    out = {r["feature"]: r for r in permutation_importance(df, ["k"], ["a", "b", "c"], linear, "y", repeats=3).collect()}
    assert out["c"]["mae_growth"] == 0 and out["c"]["rmse_growth"] == 0
    for f, weight in (("a", 5), ("b", 1)):  # the expected squared error of a random deal is twice the variance
        assert out[f]["rmse_growth"] == pytest.approx(weight * np.sqrt(2) * pdf[f].std(), rel=0.06)
    assert [r["feature"] for r in permutation_importance(df, ["k"], ["c", "b", "a"], linear, "y").collect()] == ["a", "b", "c"]


def test_importance_of_boosted_trees(spark):
    from gridcast.operators.boosted import fit_point, predict_point

    df, _ = rows_with_keys(spark)
    model = fit_point(df, ["a", "b", "c"], "y", BoostParams(trees=10, learning_rate=0.3, max_depth=4, min_leaf=5))
    out = permutation_importance(df, ["k"], ["a", "b", "c"], lambda d: predict_point(model, d, ["a", "b", "c"]), "y").collect()
    assert [r["feature"] for r in out] == ["a", "b", "c"] and out[0]["mae_growth"] > out[1]["mae_growth"] > 10 * abs(out[2]["mae_growth"])
