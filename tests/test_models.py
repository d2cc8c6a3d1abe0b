"""Trained forecasters, attributions, streaming jobs and the whole job chain."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators.boosted import (
    ForecastBundle, assemble, cross_validate, fit_bundle, fit_point, importance, predict_point,
)
from gridcast.operators.conformal import adaptive_conformal
from gridcast.operators.explain import attributions, mean_attribution, row_attribution, stable_sample
from gridcast.operators.features import build_feature_matrix, feature_names
from gridcast.operators.metrics import forecast_metrics, interval_metrics
from gridcast.operators.naive import seasonal_naive
from gridcast.operators.quality import Check
from gridcast.operators.requests import forecast_requests, request_features, score_requests
from gridcast.operators.split import assign_split, split_part
from gridcast.operators.structural import fit_structural
from gridcast.params import (
    AdaptiveParams, Axis, BoostParams, CleanParams, DriftParams, DriftWindow, FeatureParams, SplitParams, TrainParams,
)
from gridcast.plans.jobs import JOBS, full
from gridcast.sources.tables import TableLayout, cut
from gridcast.streaming.jobs import (
    adaptive_conformal_stream, error_monitor_stream, hourly_series_stream, latest_table_stream, quality_gate_stream,
    read_latest_table,
)

from conftest import hourly

FEATURES = FeatureParams(target="y", lags=(1, 24), windows=(6,), fourier_periods=(24,), fourier_order=1)
NAMES = feature_names(FEATURES)
BOOST = BoostParams(trees=10, learning_rate=0.3, max_depth=4, min_leaf=5)
TRAIN = TrainParams(target="y", folds=2, boost=BOOST)
SPLIT = SplitParams("2019-02-10 23:00:00", "2019-02-18 23:00:00")


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(1)
    n, parts = 24 * 56, []
    for k, s in enumerate("ab"):
        t = np.arange(n)
        y = 100 * (k + 1) + 20 * np.cos(2 * np.pi * t / 24) + 8 * np.cos(2 * np.pi * t / 168) + rng.normal(0, 4, n)
        parts.append(pd.DataFrame({"series_id": s, "ts": hourly("2019-01-01", n), "y": y}))
    df = spark.createDataFrame(pd.concat(parts)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return cut(df)


@pytest.fixture(scope="module")
def labelled(panel):
    return cut(assign_split(build_feature_matrix(panel, Axis(), FEATURES), "ts", SPLIT))


@pytest.fixture(scope="module")
def bundle(labelled):
    return fit_bundle(labelled, NAMES, TRAIN, forest_trees=6)


def test_boosted_beats_seasonal_naive(panel, labelled, bundle):
    val = labelled.where("split = 'val'")
    mine = forecast_metrics(bundle.score(val), [], "y", "predicted").first()["mape"]
    naive = assign_split(seasonal_naive(panel, Axis(), "y", 168), "ts", SPLIT).where("split = 'val'")
    assert mine < forecast_metrics(naive, [], "y", "predicted").first()["mape"]


def test_intervals(labelled, bundle):
    val = bundle.score(labelled.where("split = 'val'"))
    assert interval_metrics(val, [], "y", "lower_bound", "upper_bound").first()["coverage"] >= 0.8
    assert val.where("y_lower > y_upper").count() == 0


def test_leaf_quantiles_match_pandas(labelled, bundle):
    """Bounds equal the mean over trees of the training quantiles of the row's leaf."""
    from pyspark.ml.functions import vector_to_array

    from gridcast.operators.boosted import assemble

    placed = bundle.heads.forest.transform(assemble(labelled, NAMES)).withColumn("leaf", vector_to_array("_leaf"))
    pdf = placed.select("series_id", "ts", "split", "y", "leaf").toPandas()
    leaves = np.stack(pdf["leaf"])
    train = (pdf["split"] == "train").to_numpy()
    lower = np.zeros(len(pdf))
    for tree in range(leaves.shape[1]):
        table = pdf[train].groupby(leaves[train, tree])["y"].quantile(0.1)
        lower += table.reindex(leaves[:, tree]).to_numpy()
    pdf["expected"] = lower / leaves.shape[1]
    got = bundle.score(labelled).select("series_id", "ts", "y_lower").toPandas()
    both = pdf.merge(got, on=["series_id", "ts"])
    np.testing.assert_allclose(both["y_lower"], both["expected"])


def test_bundle_round_trip(spark, tmp_path, labelled, bundle):
    bundle.save(str(tmp_path / "m"))
    loaded = ForecastBundle.load(spark, str(tmp_path / "m"))
    a, b = (m.score(labelled).agg(F.sum("predicted"), F.sum("lower_bound")).first() for m in (bundle, loaded))
    assert a[0] == pytest.approx(b[0]) and a[1] == pytest.approx(b[1]) and loaded.features == tuple(NAMES)
    with pytest.raises(ValueError, match="missing"):
        loaded.score(labelled.drop("lag_1h"))
    point_only = ForecastBundle(bundle.point, None, tuple(NAMES)).score(labelled)
    assert "predicted" in point_only.columns and "lower_bound" not in point_only.columns


def test_leaf_bounds_are_not_copied_with_each_row(labelled, bundle):
    """The bounds are a constant: as a column, trees x 2^depth entries came with every scored row."""
    scored = bundle.score(labelled)
    assert "Join" not in scored._jdf.queryExecution().optimizedPlan().toString()
    table = bundle.heads.leaves.first()["_table"]
    row = bundle.heads.forest.transform(assemble(labelled, NAMES)).select("series_id", "ts", "_leaf").first()
    hits = [{e["key"]: e["value"] for e in tree}[node] for tree, node in zip(table, row["_leaf"], strict=True)]
    got = scored.where((F.col("series_id") == row["series_id"]) & (F.col("ts") == F.lit(row["ts"]))).first()
    assert got["y_lower"] == pytest.approx(np.mean([h["lo"] for h in hits]))
    assert got["y_upper"] == pytest.approx(np.mean([h["hi"] for h in hits]))


def test_cross_validation(labelled):
    out = cross_validate(split_part(labelled, "train"), Axis(), NAMES, TRAIN).toPandas()
    assert sorted(out["fold"]) == [1, 2] and (out["fold_mape"] > 0).all()


def test_attributions_add_up(spark, labelled, bundle):
    sample = stable_sample(labelled.where("split = 'val'"), ["series_id", "ts"], 40)
    again = stable_sample(labelled.where("split = 'val'").repartition(9), ["series_id", "ts"], 40)
    assert sample.exceptAll(again).count() == 0
    values = attributions(bundle.point, sample, NAMES, ["series_id", "ts"])
    predicted = predict_point(bundle.point, sample, NAMES).select("series_id", "ts", "predicted")
    pdf = values.join(predicted, ["series_id", "ts"]).toPandas()
    np.testing.assert_allclose(pdf[NAMES].sum(axis=1) + pdf["base"], pdf["predicted"])
    top = mean_attribution(values, NAMES, 3).collect()
    assert len(top) == 3 and top[0]["mean_abs"] >= top[1]["mean_abs"]
    assert row_attribution(values, ["series_id", "ts"], NAMES, 2).count() == 80
    assert importance(bundle.point, NAMES, spark).count() == len(NAMES)


def test_attributions_against_all_coalitions(spark):
    """Brute force over coalitions of three features on a small model."""
    from itertools import combinations
    from math import factorial

    from gridcast.operators.explain import _leaf_paths

    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(0, 1, (200, 3)), columns=list("abc")).assign(i=range(200))
    pdf["y"] = pdf["a"] * pdf["b"] + (pdf["c"] > 0)
    df = spark.createDataFrame(pdf)
    model = fit_point(df, ["a", "b", "c"], "y", BoostParams(trees=3, max_depth=3, min_leaf=2, column_share=1.0))
    leaves = _leaf_paths(model, df)
    got = attributions(model, df, ["a", "b", "c"], ["i"]).toPandas().set_index("i")

    def payoff(row, seen):
        total = 0.0
        for value, conditions in leaves:
            for f, lo, hi, share in conditions:
                value *= float(lo < row[f] <= hi) if f in seen else share
            total += value
        return total

    for i in range(10):
        row = pdf.loc[i, ["a", "b", "c"]].to_numpy(dtype=float)
        for f, name in enumerate("abc"):
            rest = [g for g in range(3) if g != f]
            phi = sum(
                factorial(k) * factorial(2 - k) / 6 * (payoff(row, {*s, f}) - payoff(row, set(s)))
                for k in range(3) for s in combinations(rest, k)
            )
            assert got.loc[i, name] == pytest.approx(phi, abs=1e-9)


@pytest.mark.parametrize("multiplicative", [True, False])
def test_structural(panel, multiplicative):
    rows = assign_split(panel, "ts", SPLIT)
    model = fit_structural(split_part(rows, "train"), Axis(), TrainParams(target="y", changepoints=3, multiplicative=multiplicative))
    out = model.predict(split_part(rows, "val"))
    assert out.columns == ["series_id", "ts", "y", "predicted"]
    assert forecast_metrics(out, [], "y", "predicted").first()["mape"] < 12


def test_score_requests(spark, bundle):
    rows = [("r1", "a", "2019-02-20 00:00", 24, None, None), ("r2", "b", "2019-02-21 00:00", 3, None, None)]
    schema = "request_id string, series_id string, start_ts string, horizon int, wind array<double>, solar array<double>"
    asked = spark.createDataFrame(rows, schema).withColumn("start_ts", F.col("start_ts").cast("timestamp_ntz"))
    features = request_features(asked, Axis(), FEATURES)
    flat = score_requests(bundle, features)
    assert flat.count() == 27 and flat.where("predicted is null or lower_bound > upper_bound").count() == 0
    gap = features.withColumn("lag_1h", F.when(F.col("request_id") == "r1", F.col("lag_1h")))  # r2: no history
    found = score_requests(bundle, gap).groupBy("request_id").agg(F.count("predicted"), F.count("lower_bound")).collect()
    assert {tuple(r) for r in found} == {("r1", 24, 24), ("r2", 0, 0)}
    assert score_requests(bundle, gap, missing="zero").where("predicted is null").isEmpty()
    nested = {r["request_id"]: r["forecast"] for r in score_requests(bundle, features, nested=True).collect()}
    assert len(nested["r1"]) == 24 and [p["ts"] for p in nested["r2"]] == sorted(p["ts"] for p in nested["r2"])


class Counted:
    """A bundle that notes how many rows it was given."""

    def __init__(self, bundle, features=()):
        self.bundle, self.features, self.rows = bundle, (*bundle.features, *features), []

    def score(self, df):
        self.rows.append(df.count())
        return self.bundle.score(df)


def test_requests_that_share_series_and_start_are_forecast_once(spark, bundle, panel):
    from gridcast.operators.features import history_features

    noon = "2019-02-20 12:00"
    rows = [(1, "a", noon, 24, None), (2, "a", noon, 3, None), (2, "a", noon, 3, [1.0, 2.0, 3.0]), (None, "b", noon, 5, None),
            (None, "b", noon, 5, [3.0] * 5), (4, "b", "2019-02-20 13:00", 5, []), (5, None, noon, 2, None), (6, None, noon, 4, None)]
    schema = "request_id int, series_id string, start_ts string, horizon int, wind array<double>"
    asked = spark.createDataFrame(rows, schema).withColumn("start_ts", F.col("start_ts").cast("timestamp_ntz"))
    asked = asked.withColumn("solar", F.lit(None).cast("array<double>"))
    history = history_features(panel, Axis(), "y", FEATURES.lags, FEATURES.windows).drop("y")
    anchors = panel.groupBy("series_id").agg((F.unix_seconds(F.min("ts").cast("timestamp")) / 3600).cast("bigint").alias("start_idx"))
    in_order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    want = in_order(score_requests(bundle, request_features(asked, Axis(), FEATURES, history, anchors)))
    assert len(want) == 51 and any(r[2] is not None for r in want)
    for limit in (1, 50_000):
        counted = Counted(bundle)
        assert in_order(forecast_requests(counted, asked, Axis(), FEATURES, history, anchors, rows_per_task=limit)) == want
        assert counted.rows == [24 + 5 + 5 + 4]
    windy = Counted(bundle, ["wind_mw"])  # a model that reads the wind forecasts each wind by itself
    assert in_order(forecast_requests(windy, asked, Axis(), FEATURES, history, anchors)) == want
    assert windy.rows == [24 + 3 + 5 + 5 + 5 + 4]


# ---- streaming ------------------------------------------------------------------------------------------------------


def stream_of(spark, tmp_path, name, batches):
    """File stream that delivers the given frames one per micro-batch."""
    folder = tmp_path / name
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(str(folder))
        written = sorted(folder.glob("part-*"), key=lambda p: p.stat().st_mtime_ns)
        assert len(written) == i + 1
    return spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drain(df, spark, tmp_path, name, mode="append"):
    out = str(tmp_path / f"{name}-out")
    query = df.writeStream.outputMode(mode).format("parquet").option("path", out)
    query.option("checkpointLocation", str(tmp_path / f"{name}-ckpt")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def test_adaptive_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(3)
    n = 120
    pdf = pd.concat(
        pd.DataFrame({"series_id": s, "ts": hourly("2020-01-01", n), "y": rng.normal(0, 10, n), "y_lower": -4.0, "y_upper": 4.0})
        for s in "ab"
    )
    df = spark.createDataFrame(pdf)
    edges = pd.date_range("2020-01-01", periods=4, freq="40h")
    batches = [df.where((F.col("ts") >= F.lit(a)) & (F.col("ts") < F.lit(b))) for a, b in zip(edges, [*edges[1:], edges[-1] + pd.Timedelta("40h")])]
    late = df.where(F.col("ts") == F.lit(pd.Timestamp("2020-01-01 05:00")))
    stream = stream_of(spark, tmp_path, "scored", [*batches[:3], late])
    params = AdaptiveParams(0.8, 0.05)
    out = drain(adaptive_conformal_stream(stream, ["series_id"], "ts", params, initial_q=1.0), spark, tmp_path, "aci").toPandas()
    batch = adaptive_conformal(df.withColumn("q0", F.lit(1.0)), ["series_id"], "ts", params, initial_q="q0").toPandas()
    on_time = out[~out["late"]].merge(batch, on=["series_id", "ts"], suffixes=("", "_b"))
    assert len(on_time) == 2 * n and (on_time["q"] == on_time["q_b"]).all() and (on_time["hit"] == on_time["hit_b"]).all()
    assert out["late"].sum() == 2 and out[out["late"]]["q"].isnull().all()


def test_hourly_stream_drops_duplicates_and_late_rows(spark, tmp_path):
    def batch(rows):
        return spark.createDataFrame(rows, "event_id long, ts string, k string, v double").withColumn("ts", F.to_timestamp("ts"))

    stream = stream_of(
        spark, tmp_path, "events",
        [
            batch([(1, "2020-01-01 00:10", "a", 1.0), (2, "2020-01-01 00:50", "a", 2.0), (2, "2020-01-01 00:50", "a", 2.0)]),
            batch([(3, "2020-01-01 08:00", "a", 5.0)]),
            batch([(6, "2020-01-01 08:30", "a", 1.0)]),  # rows are judged by the watermark of the batch before
            batch([(4, "2020-01-01 00:30", "a", 100.0), (5, "2020-01-01 12:00", "a", 7.0)]),
        ],
    )
    out = drain(hourly_series_stream(stream, "ts", "k", "v", "event_id"), spark, tmp_path, "hours").toPandas()
    assert {str(r.ts): (r.y, r.n_events) for r in out.itertuples()} == {
        "2020-01-01 00:00:00": (3.0, 2), "2020-01-01 08:00:00": (6.0, 2),
    }


def test_latest_stream_is_idempotent(spark, tmp_path):
    def batch(rows):
        return spark.createDataFrame(rows, "k string, ts string, v double").withColumn("ts", F.to_timestamp("ts"))

    batches = [batch([("a", "2020-01-02", 2.0), ("b", "2020-01-01", 1.0)]), batch([("a", "2020-01-01", 0.0), ("b", "2020-01-05", 5.0)])]
    for attempt in range(2):  # the second attempt replays both batches into the same table
        stream = stream_of(spark, tmp_path, f"latest{attempt}", batches)
        latest_table_stream(stream, str(tmp_path / "table"), str(tmp_path / f"ck{attempt}"), ["k"], "ts").awaitTermination()
        assert {r["k"]: r["v"] for r in read_latest_table(spark, str(tmp_path / "table")).collect()} == {"a": 2.0, "b": 5.0}


def test_error_monitor_and_gate(spark, tmp_path):
    n = 96
    pdf = pd.DataFrame({"series_id": "a", "ts": hourly("2020-01-01", n), "y": 100.0, "p": 101.0})
    pdf.loc[pdf["ts"] >= "2020-01-03", "p"] = 110.0
    df = spark.createDataFrame(pdf)
    baseline = spark.createDataFrame([("a", 2.0)], "series_id string, baseline_mape double")
    stream = stream_of(spark, tmp_path, "errors", [df])
    out = drain(error_monitor_stream(stream, baseline, ["series_id"], "ts", "y", "p"), spark, tmp_path, "mon").orderBy("span_start").collect()
    assert [(r["mape"], r["drift_flag"]) for r in out] == [(pytest.approx(1), False), (pytest.approx(1), False), (pytest.approx(10), True)]
    good, bad, results = (str(tmp_path / d) for d in ("good", "bad", "results"))
    stream = stream_of(spark, tmp_path, "gate", [df, df.unionByName(df)])
    quality_gate_stream(stream, [Check("unique", "ts"), Check("not_null", "y", 0.1)], good, bad, results, str(tmp_path / "gck")).awaitTermination()
    assert spark.read.parquet(good).count() == n and spark.read.parquet(bad).count() == 2 * n
    assert spark.read.parquet(results).count() == 4


# ---- the whole chain ------------------------------------------------------------------------------------------------


def test_full_job(spark, tmp_path, raw_readings):
    raw = spark.createDataFrame(raw_readings.astype(str))
    layout = TableLayout(str(tmp_path / "tables"))
    checks = [Check("exists", "utc_timestamp"), Check("unique", "utc_timestamp"), Check("row_count", limit=1000)]
    features = FeatureParams(lags=(1, 24, 168), windows=(6, 24), fourier_order=2)
    train = TrainParams(folds=2, boost=BOOST, changepoints=3, explain_rows=20)
    drift = DriftParams(
        DriftWindow("reference", "2019-01-08", "2019-01-28"),
        (DriftWindow("control", "2019-01-29", "2019-02-10"), DriftWindow("late", "2019-02-11", "2019-02-25")),
        "2019-02-01", "2019-02-28",
    )
    result = full(raw, Axis(), layout, CleanParams(), features, SPLIT, train, drift, checks, forest_trees=5)
    cleaned, matrix = layout.read(spark, "clean"), layout.read(spark, "features")
    assert cleaned.count() == len(raw_readings)
    assert matrix.dropna().count() == matrix.count() == len(raw_readings) - 168
    row = matrix.where("ts = timestamp '2019-01-20 05:00:00'").first()
    assert row["lag_24h"] == cleaned.where("ts = timestamp '2019-01-19 05:00:00'").first()["load_mw"]
    meta = layout.read(spark, "split_metadata").first()
    assert meta["n_train"] + meta["n_val"] + meta["n_test"] == matrix.count() and len(meta["train_data_hash"]) == 32
    assert sum(r["promoted"] for r in result.selection.collect()) == 1
    stages = [r["stage"] for r in layout.read(spark, "model_versions").collect()]
    assert stages.count("Production") == 1 and len(stages) == 3
    predictions = layout.read(spark, "predictions")
    assert predictions.count() == meta["n_test"] and {"lower_aci", "upper_aci", "abs_error", "lower_bound"} <= set(predictions.columns)
    names = {r["metric"] for r in result.runs.collect()}
    assert {"val_mape", "fold_mape", "cv_fold_mape_mean", "conformal_q", "val_pi_coverage", "val_pi_coverage_raw"} <= names
    assert layout.read(spark, "drift_results").count() == 2 * 10
    analysis = [json.loads(r["value"]) for r in layout.read(spark, "drift_analysis").collect()]
    assert {a["window"] for a in analysis} == {"control", "late"}
    assert json.loads(layout.read(spark, "drift_reference").first()["value"])["n_features"] == 10
    assert json.loads(layout.read(spark, "quality_report").first()["value"])["success"]
    assert layout.read(spark, "attributions").count() == 20 and set(JOBS) >= {"ingest", "full"}
    failing = [Check("row_count", limit=8760)]
    with pytest.raises(Exception, match="hard quality checks failed"):
        full(raw, Axis(), TableLayout(str(tmp_path / "other")), checks=failing)
