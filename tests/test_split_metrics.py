"""Split, folds, metrics, profiles, conformal calibration, drift and quality checks."""

import json
import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.functions.timegrid import time_slice
from gridcast.operators.conformal import (
    AdaptiveState, SortedScores, adaptive_conformal, adaptive_summary, conformal_offset, widen,
)
from gridcast.operators.drift import drift_statistics, drift_summary, feature_drift, monitored_columns
from gridcast.operators.metrics import concept_drift, error_columns, fold_summary, forecast_metrics, interval_metrics
from gridcast.operators.profile import autocorrelation, describe
from gridcast.operators.quality import Check, check_statistics, gate, quality_report, require, run_checks
from gridcast.operators.split import (
    assign_split, check_split, features_and_target, fingerprint, split_metadata, split_overlap, walk_forward_folds,
)
from gridcast.params import AdaptiveParams, Axis, DriftParams, DriftWindow, SplitParams

from conftest import hourly

CUTS = SplitParams("2018-12-31 23:00:00", "2019-06-30 23:00:00")


@pytest.fixture(scope="module")
def features(spark):
    n = 24 * 365 * 2
    pdf = pd.DataFrame({"ts": hourly("2018-01-01", n), "load_mw": np.random.default_rng(0).normal(55000, 5000, n)})
    pdf["lag_1h"] = pdf["load_mw"].shift(1)
    pdf["hour"] = pdf["ts"].dt.hour
    pdf["series_id"] = "DE"
    df = spark.createDataFrame(pdf.dropna()).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return df.cache()


def test_split(spark, features):
    labelled = assign_split(features, "ts", CUTS)
    meta = split_metadata(labelled, "ts", "load_mw").first()
    n = features.count()
    assert meta["n_train"] + meta["n_val"] + meta["n_test"] == n == 17519
    assert meta["train_end"] < meta["val_start"] and meta["val_end"] < meta["test_start"]
    assert len(meta["train_data_hash"]) == 32 and "load_mw" not in meta["feature_columns"]
    assert check_split(labelled, "ts").first()["ok"]
    overlap = split_overlap(labelled, ["series_id", "ts"]).first()
    assert overlap["shared_keys"] == 0 and overlap["total_rows"] == n
    x, y = features_and_target(features, "load_mw")
    assert "load_mw" not in x.columns and y.columns == ["load_mw"]
    with pytest.raises(Exception, match="split boundary"):
        check_split(assign_split(features, "ts", SplitParams("2030-01-01", "2031-01-01")), "ts").collect()


def test_fingerprint_is_stable(spark, features):
    a, b = (fingerprint(features.repartition(k)).first()[0] for k in (1, 13))
    c = fingerprint(features.withColumn("load_mw", F.col("load_mw") + 1)).first()[0]
    assert a == b != c and len(a) == 32


def test_walk_forward_folds(spark, features):
    out = walk_forward_folds(features, Axis(bucket=1000), 4).groupBy("fold", "role").count().toPandas()
    size = 17519 // 5
    got = {(r.fold, r.role): r["count"] for _, r in out.iterrows()}
    assert got == {(i, role): size * i if role == "train" else size for i in range(1, 5) for role in ("train", "val")}


def test_time_slice_end(spark, features):
    day = time_slice(features, "ts", "2019-06-29", "2019-06-30")
    assert day.count() == 25
    assert time_slice(features, "ts", "2019-06-29", "2019-06-30", end_inclusive_day=True).count() == 48


def test_metrics(spark):
    pdf = pd.DataFrame({"g": ["a"] * 4, "y": [0.0, 10.0, 20.0, -5.0], "p": [1.0, 12.0, 18.0, -4.0]})
    pdf["lo"], pdf["hi"] = pdf["y"] - [0, 1, 1, 1], pdf["y"] + [0, -0.5, 1, 1]
    df = spark.createDataFrame(pdf)
    m = forecast_metrics(df, ["g"], "y", "p", with_smape=True).first()
    e = pdf["y"] - pdf["p"]
    assert m["mape"] == pytest.approx((e / pdf["y"]).abs()[pdf["y"] != 0].mean() * 100)
    assert m["rmse"] == pytest.approx(math.sqrt((e**2).mean())) and m["mae"] == pytest.approx(e.abs().mean())
    rows = error_columns(df, "y", "p").collect()
    assert rows[0]["mape_contribution"] is None and rows[1]["mape_contribution"] == pytest.approx(20)
    assert interval_metrics(df, ["g"], "y", "lo", "hi").first()["coverage"] == 0.75
    cv = fold_summary(spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "m double"), [], "m").first()
    assert cv["cv_m_std"] == pytest.approx(np.std([1, 2, 4]))


def test_concept_drift(spark):
    ts = pd.date_range("2020-01-15", periods=6, freq="MS")
    rows = [("s", t.to_pydatetime(), 100.0, e) for t, e in zip(ts, [1.0, 1.2, 5.0, 1.1, 0.9, 1.7])]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double, abs_error double")
    out = concept_drift(df, ["series_id"], "ts", "y", "2020-04-10", "2020-04-20").orderBy("month").toPandas()
    assert out["baseline_mape"].iloc[0] == pytest.approx(np.median([1.0, 1.2, 1.1, 0.9, 1.7]))
    assert out["drift_flag"].tolist() == [False, False, True, False, False, True]
    everything = concept_drift(df, [], "ts", "y").toPandas()
    assert everything["baseline_mape"].iloc[0] == pytest.approx(np.median([1.0, 1.2, 5.0, 1.1, 0.9, 1.7]))
    nothing = concept_drift(df, ["series_id"], "ts", "y", "2020-01-01", "2020-12-31").toPandas()
    assert nothing["baseline_mape"].isnull().all() and not nothing["drift_flag"].any()


def test_describe_and_autocorrelation(spark, features):
    pdf = features.toPandas().sort_values("ts")
    d = describe(features, [], "load_mw").first()
    expected = pdf["load_mw"].describe()
    for mine, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("max", "max")):
        assert d[mine] == pytest.approx(expected[theirs])
    holes = features.withColumn("load_mw", F.when(F.hour("ts") != 3, F.col("load_mw")))
    kept = pdf[pdf["hour"] != 3]["load_mw"]
    for frame, series, compact in ((features, pdf["load_mw"], False), (holes, kept, True)):
        got = autocorrelation(frame, Axis(bucket=1024), "load_mw", [1, 24, 720], compact).toPandas().set_index("lag")["acf"]
        for h in (1, 24, 720):
            assert got[h] == pytest.approx(series.autocorr(h), abs=1e-9)


def calibration(spark, n, scale, half, seed, series="s"):
    y = np.random.default_rng(seed).normal(0, scale, n)
    pdf = pd.DataFrame({"series_id": series, "i": np.arange(n), "y": y, "y_lower": -half, "y_upper": half})
    pdf[["y_lower", "y_upper"]] = pdf[["y_lower", "y_upper"]].astype(float)
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("n,scale,half,seed", [(500, 10, 5, 0), (300, 1, 10, 1), (10, 1, 0.1, 2), (3, 1, 1, 3)])
def test_split_conformal(spark, n, scale, half, seed):
    pdf, df = calibration(spark, n, scale, half, seed)
    q = conformal_offset(df, ["series_id"], 0.2).first()["q"]
    scores = np.maximum(pdf["y_lower"] - pdf["y"], pdf["y"] - pdf["y_upper"])
    rank = min(np.ceil((n + 1) * 0.8) / n, 1.0)
    assert q == np.quantile(scores, rank, method="higher")
    wide = widen(df, "y_lower", "y_upper", F.lit(q))
    assert interval_metrics(wide, [], "y", "y_lower", "y_upper").first()["coverage"] >= 0.8
    assert n < 10 or (q > 0) == (half < scale)


def test_order_statistic_of_one_to_ten(spark):
    df = spark.createDataFrame([(float(v), 0.0, 0.0) for v in range(1, 11)], "y double, y_lower double, y_upper double")
    # n = 10, rank ceil(11 * 0.75) / 10 = 0.9: index ceil(0.9 * 9) = 9, the tenth value
    assert conformal_offset(df, [], 0.25).first()["q"] == 10.0


def recursion(pdf, gamma, coverage=0.8, q=0.0):
    """Direct form of the adaptive recursion, with a full quantile at every step."""
    level, seen, out = 1 - coverage, [], []
    for y, lo, hi in pdf[["y", "y_lower", "y_upper"]].itertuples(index=False):
        hit = lo - q <= y <= hi + q
        out.append((q, int(hit)))
        seen.append(max(lo - y, y - hi))
        level = float(np.clip(level + gamma * ((1 - coverage) - (not hit)), 1e-4, 1 - 1e-4))
        if len(seen) >= 2:
            q = float(np.quantile(seen, 1 - level, method="higher"))
    return out


def test_adaptive_conformal(spark):
    a, da = calibration(spark, 2000, 10, 2, 2, "a")
    b, db = calibration(spark, 700, 3, 5, 3, "b")
    params = AdaptiveParams(0.8, 0.05)
    out = adaptive_conformal(da.unionByName(db).repartition(5), ["series_id"], "i", params)
    pdf = out.toPandas().sort_values(["series_id", "i"])
    for key, source in (("a", a), ("b", b)):
        got = pdf[pdf.series_id == key]
        assert list(zip(got["q"], got["hit"])) == recursion(source, 0.05)
    late = pdf[(pdf.series_id == "a") & (pdf["i"] >= 1000)]["hit"].mean()
    assert 0.75 <= late <= 0.85
    summary = adaptive_summary(out, ["series_id"], "i").toPandas().set_index("series_id")
    assert summary.loc["a", "q_initial"] == 0.0
    assert summary.loc["a", "q_final"] == pdf[(pdf.series_id == "a")]["q"].iloc[-1]


def test_adaptive_conformal_start_values(spark):
    _, df = calibration(spark, 50, 1, 1, 4)
    df = df.withColumn("q0", F.lit(3.0)).withColumn("seeds", F.array(F.lit(1.0), F.lit(2.0)))
    out = adaptive_conformal(df, ["series_id"], "i", initial_q="q0", seed_scores="seeds").orderBy("i").toPandas()
    assert out["q"].iloc[0] == 3.0 and out["q"].iloc[1] <= 2.0  # two scores are known from the start
    holes = adaptive_conformal(df.withColumn("y", F.when(F.col("i") != 5, F.col("y"))), ["series_id"], "i").orderBy("i").toPandas()
    assert len(holes) == 50 and np.isnan(holes["q"].iloc[5]) and pd.isna(holes["hit"].iloc[5])


def test_sorted_scores():
    rng = np.random.default_rng(7)
    values = np.round(rng.normal(0, 1, 6000), 2).tolist()
    scores = SortedScores()
    for v in values:
        scores.add(v)
    assert scores.values() == sorted(values)
    assert scores.higher(0.3) == np.quantile(values, 0.3, method="higher")
    assert AdaptiveState(AdaptiveParams(), 1.0, values).scores.size == 6000


WINDOWS = DriftParams(
    DriftWindow("reference", "2020-01-01", "2020-02-29 23:00:00"),
    (DriftWindow("same", "2020-03-01", "2020-03-31 23:00:00"), DriftWindow("moved", "2020-04-01", "2020-04-30 23:00:00", "x")),
    "2020-04-01", "2020-04-30",
)


def drift_frame(spark, n_days=121, freq="h"):
    ts = pd.date_range("2020-01-01", "2020-04-30 23:00", freq=freq)
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"ts": ts, "lag_1h": np.round(rng.normal(50, 5, len(ts)), 2), "hour": rng.integers(0, 3, len(ts))})
    moved = ts >= "2020-04-01"
    pdf.loc[moved, "lag_1h"] += 4
    pdf.loc[moved, "hour"] = rng.integers(1, 3, moved.sum())
    pdf["is_working_day"] = (pdf["hour"] > 0).astype(int)
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    parts = {
        "reference": pdf[ts <= "2020-02-29 23:00"],
        "same": pdf[(ts >= "2020-03-01") & (ts <= "2020-03-31 23:00")],
        "moved": pdf[ts >= "2020-04-01"],
    }
    return df, parts


def ecdf_distance(a, b):
    points = np.unique(np.concatenate([a, b]))
    fa, fb = (np.searchsorted(np.sort(x), points, side="right") / len(x) for x in (a, b))
    gap = np.abs(fa - fb)
    return float((gap[:-1] * np.diff(points)).sum()), float(gap.max())


def test_drift_distances(spark):
    df, parts = drift_frame(spark)
    names = ["lag_1h", "hour", "is_working_day"]
    stats = drift_statistics(df, "ts", WINDOWS, names).toPandas().set_index(["feature", "window"])
    verdicts = feature_drift(df, "ts", WINDOWS, names).toPandas().set_index(["feature", "window"])
    for label in ("same", "moved"):
        for c in names:
            a, b = parts["reference"][c].to_numpy(float), parts[label][c].to_numpy(float)
            distance, ks = ecdf_distance(a, b)
            assert stats.loc[(c, label), "wasserstein"] == pytest.approx(distance)
            assert stats.loc[(c, label), "ks"] == pytest.approx(ks)
            keys = np.union1d(a, b)
            p, q = (np.array([(x == k).mean() for k in keys]) for x in (a, b))
            m = (p + q) / 2
            js = math.sqrt(sum(sum(x * math.log(x / y) for x, y in zip(s, m) if x > 0) for s in (p, q)) / 2)
            assert stats.loc[(c, label), "jensen_shannon"] == pytest.approx(js, abs=1e-9)
        normed = ecdf_distance(parts["reference"]["lag_1h"], parts[label]["lag_1h"])[0] / parts["reference"]["lag_1h"].std(ddof=0)
        assert verdicts.loc[("lag_1h", label), "drift_score"] == pytest.approx(normed)
    assert verdicts.loc[("lag_1h", "moved"), "drift_detected"] and not verdicts.loc[("lag_1h", "same"), "drift_detected"]
    assert verdicts.loc[("hour", "moved"), "stattest"] == "Jensen-Shannon distance"
    assert verdicts.loc[("hour", "moved"), "drift_detected"]
    summary = drift_summary(feature_drift(df, "ts", WINDOWS, names), WINDOWS.windows).toPandas().set_index("window")
    assert "lag_1h" in summary.loc["moved", "drifted_features"] and summary.loc["moved", "note"] == "x"


def test_p_value_tests(spark):
    df, parts = drift_frame(spark, freq="4h")
    assert (feature_drift(df, "ts", WINDOWS, ["lag_1h"]).toPandas()["threshold"] == 0.1).all()  # the same test at every size
    out = feature_drift(df, "ts", replace(WINDOWS, test="p_value"), ["lag_1h", "hour", "is_working_day"]).toPandas().set_index(["feature", "window"])
    assert out.loc[("lag_1h", "moved"), "stattest"] == "K-S p_value" and out.loc[("lag_1h", "moved"), "drift_score"] < 1e-6
    assert out.loc[("hour", "same"), "stattest"] == "chi-square p_value"
    assert out.loc[("is_working_day", "same"), "stattest"] == "Z-test p_value"
    a, b = parts["reference"]["is_working_day"], parts["same"]["is_working_day"]
    pooled = (a.sum() + b.sum()) / (len(a) + len(b))
    z = (a.mean() - b.mean()) / math.sqrt(pooled * (1 - pooled) * (1 / len(a) + 1 / len(b)))
    assert out.loc[("is_working_day", "same"), "drift_score"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
    observed = parts["same"]["hour"].value_counts().sort_index()
    expected = parts["reference"]["hour"].value_counts().sort_index() * len(b) / len(a)
    chi = ((observed - expected) ** 2 / expected).sum()
    assert out.loc[("hour", "same"), "drift_score"] == pytest.approx(math.exp(-chi / 2))
    assert (out["threshold"] == 0.05).all()


def test_drift_of_identical_and_shifted_windows(spark):
    df, _ = drift_frame(spark)
    base = df.where(F.col("ts") < "2020-03-01").select("ts", "lag_1h")
    twin = base.withColumn("ts", F.col("ts") + F.expr("interval 366 days"))
    shifted = base.withColumn("ts", F.col("ts") + F.expr("interval 731 days")).withColumn("lag_1h", F.col("lag_1h") + 2.5)
    params = DriftParams(
        WINDOWS.reference,
        (DriftWindow("twin", "2021-01-01", "2021-03-01 23:00:00"), DriftWindow("shift", "2022-01-01", "2022-03-02 23:00:00"),
         DriftWindow("empty", "2030-01-01", "2030-02-01")),
    )
    rows = base.unionByName(twin).unionByName(shifted)
    out = feature_drift(rows, "ts", params, ["lag_1h"]).toPandas().set_index("window")
    std = base.agg(F.stddev_pop("lag_1h")).first()[0]
    assert out.loc["twin", "drift_score"] == 0 and out.loc["shift", "drift_score"] == pytest.approx(2.5 / std)
    assert set(out.index) == {"twin", "shift"}
    by = feature_drift(rows.withColumn("series_id", F.lit("s")), "ts", params, ["lag_1h"], ["series_id"]).toPandas()
    assert sorted(by["drift_score"]) == pytest.approx(sorted(out["drift_score"]))


def test_monitored_columns(spark):
    cols = [f"lag_{i}" for i in range(8)] + [f"rolling_{i}" for i in range(8)] + ["hour", "load_mw", "wind_mw"]
    df = spark.createDataFrame([tuple(float(i) for i in range(len(cols)))], ", ".join(f"{c} double" for c in cols))
    assert monitored_columns(df, "load_mw") == cols[:17]  # all lags, rolling statistics and the hour
    assert monitored_columns(df.select("load_mw", "wind_mw"), "load_mw") == ["wind_mw"]


CHECKS = [
    Check("exists", "ts"), Check("exists", "nope"), Check("not_null", "v", 0.3), Check("not_null", "v", 0.2),
    Check("between", "v", 0.99, 0.0, 10.0), Check("between", "v", 0.5, 0.0, 1.5), Check("unique", "ts"), Check("row_count", limit=5),
]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, None), (4, 3.0)], "ts int, v double")
    results = run_checks(df, CHECKS)
    got = {(r["check"], r["column"], r["threshold"]): r["success"] for r in results.collect()}
    assert got == {
        ("exists", "ts", 1.0): True, ("exists", "nope", 1.0): False, ("not_null", "v", 0.3): True,
        ("not_null", "v", 0.2): False, ("between", "v", 0.99): True, ("between", "v", 0.5): False,
        ("unique", "ts", 0.0): False, ("row_count", "", 5.0): False,
    }
    stats = check_statistics(results).first()
    assert (stats["evaluated"], stats["passed"], stats["failed"]) == (8, 3, 5)
    report = json.loads(quality_report(results, "suite").first()["report"])
    assert report["suite"] == "suite" and not report["success"] and len(report["results"]) == 8
    with pytest.raises(Exception, match="hard quality checks failed"):
        gate(df, results).collect()
    with pytest.raises(ValueError, match="exists:nope"):
        require(results)
    soft = run_checks(df, [CHECKS[0], CHECKS[3]])
    assert gate(df, soft).count() == 4
    require(soft)
