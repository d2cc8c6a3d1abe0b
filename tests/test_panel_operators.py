"""Grid, gap filling, features and outliers against direct pandas computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators.buckets import dense_index
from gridcast.operators.cleaning import enforce_non_negative, normalise_columns
from gridcast.operators.features import (
    build_feature_matrix, feature_names, fourier_features, history_features, lag_by_join, lag_features,
)
from gridcast.operators.gaps import fill_gaps, fill_limited, label_null_runs
from gridcast.operators.grid import make_grid
from gridcast.operators.outliers import isolation_scores, remove_outliers
from gridcast.operators.quantiles import exact_quantiles
from gridcast.operators import quantiles
from gridcast.params import Axis, FeatureParams

from conftest import hourly

SCHEMA = "series_id string, ts timestamp_ntz, y double"


def frame(spark, series: dict, start="2020-01-01", step="h"):
    """Rows for known values only, plus each series' end rows so that the grid's extent is known."""
    rows = []
    for key, values in series.items():
        for i, (t, v) in enumerate(zip(pd.date_range(start, periods=len(values), freq=step), values)):
            if v is not None and not np.isnan(v) or i in (0, len(values) - 1):
                rows.append((key, t.to_pydatetime(), None if v is None or np.isnan(v) else float(v)))
    return spark.createDataFrame(rows, SCHEMA)


def column(df, key, name="y"):
    out = df.where(F.col("series_id") == key).orderBy("ts").toPandas()[name]
    return out.astype(float).to_numpy()


def phase_one(values, max_gap):
    s = pd.Series(values, dtype=float)
    null = s.isnull()
    run = (null != null.shift()).cumsum()
    size = null.groupby(run).transform("sum")
    return s.interpolate(limit=max_gap) if (null & (size <= max_gap)).any() else s


def with_runs(n, runs, seed=0):
    y = np.random.default_rng(seed).normal(100, 10, n)
    for start, length in runs:
        y[start : start + length] = np.nan
    return y


CASES = {
    "short_and_long": with_runs(60, [(5, 1), (20, 10)]),
    "long_only": with_runs(60, [(20, 10)]),
    "forty_only": with_runs(90, [(20, 40)]),
    "forty_and_short": with_runs(90, [(3, 1), (20, 40)]),
    "short_leading_flips": with_runs(60, [(0, 2), (20, 10)]),
    "trailing": with_runs(60, [(30, 30)]),
    "short_trailing_flips": with_runs(60, [(10, 12), (57, 3)]),
    "long_leading": with_runs(60, [(0, 9), (30, 12)]),
    "complete": with_runs(60, []),
    "all_null": with_runs(5, [(0, 5)]),
}


@pytest.mark.parametrize("bucket", [16, 4096])
def test_fill_gaps_reference_mode(spark, bucket):
    axis = Axis(bucket=bucket)
    grid = make_grid(frame(spark, CASES), axis, keep_helpers=True)
    once = fill_gaps(grid, axis, ["y"], 6, keep_helpers=True)
    twice = fill_limited(once, axis, ["y"], 24).toPandas()
    once = once.toPandas()
    for key, values in CASES.items():
        expected = phase_one(values, 6)
        got = once[once.series_id == key].sort_values("ts")["y"].astype(float)
        np.testing.assert_allclose(got, expected, err_msg=key)
        got = twice[twice.series_id == key].sort_values("ts")["y"].astype(float)
        np.testing.assert_allclose(got, expected.interpolate(limit=24), err_msg=key)


def test_fill_gaps_strict_and_causal(spark):
    axis = Axis(bucket=16)
    grid = make_grid(frame(spark, {"a": CASES["short_and_long"]}), axis)
    strict = column(fill_gaps(grid, axis, ["y"], 6, mode="strict"), "a")
    assert not np.isnan(strict[5]) and np.isnan(strict[20:30]).all()
    causal = column(fill_gaps(grid, axis, ["y"], 6, causal=True), "a")
    assert causal[5] == CASES["short_and_long"][4]
    with pytest.raises(ValueError):
        fill_gaps(grid, axis, ["y"], mode="other")


def test_null_runs(spark):
    axis = Axis(bucket=16)
    grid = make_grid(frame(spark, {"a": with_runs(60, [(0, 2), (14, 5), (58, 2)])}), axis)
    runs = label_null_runs(grid, axis, "y").toPandas()
    sizes = runs.groupby("run_id")["run_length"].agg(["first", "size"])
    assert sorted(sizes["first"]) == [2, 2, 5] and (sizes["first"] == sizes["size"]).all()
    assert sorted(runs[runs.run_length == 5]["run_position"]) == [1, 2, 3, 4, 5]


def test_grid_errors(spark):
    twice = frame(spark, {"a": [1.0, 2.0]}).unionByName(frame(spark, {"a": [1.0]}))
    with pytest.raises(Exception, match="duplicate timestamp"):
        make_grid(twice, Axis()).collect()
    with pytest.raises(Exception, match="not on the grid"):
        make_grid(frame(spark, {"a": [1.0, 2.0]}, start="2020-01-01 00:30"), Axis()).collect()
    assert make_grid(frame(spark, {"a": [1.0, 2.0]}, start="2020-01-01 00:30"), Axis(phase=1800)).count() == 2


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_history_features_do_not_depend_on_partitions(spark, partitions):
    values = {"a": with_runs(400, [(50, 4), (120, 30)], 1), "b": with_runs(300, [], 2)}
    axis = Axis(bucket=170)
    grid = make_grid(frame(spark, values), axis).repartition(partitions)
    out = history_features(grid, axis, "y", [1, 24, 168], [6, 24]).toPandas()
    for key, v in values.items():
        got = out[out.series_id == key].sort_values("ts")
        s = pd.Series(v)
        for h in (1, 24, 168):
            np.testing.assert_allclose(got[f"lag_{h}h"], s.shift(h))
        for w in (6, 24):
            rolled = s.shift(1).rolling(w, min_periods=w // 2)
            np.testing.assert_allclose(got[f"rolling_mean_{w}h"], rolled.mean())
            np.testing.assert_allclose(got[f"rolling_std_{w}h"], rolled.std())


def test_lag_by_join_equals_window(spark):
    df = make_grid(frame(spark, {"a": with_runs(100, [(5, 3)])}), Axis())
    a = lag_by_join(df, Axis(), "y", 24).orderBy("ts").toPandas()["lag_24h"]
    b = lag_features(df, Axis(), "y", [24]).orderBy("ts").toPandas()["lag_24h"]
    pd.testing.assert_series_equal(a, b)
    with pytest.raises(ValueError):
        lag_features(df, Axis(bucket=10), "y", [24])


def test_features_do_not_look_ahead(spark):
    values = np.random.default_rng(3).normal(0, 1, 200)
    changed = values.copy()
    changed[150] += 1000
    axis = Axis(bucket=64)
    a, b = (
        history_features(frame(spark, {"a": v}), axis, "y", [1, 24], [6, 24]).orderBy("ts").toPandas().drop(columns="y")
        for v in (values, changed)
    )
    pd.testing.assert_frame_equal(a.iloc[:151], b.iloc[:151])
    assert not a.iloc[151].equals(b.iloc[151])


def test_calendar_and_fourier(spark):
    n = 24 * 10
    df = frame(spark, {"a": np.arange(n, dtype=float)}, start="2020-12-28").withColumnRenamed("y", "load_mw")
    params = FeatureParams(lags=(1,), windows=(2,), drop_nulls=False)
    out = build_feature_matrix(df, Axis(), params).orderBy("ts").toPandas()
    assert list(out.columns) == ["series_id", "ts", "load_mw", *feature_names(params)]
    ts = hourly("2020-12-28", n)
    assert (out["hour"].to_numpy() == ts.hour).all() and (out["day_of_week"].to_numpy() == ts.dayofweek).all()
    assert (out["week_of_year"].to_numpy() == ts.isocalendar().week.to_numpy()).all()
    assert out.loc[ts == "2021-01-03 05:00", "week_of_year"].item() == 53
    new_year = out[ts.normalize() == "2021-01-01"]
    assert (new_year["is_holiday"] == 1).all() and (new_year["is_working_day"] == 0).all()
    assert out["is_holiday"].sum() == 24
    np.testing.assert_allclose(out["fourier_168h_sin_3"], np.sin(2 * np.pi * 3 * np.arange(n) / 168), atol=1e-12)
    compat = build_feature_matrix(df, Axis(), FeatureParams(lags=(1,), windows=(2,), holidays="compat")).toPandas()
    assert (compat["is_holiday"] == 0).all() and not compat.isnull().any().any()
    names = [c for c in fourier_features(df, Axis(), [24, 168], 2).columns if c.startswith("fourier_")]
    assert len(names) == 8


def test_outliers(spark):
    y = np.random.default_rng(4).normal(100, 5, 300)
    y[50], y[200] = 1e6, -1e6
    df = frame(spark, {"a": y, "b": y * 2})
    for method in ("iqr", "isolation_forest"):
        out = remove_outliers(df, Axis(bucket=64), ["y"], method=method, contamination=0.02)
        got = column(out, "a")
        assert len(got) == 300 and got.max() < 1e5 and got.min() > -1e5, method
    with pytest.raises(ValueError, match="unknown outlier method"):
        remove_outliers(df, Axis(), ["y"], method="unsupported")
    # Fences from the first part only: the spike of the second part can't widen them.
    early = remove_outliers(df, Axis(), ["y"], until="2020-01-02 12:00:00")
    assert column(early, "a").max() < 1e5


def test_isolation_scores_rank_outliers_and_are_reproducible(spark):
    y = np.random.default_rng(5).normal(0, 1, 400)
    y[123] = 40
    df = frame(spark, {"a": y})
    a = isolation_scores(df, Axis(), ["y"], trees=30).toPandas().sort_values("_idx", ignore_index=True)
    b = isolation_scores(df.repartition(5), Axis(), ["y"], trees=30).toPandas().sort_values("_idx", ignore_index=True)
    pd.testing.assert_frame_equal(a, b)
    assert a["_score"].idxmax() == 123 and a["_score"].between(0, 1).all()


def test_normalise_and_clip(spark):
    raw = spark.createDataFrame(
        [("2019-01-01T01:00:00Z", "10", "n/a", "-3"), ("2019-01-01T00:00:00Z", "-5", "NaN", None)],
        "utc_timestamp string, DE_load_actual_entsoe_transparency string, DE_wind_generation_actual string, "
        "DE_solar_generation_actual string",
    )
    out = enforce_non_negative(normalise_columns(raw), ["wind_mw", "solar_mw"]).orderBy("ts").collect()
    assert [r["load_mw"] for r in out] == [-5.0, 10.0]
    assert [r["wind_mw"] for r in out] == [None, None] and [r["solar_mw"] for r in out] == [None, 0.0]
    with pytest.raises(ValueError, match="lacks"):
        normalise_columns(raw.drop("DE_wind_generation_actual"))
    with pytest.raises(Exception):
        normalise_columns(raw.withColumn("utc_timestamp", F.lit("yesterday"))).collect()


@pytest.mark.parametrize("small_group", [10_000, 5])
def test_exact_quantiles(spark, monkeypatch, small_group):
    """With the small-group limit at 5 nearly every group takes the sketch path (needs over 2,000 rows to be exact)."""
    monkeypatch.setattr(quantiles, "SMALL_GROUP", max(small_group, 5))
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 60_000), "v": np.round(rng.lognormal(3, 2, 60_000), 1)})
    pdf.loc[pdf.index % 7 == 0, "v"] = np.nan
    probs = {"lo": 0.0, "q1": 0.25, "m": 0.5, "q3": 0.75, "p999": 0.999, "hi": 1.0}
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = exact_quantiles(df, ["g"], "v", probs).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        for name, p in probs.items():
            assert got.loc[g, name] == pytest.approx(part["v"].quantile(p), rel=1e-9)
    whole = exact_quantiles(df, [], "v", {"m": 0.5}).first()
    assert whole["m"] == pytest.approx(pdf["v"].median()) and whole["n"] == pdf["v"].count()


def test_dense_index(spark):
    df = frame(spark, {"a": with_runs(100, [(10, 20), (50, 7)])}).where("y is not null")
    out = dense_index(df, Axis(bucket=16)).orderBy("ts").toPandas()
    assert (out["position"].to_numpy() == np.arange(len(out))).all()


def test_joint_forest_nulls_the_contaminated_share(spark):
    """Three columns, 100 trees: rows that are odd only together are found, and the flagged share is the contamination."""
    rng = np.random.default_rng(6)
    n = 2000
    a = rng.normal(0, 1, n)
    b = a + rng.normal(0, 0.05, n)
    odd = [100, 700, 1500]
    b[odd] = -3 * np.sign(a[odd]) - a[odd]
    df = frame(spark, {"s": np.arange(n, dtype=float)}).select("series_id", "ts", F.col("y").cast("int").alias("i"))
    values = spark.createDataFrame(pd.DataFrame({"i": np.arange(n), "a": a, "b": b, "c": a - b}))
    df = df.join(values.withColumn("i", F.col("i").cast("int")), "i").drop("i")
    out = remove_outliers(df, Axis(bucket=512), ["a", "b", "c"], method="isolation_forest", contamination=0.01, refill_limit=0)
    gone = out.where("a IS NULL")
    assert gone.count() == 20 and gone.where("b IS NOT NULL OR c IS NOT NULL").count() == 0
    found = set(gone.select(((F.unix_seconds(F.col("ts").cast("timestamp")) - F.lit(0)) / 3600).cast("long").alias("h")).toPandas()["h"])
    first = df.agg(F.min(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).cast("long")).first()[0]
    assert {first + i for i in odd} <= found
    few = remove_outliers(df, Axis(bucket=512), ["a", "b", "c"], method="isolation_forest", contamination=0.05, refill_limit=0, trees=20, sample=64, seed=1)
    assert few.where("a IS NULL").count() == 100
