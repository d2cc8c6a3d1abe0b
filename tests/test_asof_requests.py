"""Point-in-time join, latest tables, contracts, registry and request scoring features."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators import registry
from gridcast.operators.asof import entities_without_features, lookup_latest, materialize_latest, point_in_time_join
from gridcast.operators.features import history_features
from gridcast.operators.naive import hour_profile_baseline, last_season, naive_run, seasonal_naive, tile_last_season
from gridcast.operators.requests import (
    check_requests, expand_requests, rejected_requests, request_features, valid_requests,
)
from gridcast.params import Axis, FeatureParams
from gridcast.sources.tables import (
    CONTRACT_FIELDS, TableLayout, contract_v1, cut, enforce_contract, publish_features, read_raw, write_panel, write_report,
)

from conftest import hourly


def random_times(rng, n):
    return pd.Timestamp("2020-01-01") + pd.to_timedelta(rng.integers(0, 40 * 24 * 60, n), unit="min")


@pytest.mark.parametrize("rows_per_task", [7, 5_000_000])
@pytest.mark.parametrize("ttl_days", [None, 3])
def test_point_in_time_join(spark, rows_per_task, ttl_days):
    rng = np.random.default_rng(1)
    spine = pd.DataFrame({"k": rng.choice(list("abcd"), 400), "t": random_times(rng, 400), "row": np.arange(400)})
    spine.loc[:150, "k"] = "a"
    spine.loc[:60, "t"] = pd.Timestamp("2020-01-20 10:00")  # one crowded moment
    feats = pd.DataFrame({"k": rng.choice(list("abc"), 200), "ft": random_times(rng, 200)}).drop_duplicates()
    feats = feats[(feats["ft"] < "2020-01-12") | (feats["ft"] > "2020-01-18")].assign(v=lambda d: np.arange(len(d), dtype=float))
    feats.loc[feats.index[0], "ft"] = spine["t"].iloc[70]
    feats.loc[feats.index[0], "k"] = spine["k"].iloc[70]
    ttl = None if ttl_days is None else pd.Timedelta(days=ttl_days)
    expected = pd.merge_asof(
        spine.sort_values("t"), feats.sort_values("ft"), left_on="t", right_on="ft", by="k", tolerance=ttl
    ).set_index("row")["v"].sort_index()
    got = point_in_time_join(
        spark.createDataFrame(spine), spark.createDataFrame(feats), ["k"], "t", "ft",
        None if ttl is None else int(ttl.total_seconds()), rows_per_task=rows_per_task,
    ).toPandas()
    assert len(got) == 400
    got = got.set_index("row")["v"].sort_index()
    np.testing.assert_array_equal(got, expected)


def test_point_in_time_edges(spark):
    feats = spark.createDataFrame(
        [("a", "2020-01-01 00:00", 1.0, 1), ("a", "2020-01-05 00:00", 2.0, 1), ("a", "2020-01-05 00:00", 3.0, 2)],
        "k string, ft string, v double, made int",
    ).withColumn("ft", F.col("ft").cast("timestamp_ntz"))
    asks = ["2020-01-01 00:00", "2020-01-04 00:00", "2020-01-04 00:01", "2020-01-05 00:00", "2019-12-31 23:59"]
    spine = spark.createDataFrame([("a", t, i) for i, t in enumerate(asks)] + [("z", asks[0], 9)], "k string, t string, i int")
    spine = spine.withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = point_in_time_join(spine, feats, ["k"], "t", "ft", 3 * 86400, created="made")
    got = {r["i"]: r["v"] for r in out.collect()}
    assert got == {0: 1.0, 1: 1.0, 2: None, 3: 3.0, 4: None, 9: None}
    assert [r["k"] for r in entities_without_features(spine, feats, ["k"]).collect()] == ["z"]


def test_latest(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-01", 1.0), ("a", "2020-01-03", 3.0), ("a", "2020-01-02", 2.0), ("b", "2020-01-01", 7.0)],
        "k string, t string, v double",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    latest = materialize_latest(df, ["k"], "t")
    assert {r["k"]: r["v"] for r in latest.collect()} == {"a": 3.0, "b": 7.0}
    assert {r["k"]: r["v"] for r in materialize_latest(df, ["k"], "t", "2020-01-01", "2020-01-02").collect()} == {"a": 2.0, "b": 7.0}
    asked = lookup_latest(spark.createDataFrame([("a",), ("c",)], "k string"), latest, ["k"])
    assert {r["k"]: r["v"] for r in asked.collect()} == {"a": 3.0, "c": None}


def test_contract(spark):
    row = {c: 1 for c in CONTRACT_FIELDS}
    df = spark.createDataFrame([row]).withColumn("ts", F.to_timestamp(F.lit("2020-01-01T01:00:00+01:00")))
    published = publish_features(df, "ts")
    out = enforce_contract(published, contract_v1())
    assert out.schema == contract_v1() or [f.dataType for f in out.schema] == [f.dataType for f in contract_v1()]
    assert str(out.first()["timestamp"]) == "2020-01-01 00:00:00" and out.first()["grid_zone"] == "DE"
    with pytest.raises(ValueError, match="missing"):
        enforce_contract(published.drop("lag_1h"), contract_v1())
    with pytest.raises(ValueError, match="extra"):
        enforce_contract(published.withColumn("other", F.lit(1)), contract_v1())


def test_tables(spark, tmp_path, raw_readings):
    csv = tmp_path / "raw.csv"
    raw_readings.assign(AT_load=1.0).to_csv(csv, index=False)
    raw = read_raw(spark, str(csv))
    assert raw.columns == list(raw_readings.columns) and raw.count() == len(raw_readings)
    plan = raw._jdf.queryExecution().toString()
    assert "AT_load" not in plan.split("ReadSchema")[-1]
    df = spark.createDataFrame(pd.DataFrame({"series_id": ["a", "b"] * 48, "ts": hourly("2020-01-30", 96), "y": np.arange(96.0)}))
    for by_month in (False, True):
        path = str(tmp_path / f"panel{by_month}")
        write_panel(df, path, by_month=by_month)
        assert spark.read.parquet(path).count() == 96
        column, value = ("month", "2020-02") if by_month else ("series_id", "a")
        pruned = spark.read.parquet(path).where(F.col(column) == value)
        assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().toString()
    layout = TableLayout(str(tmp_path / "tables"))
    assert layout.save(df, "clean").count() == 96
    layout.write(df.limit(2), "drift_results")
    assert layout.read(spark, "drift_results").columns == ["series_id", "ts", "y"]
    layout.write(df.agg(F.count("y").alias("n")), "split_metadata")
    assert layout.read(spark, "split_metadata").first()["n"] == 96
    layout.write(spark.createDataFrame([("text",)], "value string"), "quality_report")
    assert layout.read(spark, "quality_report").first()["value"] == "text"
    assert cut(df).count() == 96
    with pytest.raises(ValueError):
        write_report(df, str(tmp_path / "x"), "xml")


def panel(spark, n=600, start="2020-01-01"):
    rng = np.random.default_rng(2)
    parts = [pd.DataFrame({"series_id": s, "ts": hourly(start, n), "y": rng.normal(100, 5, n)}) for s in "ab"]
    pdf = pd.concat(parts)
    return pdf, spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_naive(spark):
    pdf, df = panel(spark)
    axis = Axis(bucket=200)
    got = seasonal_naive(df, axis, "y").toPandas().sort_values(["series_id", "ts"])
    expected = pdf.groupby("series_id")["y"].shift(168)
    np.testing.assert_array_equal(got["predicted"], expected)
    profile = last_season(df, axis, "y")
    horizon = spark.range(400).select(F.lit("a").alias("series_id"), F.col("id").alias("i"))
    tiled = tile_last_season(horizon, profile, ["series_id"], "i").orderBy("i").toPandas()["predicted"]
    tail = pdf[pdf.series_id == "a"]["y"].to_numpy()[-168:]
    np.testing.assert_array_equal(tiled, np.tile(tail, 3)[:400])
    labelled = df.withColumn("split", F.when(F.col("ts") < "2020-01-15", "train").otherwise("val"))
    m = naive_run(labelled, axis, "y", by=["series_id"]).toPandas().set_index("series_id")
    a = pdf[pdf.series_id == "a"].assign(p=lambda d: d["y"].shift(168))
    a = a[a["ts"] >= "2020-01-15"]
    assert m.loc["a", "val_mape"] == pytest.approx(((a["y"] - a["p"]) / a["y"]).abs().mean() * 100)
    hours = hour_profile_baseline(labelled, axis, "y").toPandas()
    train = pdf[(pdf.series_id == "b") & (pdf.ts < "2020-01-15")]
    expected = train.groupby(train["ts"].dt.hour)["y"].mean()
    got = hours[hours.series_id == "b"].groupby(hours["ts"].dt.hour)["predicted"].first()
    np.testing.assert_allclose(got, expected)


def test_registry(spark):
    runs = registry.run_rows(spark, "r1", "naive", "naive", {"val_mape": 5.0, "val_rmse": 9.0, "val_mae": 1.0})
    runs = runs.unionByName(registry.run_rows(spark, "r2", "boost", "boost", {"val_mape": 2.0, "val_rmse": 4.0, "val_mae": 1.0}))
    runs = runs.unionByName(registry.run_rows(spark, "r3", "line", "line", {"val_mape": 2.0, "val_rmse": 3.0, "val_mae": 1.0}))
    for i, v in ((2, 1.5), (1, 0.5), (10, 4.0)):
        runs = runs.unionByName(registry.run_rows(spark, f"f{i}", f"fold_{i}", "boost", {"fold_mape": v}, "r2", i))
    assert [r["run_id"] for r in registry.ranked_runs(runs).collect()] == ["r3", "r2", "r1"]
    folds = registry.fold_rows(runs).collect()
    assert [r["fold"] for r in folds] == [1, 2, 10] and folds[0]["mean"] == pytest.approx(2.0)
    versions = spark.createDataFrame(
        [(1, "r1", "p", "Production"), (2, "r3", "p", "None"), (3, "r3", "p", "None"), (4, "r2", "p", "Staging")],
        registry.VERSION_SCHEMA,
    )
    assert registry.register_version(versions, "r9", "p").first()["version"] == 5
    table = registry.candidates(runs)
    assert {r["run_id"]: r["promoted"] for r in registry.select_model(table, versions).collect()} == {"r3": True, "r2": False, "r1": False}
    stages = {r["version"]: r["stage"] for r in registry.promote(table, versions).collect()}
    assert stages == {1: "Archived", 2: "None", 3: "Production", 4: "Archived"}
    unregistered = versions.where("run_id != 'r3'")
    assert not any(r["promoted"] for r in registry.select_model(table, unregistered).collect())
    assert {r["stage"] for r in registry.promote(table, unregistered).collect()} == {"Production", "Staging"}
    best_in_place = versions.withColumn("stage", F.when(F.col("version") == 3, "Production").otherwise("None"))
    kept = registry.select_model(table, best_in_place, require_improvement=True).collect()
    assert not any(r["promoted"] for r in kept)


def requests(spark):
    rows = [
        ("r1", "a", "2020-01-20 00:00", 24, None, None), ("r2", "a", "2020-01-10 05:00", 6, [1.0] * 6, None),
        ("r3", "b", "2020-01-01 00:00", 1, None, [5.0]), ("r4", "a", "2020-01-20 00:00", 0, None, None),
        ("r5", "a", "2020-01-20 00:00", 169, None, None), ("r6", "a", "2020-01-20 00:00", 4, [1.0], None),
        ("r7", "b", "2020-01-21 00:00", None, None, None),
    ]
    schema = "request_id string, series_id string, start_ts string, horizon int, wind array<double>, solar array<double>"
    return spark.createDataFrame(rows, schema).withColumn("start_ts", F.col("start_ts").cast("timestamp_ntz"))


def test_requests(spark):
    checked = check_requests(requests(spark))
    reasons = {r["request_id"]: r["reject_reason"] for r in rejected_requests(checked).collect()}
    assert set(reasons) == {"r4", "r5", "r6"} and "horizon" in reasons["r5"] and "wind" in reasons["r6"]
    good = valid_requests(checked)
    steps = expand_requests(good, Axis())
    assert steps.groupBy("request_id").count().toPandas().set_index("request_id")["count"].to_dict() == {
        "r1": 24, "r2": 6, "r3": 1, "r7": 24,
    }
    assert [r["wind_mw"] for r in steps.where("request_id = 'r2'").collect()] == [1.0] * 6
    params = FeatureParams(target="y", lags=(1, 24), windows=(6,))
    plain = request_features(good, Axis(), params).toPandas()
    assert (plain["lag_24h"] == 0).all() and len(plain) == 55
    first = plain[(plain.request_id == "r2") & (plain.step_no == 0)].iloc[0]
    assert first["fourier_24h_sin_1"] == 0 and first["hour"] == 5
    assert (plain[plain.request_id == "r3"]["is_holiday"] == 1).all()


def test_request_history(spark):
    _, df = panel(spark)
    params = FeatureParams(target="y", lags=(1, 24), windows=(6,))
    history = history_features(df, Axis(), "y", params.lags, params.windows)
    anchors = df.groupBy("series_id").agg(F.lit(438288).cast("bigint").alias("start_idx"))  # 2020-01-01 00:00 in hours
    good = valid_requests(check_requests(requests(spark)))
    out = request_features(good, Axis(), params, history.drop("y"), anchors).toPandas()
    known = history.toPandas().set_index(["series_id", "ts"])
    row = out[(out.request_id == "r2") & (out.step_no == 3)].iloc[0]
    assert row["lag_24h"] == known.loc[("a", pd.Timestamp("2020-01-10 05:00")), "lag_24h"]
    assert row["fourier_24h_sin_1"] == pytest.approx(np.sin(2 * np.pi * 8 / 24))


def test_few_requests_are_dealt_out_before_they_grow(spark):
    """One file of requests is one task, but its forecast steps must not be."""
    requests = spark.range(64).coalesce(1).selectExpr(
        "id AS request_id", "timestamp_ntz'2024-01-01 00:00:00' AS start_ts", "168 AS horizon",
        "CAST(NULL AS array<double>) AS wind", "CAST(NULL AS array<double>) AS solar",
    )
    steps = expand_requests(requests, Axis()).withColumn("task", F.spark_partition_id())
    per_task = [r["count"] for r in steps.groupBy("task").count().collect()]
    assert sum(per_task) == 64 * 168 and len(per_task) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_rounded_doubles(spark):
    """The quick way of rounding gives what rounding the decimal text gives, ties and odd values included."""
    from gridcast.plans.catalog.base import r4, rounded

    odd = [0.00005, -0.00005, 1.00015, 2.00025, -0.0, 0.0, 1e300, -1e12, 123456.78905, float("inf"), float("nan"), None]
    some = [k / 1e5 for k in range(-2000, 2000)] + [float(x) for x in np.random.default_rng(3).normal(0, 50, 4000)]
    df = spark.createDataFrame([(x,) for x in odd + some], "x double").withColumn("y", F.col("x"))
    got = rounded(df, "x").select("x", r4("y").alias("want"))
    assert got.where("NOT (CAST(x AS string) <=> CAST(want AS string))").count() == 0
