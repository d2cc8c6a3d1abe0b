"""Header discovery in one job, JSON tables, checks observed on the write, and rolled-up errors."""

import datetime as dt
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators.metrics import forecast_metrics, forecast_metrics_rollup
from gridcast.operators.quality import Check, checks_on_write, run_checks
from gridcast.params import Axis, CleanParams
from gridcast.plans.jobs import ingest
from gridcast.sources import tables
from gridcast.sources.tables import TableLayout, cut, file_headers, read_json, read_raw, write_json


def jobs_of(spark, call):
    """How many Spark jobs a call starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        call()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def write_csv(folder, name, header, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *rows]) + "\n", encoding="utf-8")


def test_headers_of_many_files(spark, tmp_path, monkeypatch):
    folder = tmp_path / "csv"
    for i in range(12):
        order = ("utc_timestamp", "other", '"DE_load_actual_entsoe_transparency"') if i % 2 else ("DE_load_actual_entsoe_transparency", "utc_timestamp")
        values = {"utc_timestamp": f"t{i}", "other": "x", "DE_load_actual_entsoe_transparency": str(i)}
        write_csv(folder, f"f{i:02}.csv", ",".join(order), [",".join(values[c.strip('"')] for c in order)] * 3)
    write_csv(folder, "long.csv", "utc_timestamp,DE_solar_generation_actual", [f"l{j},{j}" for j in range(40_000)])
    (folder / "empty.csv").write_text("")
    monkeypatch.setattr(tables, "HEADER_SPLIT", 64 << 10)  # the long file has several splits
    found = {r["file"].rsplit("/", 1)[1]: r["header"] for r in file_headers(spark, str(folder)).collect()}
    assert len(found) == 13 and found["long.csv"] == "utc_timestamp,DE_solar_generation_actual" and found["f01.csv"].startswith("utc_timestamp,other")
    out = read_raw(spark, str(folder))
    assert set(out.columns) == {"utc_timestamp", "DE_load_actual_entsoe_transparency", "DE_solar_generation_actual"}
    rows = out.where("utc_timestamp LIKE 't%'").groupBy("utc_timestamp").agg(F.max("DE_load_actual_entsoe_transparency").alias("v"), F.count("*").alias("n")).collect()
    assert {(r["utc_timestamp"], r["v"], r["n"]) for r in rows} == {(f"t{i}", str(i), 3) for i in range(12)}
    assert out.where("DE_solar_generation_actual IS NOT NULL").count() == 40_000
    few, many = tmp_path / "few", tmp_path / "many"
    for place, n in ((few, 2), (many, 30)):
        for i in range(n):
            write_csv(place, f"{i}.csv", "utc_timestamp,DE_load_actual_entsoe_transparency", ["a,1"])
    assert jobs_of(spark, lambda: read_raw(spark, str(many))) == jobs_of(spark, lambda: read_raw(spark, str(few)))


def test_json_table_round_trip(spark, tmp_path):
    rows = [
        ("a", (dt.datetime(2024, 1, 1, 0, 0, 0, 123456), dt.datetime(2024, 1, 2)), [("x", 1), ("y", None)], {"k": 1.5}),
        ("b", (None, None), [], {}), ("ü\n\"q\"", None, None, None),
    ]
    schema = "id string, span struct<first: timestamp_ntz, last: timestamp>, items array<struct<n: string, v: bigint>>, m map<string, double>"
    df = spark.createDataFrame(rows, schema)
    write_json(df, str(tmp_path / "j"))
    assert sorted(map(str, read_json(spark, str(tmp_path / "j"), schema).collect())) == sorted(map(str, df.collect()))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.json").write_text('{"id": 1, "span"\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_json(spark, str(tmp_path / "bad"), schema).collect()


CHECKS = [
    Check("exists", "v"), Check("exists", "nope"), Check("not_null", "v", 0.3), Check("not_null", "nope", 0.3), Check("between", "v", 0.99, 0.0, 10.0),
    Check("unique", "k"), Check("unique", "nope"), Check("row_count", limit=5),
]


@pytest.mark.parametrize("rows", [[(1, 1.0), (2, 2.0), (2, None), (4, 30.0)], [], [(None, None)] * 6])
def test_observed_checks_equal_the_plain_ones(spark, rows):
    df = spark.createDataFrame(rows, "k int, v double")
    stored, results = checks_on_write(df, CHECKS, cut)
    assert sorted(map(str, results.collect())) == sorted(map(str, run_checks(df, CHECKS).collect()))
    assert stored.count() == len(rows)


def test_checks_read_the_rows_once(spark):
    passes = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            passes.add(len(b))
            yield b

    df = spark.range(1000).selectExpr("cast(id as int) AS k", "cast(id as double) AS v").mapInPandas(counted, "k int, v double")
    _, results = checks_on_write(df, CHECKS, cut)
    results.collect()
    assert passes.value == 1000


def test_ingest_reads_raw_rows_once(spark, tmp_path, raw_readings):
    passes = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            passes.add(len(b))
            yield b

    raw = spark.createDataFrame(raw_readings.astype(str))
    layout = TableLayout(str(tmp_path / "t"))
    checks = [Check("exists", "utc_timestamp"), Check("unique", "utc_timestamp"), Check("row_count", limit=1000)]
    out = ingest(raw.mapInPandas(counted, raw.schema), Axis(), layout, CleanParams(), checks)
    assert out.count() == len(raw_readings) and passes.value == len(raw_readings)
    twice = raw.unionByName(raw.limit(1))
    with pytest.raises(Exception, match="hard quality checks failed: unique:utc_timestamp"):
        ingest(twice, Axis(), TableLayout(str(tmp_path / "u")), CleanParams(), checks)
    with pytest.raises(ValueError, match="exists:utc_timestamp"):
        ingest(raw.drop("utc_timestamp"), Axis(), TableLayout(str(tmp_path / "v")), CleanParams(), checks)


def test_rollup_levels(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"s": rng.choice(["a", "b", None], 300), "m": rng.choice(["x", "y"], 300), "y": rng.integers(0, 5, 300).astype(float), "p": rng.normal(2, 1, 300)})
    df = spark.createDataFrame(pdf)
    out = forecast_metrics_rollup(df, ["s", "m"], "y", "p").collect()
    assert len(out) == 6 + 3 + 1
    for level, by in ((0, ["s", "m"]), (1, ["s"]), (2, [])):
        want = {tuple(r[c] for c in by): r for r in forecast_metrics(df, by, "y", "p").collect()}
        got = {tuple(r[c] for c in by): r for r in out if r["level"] == level}
        assert got.keys() == want.keys()
        for k, r in got.items():
            assert r["n"] == want[k]["n"] and all(r[m] == pytest.approx(want[k][m]) for m in ("mape", "rmse", "mae"))
    assert forecast_metrics_rollup(df.where("false"), ["s"], "y", "p").count() == 0


def test_layout_partitions_by_month(spark, tmp_path):
    layout = TableLayout(str(tmp_path / "tables"))
    rows = [("a", dt.datetime(2019, m, 1 + m), 7, float(m)) for m in range(1, 7)] + [("a", None, 0, None)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, month int, y double")
    back = layout.save(df, "features")
    assert back.columns == df.columns and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert len(list((tmp_path / "tables" / "04_feature" / "features").glob("part_month=2019-*"))) == 6
    some = layout.read(spark, "features", months=("2019-02", "2019-04"))
    assert sorted(r["y"] for r in some.collect()) == [2.0, 3.0, 4.0]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part_month" in plan.split("PartitionFilters")[1]
    layout.append(spark.createDataFrame([("r", "n", "t", None, None, "m", 1.0, None)], "run_id string, run_name string, model_type string, parent_run_id string, fold_index int, metric string, value double, data_hash string"), "runs")
    assert layout.read(spark, "runs").count() == 1
    with pytest.raises(ValueError, match="appended"):
        layout.append(df, "run_info")
    assert layout.read_or_empty(spark, "model_versions", "version int").count() == 0
