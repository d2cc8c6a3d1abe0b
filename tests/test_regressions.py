"""Faults that the SQL twins don't reach."""

import pandas as pd
import pytest
from pyspark.errors import AnalysisException

from gridcast.functions.calendar import holiday_table
from gridcast.operators.cleaning import normalise_columns
from gridcast.operators.drift import monitored_columns
from gridcast.operators.grid import make_grid
from gridcast.operators.quantiles import exact_quantiles
from gridcast.params import Axis
from gridcast.sources.tables import read_raw
from gridcast.streaming.jobs import read_latest_table


def test_csv_files_with_other_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("utc_timestamp,DE_load_actual_entsoe_transparency,DE_wind_generation_actual\nt1,1,2\n")
    (tmp_path / "b.csv").write_text("DE_wind_generation_actual,x,utc_timestamp,DE_load_actual_entsoe_transparency\n4,z,t2,3\n")
    rows = read_raw(spark, str(tmp_path)).toPandas().sort_values("utc_timestamp")
    assert rows["DE_load_actual_entsoe_transparency"].tolist() == ["1", "3"]
    assert rows["DE_wind_generation_actual"].tolist() == ["2", "4"]


def test_null_group_keeps_its_quantiles(spark):
    frame = pd.DataFrame({"k": ["a"] * 5 + [None] * 5, "v": [1.0, 2, 3, 4, 5, 10, 20, 30, 40, 50]})
    got = {r.k: r.m for r in exact_quantiles(spark.createDataFrame(frame, "k string, v double"), ["k"], "v", {"m": 0.5}).collect()}
    assert got == {"a": 3.0, None: 30.0}


def test_holidays_of_one_country(spark):
    days = spark.createDataFrame([("2024-01-01", "DE"), ("2024-07-04", "US")], "date string, country string")
    assert [r.date for r in holiday_table(spark, "DE", days).collect()] == ["2024-01-01"]


def test_all_matching_columns_are_monitored(spark):
    names = [f"lag_{i}h" for i in range(20)] + ["hour", "y"]
    assert monitored_columns(spark.createDataFrame([tuple([1.0] * 22)], names), "y") == names[:-1]


def test_another_time_zone_raises(spark):
    df = spark.createDataFrame([("a", "2020-01-01T00:00:00Z", 1.0)], "series_id string, utc_timestamp string, y double")
    parsed = normalise_columns(df, {"utc_timestamp": "ts", "y": "y"}, keep=["series_id"])
    for zone in ("Europe/London", "Europe/Berlin", "+01:00"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            for call in (lambda: normalise_columns(df, {"utc_timestamp": "ts", "y": "y"}), lambda: make_grid(parsed, Axis())):
                with pytest.raises(ValueError, match="time zone"):
                    call()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert make_grid(parsed, Axis()).count() == 1


def test_broken_snapshot_table_is_not_taken_for_none(spark, tmp_path):
    assert read_latest_table(spark, str(tmp_path / "none")) is None
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(AnalysisException):
        read_latest_table(spark, str(tmp_path / "other"))
