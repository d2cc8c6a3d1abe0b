"""Plan shape: what decides whether the operators hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from gridcast.operators.asof import point_in_time_join
from gridcast.operators.features import build_feature_matrix, history_features
from gridcast.operators.gaps import fill_gaps
from gridcast.operators.grid import make_grid
from gridcast.operators.metrics import forecast_metrics
from gridcast.operators.naive import seasonal_naive
from gridcast.operators.quality import Check, run_checks
from gridcast.operators.quantiles import exact_quantiles
from gridcast.operators import skew
from gridcast.operators.split import walk_forward_folds
from gridcast.params import Axis, FeatureParams
from gridcast.plans.catalog.base import HOURLY, filled, grid, hourly, table

SF = "/root/testdata/sf0.001"
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


OPERATORS = {
    "grid": lambda s: grid(s, SF),
    "fill": lambda s: filled(s, SF, mode="reference"),
    "features": lambda s: history_features(grid(s, SF), HOURLY, "y", [1, 168], [24]),
    "matrix": lambda s: build_feature_matrix(grid(s, SF).withColumnRenamed("y", "load_mw"), HOURLY, FeatureParams()),
    "folds": lambda s: walk_forward_folds(hourly(s, SF), HOURLY, 4),
    "naive": lambda s: forecast_metrics(seasonal_naive(hourly(s, SF), HOURLY, "y"), ["series_id"], "y", "predicted"),
    "asof": lambda s: point_in_time_join(
        table(s, SF, "events").select("user_id", "ts"), table(s, SF, "events").select("user_id", F.col("ts").alias("ft"), "value"),
        ["user_id"], "ts", "ft",
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_single_partition_and_no_python(spark, name):
    text = plan(OPERATORS[name](spark))
    assert "SinglePartition" not in text and not any(p in text for p in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["grid", "fill", "features", "naive"])
def test_windows_are_cut_into_buckets(spark, name):
    """Row-level windows are partitioned by series and time bucket; only windows over edge rows are per series."""
    for window in re.findall(r"windowspecdefinition\((.*?) ASC", plan(OPERATORS[name](spark))):
        assert "_bucket" in window


def test_one_shuffle_for_all_history_features(spark):
    base = grid(spark, SF)
    one = exchanges(history_features(base, HOURLY, "y", [1], [])) - exchanges(base)
    many = exchanges(history_features(base, HOURLY, "y", [1, 2, 24, 168], [6, 24, 168])) - exchanges(base)
    assert one == many == 1


def test_filling_does_not_shuffle_the_grid_again(spark):
    """The grid's partitioning serves the fill's windows and its join; what is added shuffles edge rows only."""
    base = make_grid(hourly(spark, SF), HOURLY, ["y"], keep_helpers=True)
    text = plan(fill_gaps(base, HOURLY, ["y"], keep_helpers=True))
    for columns in re.findall(r"Exchange hashpartitioning\(([^)]*)\), ENSURE_REQUIREMENTS", text):
        assert "_bucket" not in columns


def test_scan_reads_needed_columns_and_pushes_time_filters(spark):
    from gridcast.functions.timegrid import time_slice

    sliced = time_slice(table(spark, SF, "events"), "ts", "2024-01-05", "2024-01-12").select("event_id")
    text = plan(sliced)
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text
    assert "props" not in text.split("ReadSchema")[1] and "value" not in text.split("ReadSchema")[1]


def test_checks_share_one_scan(spark):
    events = table(spark, SF, "events")
    shares = [Check("not_null", c, 0.1) for c in ("ts", "value", "props")] + [Check("between", "value", 0.9, 0, 1)]
    assert plan(run_checks(events, shares)).count("FileScan") == 1


def test_group_join_switches_to_salting(spark, monkeypatch):
    rows = table(spark, SF, "lineitem").select("l_suppkey", F.col("l_extendedprice").alias("v"))
    small = exact_quantiles(rows, ["l_suppkey"], "v", {"m": 0.5}).orderBy("l_suppkey").collect()
    monkeypatch.setattr(skew, "BROADCAST_GROUPS", 0)
    salted = exact_quantiles(rows, ["l_suppkey"], "v", {"m": 0.5})
    assert salted.orderBy("l_suppkey").collect() == small and len(small) > 1


def test_hot_series_and_partition_invariance(spark):
    """A series with most of the rows gives the same result at 1, 7 and 32 partitions and with small buckets."""
    hot = hourly(spark, SF).withColumn("series_id", F.when(F.col("series_id") != "view", "hot").otherwise("view"))
    hot = hot.groupBy("series_id", "ts").agg(F.sum("y").alias("y"))
    results = []
    for n, bucket in ((1, 4096), (7, 200), (32, 24)):
        axis = Axis(bucket=bucket)
        out = fill_gaps(make_grid(hot.repartition(n), axis, ["y"], True), axis, ["y"], 6)
        results.append(out.orderBy("series_id", "ts").collect())
    assert results[0] == results[1] == results[2]
