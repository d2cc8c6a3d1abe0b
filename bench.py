"""Time the headline queries: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from gridcast.plans.catalog import QUERIES

HEADLINE = [
    "complete_grid_by_user", "fill_gap_starts_by_user", "refill_limited_by_user", "rolling_features_by_user",
    "lag_features_by_type", "feature_matrix", "calendar_features", "quartile_fences", "remove_outliers_by_fences",
    "forecast_errors_by_user", "split_conformal_offsets", "adaptive_conformal_by_user", "drift_distances",
    "drift_distances_by_series", "point_in_time_features", "latest_values", "quality_checks", "lag_autocorrelation",
    "exact_price_quantiles", "describe_prices", "monthly_concept_drift", "expanding_folds", "boosted_forecast",
    "streamed_hourly_series",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    QUERIES["latest_values"](spark, sf).write.format("noop").mode("overwrite").save()  # warm up the JVM
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
