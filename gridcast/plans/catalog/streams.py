"""Streaming jobs run to the end of the available data. SQL twins state what a complete run must give."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcast.operators.quality import Check
from gridcast.plans.catalog.base import query, rounded, sql_hourly, sql_r4, table, with_
from gridcast.plans.catalog.calibration import scored, sql_adaptive, sql_scored
from gridcast.sources.tables import cut, shared_folder
from gridcast.streaming.jobs import (
    adaptive_conformal_stream, error_monitor_stream, hourly_series_stream, latest_table_stream, quality_gate_stream, read_latest_table, run_to_end,
)


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/gridcast/{name}-{uuid.uuid4().hex}"


def _events(spark, sf):
    """The events table as a file stream; its time column becomes the event time."""
    schema = table(spark, sf, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return files.withColumn("ts", F.col("ts").cast("timestamp"))


def _run_to_end(source, transform, spark, name: str):
    """Append to a table until the input is used up and all windows are emitted, then read the table."""
    path = _folder(spark, name)
    run_to_end(source, "ts", transform, path, _folder(spark, "ckpt"), _folder(spark, "closing"))
    return spark.read.schema(transform(source).schema).parquet(path)


@query(
    with_(sql_hourly())
    + "SELECT p.series_id, p.ts, p.y, c.n AS n_events FROM panel p JOIN "
    "(SELECT event_type, date_trunc('hour', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2) c ON c.event_type = p.series_id AND c.ts = p.ts "
)
def streamed_hourly_series(spark, sf):
    """Every hour of the finite stream, the last ones emitted by a closing micro-batch."""
    events = _events(spark, sf).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    out = _run_to_end(events, lambda rows: hourly_series_stream(rows, "ts", "event_type", "cents", "event_id"), spark, "hours")
    return out.select("series_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("y").cast("double").alias("y"), "n_events")


@query(
    "SELECT user_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events) WHERE r = 1"
)
def streamed_latest_values(spark, sf):
    path = _folder(spark, "latest")
    rows = _events(spark, sf).select("user_id", "ts", "event_type", "value")
    latest_table_stream(rows, path, _folder(spark, "ckpt"), ["user_id"], "ts").awaitTermination()
    return read_latest_table(spark, path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT event_id, value FROM events")
def streamed_quality_gate(spark, sf):
    """Micro-batches whose hard checks hold end in the good table."""
    good, bad, results = (_folder(spark, n) for n in ("good", "bad", "results"))
    checks = [Check("unique", "event_id"), Check("not_null", "value", 0.02), Check("row_count", limit=1)]
    events, keys = _events(spark, sf), _folder(spark, "keys")
    quality_gate_stream(events, checks, good, bad, results, _folder(spark, "ckpt"), ["event_id"], keys).awaitTermination()
    return spark.read.parquet(good).select("event_id", "value")


@query(
    with_(
        sql_scored(),
        "d AS (SELECT series_id, CAST(ts AS DATE)::TIMESTAMP AS span_start, avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 AS mape FROM scored GROUP BY 1, 2)",
        "b AS (SELECT series_id, avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 AS baseline_mape FROM scored GROUP BY 1)",
    )
    + f"SELECT series_id, span_start, {sql_r4('mape')} AS mape, {sql_r4('baseline_mape')} AS baseline_mape, mape > baseline_mape * 1.5 AS drift_flag "
    "FROM d JOIN b USING (series_id)"
)
def streamed_error_monitor(spark, sf):
    """Daily error per series against its overall error."""
    rows = scored(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    path = _folder(spark, "scored")
    rows.write.parquet(path)
    error = F.when(F.col("y") != 0, F.abs((F.col("y") - F.col("predicted")) / F.col("y")))
    baseline = cut(spark.read.parquet(path).groupBy("series_id").agg((F.avg(error) * 100).alias("baseline_mape")))
    stream = spark.readStream.schema(rows.schema).parquet(path)
    out = _run_to_end(stream, lambda rows: error_monitor_stream(rows, baseline, ["series_id"], "ts", "y", "predicted"), spark, "monitor")
    out = out.withColumn("span_start", F.col("span_start").cast("timestamp_ntz"))
    return rounded(out, "mape", "baseline_mape")


@query(
    with_(sql_scored(), sql_adaptive()).replace("WITH ", "WITH RECURSIVE ", 1)
    + f"SELECT series_id, ts, y, y_lower, y_upper, {sql_r4('q')} AS q, hit, FALSE AS late FROM adapted"
)
def streamed_adaptive_intervals(spark, sf):
    """Adaptive intervals with state kept per series, rows put in time order by the watermark; the state store must be
    RocksDB for this one."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    rows = scored(spark, sf).select("series_id", F.col("ts").cast("timestamp").alias("ts"), "y", "y_lower", "y_upper")
    path = _folder(spark, "raw-intervals")
    rows.write.parquet(path)
    spark.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(rows.schema).parquet(path)
        out = _run_to_end(stream, lambda rows: adaptive_conformal_stream(rows, ["series_id"], "ts", delay="2 hours"), spark, "intervals")
        return rounded(out.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "q")
    finally:
        spark.conf.set(setting, before)
