"""Sources, sinks, projections and filters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcast.functions.timegrid import in_slice, month_text, number, time_slice, utc_time
from gridcast.operators.asof import lookup_latest, materialize_latest
from gridcast.operators.cleaning import enforce_non_negative, normalise_columns
from gridcast.operators.features import history_features
from gridcast.operators.grid import make_grid
from gridcast.operators.profile import in_year, profile_nulls
from gridcast.operators.split import (
    assign_split, features_and_target, fingerprint, split_metadata, split_overlap, split_part,
)
from gridcast.params import Axis
from gridcast.plans.catalog.base import (
    SPLIT, daily, filled, grid, hourly, query, rounded, sql_filled, sql_grid, sql_hourly, sql_r4, sql_split,
    table, with_, SQL_DAILY,
)
from gridcast.plans.catalog.features import LAGS, WINDOWS, _WINDOW, sql_lags, sql_rolling
from gridcast.sources.tables import (
    CONTRACT_FIELDS, append_rows, contract_v1, enforce_contract, publish_features, read_json, read_raw, shared_folder, write_json,
    write_panel, write_report,
)


def _scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/gridcast/{name}-{uuid.uuid4().hex}"


RAW_WIDE = """wide AS (
  SELECT date_trunc('hour', ts) AS ts,
    CAST(SUM(CASE WHEN event_type IN ('view', 'error') THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS load_mw,
    CAST(SUM(CASE WHEN event_type IN ('click', 'signup') THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS wind_mw,
    CAST(SUM(CASE WHEN event_type NOT IN ('view', 'error', 'click', 'signup') THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS solar_mw
  FROM events GROUP BY 1)"""


def raw_wide(spark, sf):
    """Hourly events laid out like a raw readings file: text time in ISO form, every event in one of three value columns."""
    events = table(spark, sf, "events")
    kind = F.col("event_type")
    columns = {
        "DE_load_actual_entsoe_transparency": kind.isin("view", "error"),
        "DE_wind_generation_actual": kind.isin("click", "signup"),
        "DE_solar_generation_actual": ~kind.isin("view", "error", "click", "signup"),
    }
    amount = F.round(F.col("value") * 100).cast("bigint")
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc_timestamp")
    return events.groupBy(hour).agg(
        *[F.sum(F.when(belongs, amount)).cast("double").alias(c) for c, belongs in columns.items()],
        F.count(F.lit(1)).alias("AT_load_actual"),
    )


@query(with_(RAW_WIDE) + "SELECT ts, load_mw, wind_mw, solar_mw FROM wide")
def raw_csv_scan(spark, sf):
    """Raw CSV written from events, scanned with an explicit schema, renamed, parsed and pruned."""
    path = _scratch(spark, "raw")
    raw_wide(spark, sf).write.option("header", True).csv(path)
    out = normalise_columns(read_raw(spark, path))
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(with_(sql_hourly()) + "SELECT series_id, ts, y FROM panel WHERE series_id = 'view' AND ts < TIMESTAMP '2024-01-15'")
def parquet_series_scan(spark, sf):
    """Panel written by series, read back for one series and a time range."""
    path = _scratch(spark, "panel")
    write_panel(hourly(spark, sf), path)
    back = spark.read.parquet(path)
    kept = (F.col("series_id") == "view") & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    return back.where(kept).select("series_id", "ts", "y")


@query(with_(SQL_DAILY) + "SELECT series_id, ts, y FROM panel WHERE strftime(ts, '%Y-%m') BETWEEN '1996-03' AND '1996-08'")
def parquet_month_scan(spark, sf):
    """Panel written by month; the month filter prunes partitions."""
    path = _scratch(spark, "months")
    write_panel(daily(spark, sf), path, by_month=True)
    return spark.read.parquet(path).where(F.col("month").between("1996-03", "1996-08")).select("series_id", "ts", "y")


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def csv_report(spark, sf):
    """Flat result table written as one CSV with a header and read back with its schema."""
    path = _scratch(spark, "csv")
    result = table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("total")
    )
    write_report(result, path, "csv")
    return spark.read.option("header", True).schema(result.schema).csv(path)


@query("SELECT event_type, to_json({'event_type': event_type, 'n': count(*)}) AS report FROM events GROUP BY event_type")
def json_report(spark, sf):
    """One JSON text per group."""
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("event_type", F.to_json(F.struct("event_type", "n")).alias("report"))


USER_JSON = "series_id STRING, span STRUCT<first: TIMESTAMP_NTZ, last: TIMESTAMP_NTZ>, types ARRAY<STRUCT<event_type: STRING, n: BIGINT>>"


@query(
    "SELECT CAST(user_id AS VARCHAR) AS series_id, event_type, count(*) AS n, min(min(ts)) OVER (PARTITION BY user_id) AS first, "
    "max(max(ts)) OVER (PARTITION BY user_id) AS last FROM events GROUP BY user_id, event_type"
)
def json_dataset(spark, sf):
    """A nested table stored as JSON lines and read back with its schema: one object per user, with a span and counts by type."""
    path = _scratch(spark, "json")
    counts = table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("series_id"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    types = F.array_sort(F.collect_list(F.struct("event_type", "n")))  # one entry an event type
    objects = counts.groupBy("series_id").agg(F.struct(F.min("first").alias("first"), F.max("last").alias("last")).alias("span"), types.alias("types"))
    write_json(objects, path)
    back = read_json(spark, path, USER_JSON).select("series_id", "span.*", F.inline("types"))
    return back.select("series_id", "event_type", "n", "first", "last")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_decode(spark, sf):
    parsed = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events").select("event_id", parsed.alias("k"))


@query("SELECT o_orderstatus AS model, count(*) AS n, CAST(min(o_orderkey) AS BIGINT) AS first_key FROM orders GROUP BY 1")
def append_run_table(spark, sf):
    """Rows appended to one table, a write for each status there is, and read back together."""
    path = _scratch(spark, "runs")
    orders = table(spark, sf, "orders")
    for (status,) in orders.select("o_orderstatus").distinct().collect():  # a few statuses
        part = orders.where(F.col("o_orderstatus").eqNullSafe(F.lit(status))).groupBy(F.col("o_orderstatus").alias("model")).agg(
            F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key")
        )
        append_rows(part, path)
    return spark.read.schema("model string, n bigint, first_key bigint").parquet(path)


@query(with_(sql_hourly()) + "SELECT ts AS timestamp, y, series_id, 'DE' AS grid_zone FROM panel")
def publish_feature_rows(spark, sf):
    return publish_features(hourly(spark, sf), "ts").select("timestamp", "y", "series_id", "grid_zone")


_ROLLED = [c for c in CONTRACT_FIELDS if c.startswith("rolling_")]


@query(
    with_(RAW_WIDE, "panel AS (SELECT 'DE' AS series_id, ts, load_mw AS y FROM wide)", sql_grid())
    + "SELECT g.series_id AS grid_zone, g.ts AS timestamp, y AS load_mw, w.wind_mw, w.solar_mw, "
    + ", ".join(c for c in CONTRACT_FIELDS if c.startswith(("lag_", "rolling_")))
    + f" FROM (SELECT *, {sql_lags()}, {sql_rolling()} FROM grid {_WINDOW}) g LEFT JOIN wide w USING (ts)"
)
def feature_contract(spark, sf):
    """Load, wind, solar and the load's lags and rolling statistics, cast and ordered to the version 1 contract."""
    wide = normalise_columns(raw_wide(spark, sf)).withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("grid_zone", F.lit("DE"))
    axis = Axis(keys=("grid_zone",))
    rows = history_features(make_grid(wide, axis, ["load_mw", "wind_mw", "solar_mw"]), axis, "load_mw", LAGS, WINDOWS)
    rows = rounded(publish_features(rows, "ts", "grid_zone", None), *_ROLLED)
    return enforce_contract(rows, contract_v1(), allow_extra=True)  # the longest window's deviation isn't in version 1


_LATEST = """latest AS (
  SELECT user_id, ts, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25') WHERE r = 1)"""


def _latest(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_type", "value")
    return materialize_latest(events, ["user_id"], "ts", "2024-01-03", "2024-01-25")


@query(with_(_LATEST) + "SELECT * FROM latest")
def latest_values(spark, sf):
    return _latest(spark, sf)


@query(
    with_(_LATEST)
    + "SELECT c.c_custkey, l.ts, l.event_type, l.value FROM customer c LEFT JOIN latest l ON l.user_id = c.c_custkey"
)
def latest_lookup(spark, sf):
    """Latest event per customer by the online-lookup join; customers without events get nulls."""
    asked = table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").alias("user_id"))
    return lookup_latest(asked, _latest(spark, sf), ["user_id"]).select("c_custkey", "ts", "event_type", "value")


@query(
    "SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value END AS value FROM events"
)
def numeric_coercion(spark, sf):
    """Text that is no number, and NaN, become NULL."""
    text = F.when(F.col("event_type") == "error", "n/a").when(F.col("event_type") == "signup", "NaN").otherwise(
        F.col("value").cast("string")
    )
    return table(spark, sf, "events").select("event_id", number(text).alias("value"))


@query("SELECT event_id, date_trunc('second', ts) + INTERVAL 1 HOUR AS utc_ts FROM events")
def utc_parse(spark, sf):
    """Text times with an offset, read as UTC."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-01:00"))
    return table(spark, sf, "events").select("event_id", utc_time(text).cast("timestamp_ntz").alias("utc_ts"))


@query(
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS wind_mw, "
    "c_acctbal AS load_mw FROM customer"
)
def clip_negative_generation(spark, sf):
    """Generation columns clipped at zero, nulls kept, load untouched."""
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("wind_mw"),
        F.col("c_acctbal").alias("load_mw"),
    )
    return enforce_non_negative(rows, ["wind_mw"])


@query("SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12 00:00:00'")
def closed_time_slice(spark, sf):
    return time_slice(table(spark, sf, "events"), "ts", "2024-01-05", "2024-01-12")


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-13'")
def whole_day_time_slice(spark, sf):
    return time_slice(table(spark, sf, "events"), "ts", "2024-01-05", "2024-01-12", end_inclusive_day=True)


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE year(o_orderdate) = 1997")
def year_filter(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where(in_year(F.col("o_orderdate"), 1997)).select("o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders "
    "WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1998-02' AND '1998-05'"
)
def month_filter(spark, sf):
    orders = table(spark, sf, "orders")
    start, end = (F.lit(d).cast(orders.schema["o_orderdate"].dataType) for d in ("1998-02-01", "1998-06-01"))
    inside = orders.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))  # a range reaches the scan
    return inside.select("o_orderkey", month_text(F.col("o_orderdate")).alias("month"))


@query(
    with_(sql_hourly(), sql_grid())
    + "SELECT count(*) AS n_rows, count(y) AS complete_all, count(*) AS complete_chosen, count(*) AS known_series_id, "
    "count(*) AS known_ts FROM grid"
)
def null_profile(spark, sf):
    """Rows that survive dropping nulls over all columns and over chosen ones."""
    return profile_nulls(grid(spark, sf), ["series_id", "ts"])


@query(with_(sql_hourly(), sql_grid()) + "SELECT series_id, ts, y FROM grid WHERE y IS NOT NULL")
def drop_null_targets(spark, sf):
    return grid(spark, sf).dropna(subset=["y"])


@query(with_(sql_hourly()) + f"SELECT series_id, ts, y, {sql_split()} AS split FROM panel")
def chronological_split(spark, sf):
    return assign_split(hourly(spark, sf), "ts", SPLIT)


@query(
    with_(sql_hourly(), f"s AS (SELECT *, {sql_split()} AS split FROM panel)")
    + "SELECT "
    + ", ".join(
        f"CAST(min(ts) FILTER (split = '{p}') AS VARCHAR) AS {p}_start, CAST(max(ts) FILTER (split = '{p}') AS VARCHAR) AS {p}_end, "
        f"count(*) FILTER (split = '{p}') AS n_{p}"
        for p in ("train", "val", "test")
    )
    + ", 1 AS n_features FROM s"
)
def split_bounds(spark, sf):
    """Split metadata without the fingerprint (which has no SQL counterpart)."""
    meta = split_metadata(assign_split(hourly(spark, sf), "ts", SPLIT), "ts", "y")
    return meta.drop("train_data_hash", "feature_columns").withColumn("n_features", F.col("n_features").cast("int"))


@query(
    with_(sql_hourly(),
          f"h AS (SELECT CAST('0x' || substr(md5(concat_ws('|', series_id, ts, CAST(y AS BIGINT))), 1, 15) AS BIGINT) AS h FROM panel WHERE {sql_split()} = 'train')")
    + "SELECT md5(concat_ws('|', count(*), sum(h), bit_xor(h))) AS fingerprint FROM h"
)
def training_fingerprint(spark, sf):
    """Over whole cents, whose text doesn't depend on how an engine prints fractions."""
    train = split_part(assign_split(hourly(spark, sf), "ts", SPLIT), "train")
    return fingerprint(train.select("series_id", "ts", F.col("y").cast("bigint").alias("y")))


@query(with_(sql_hourly()) + "SELECT 0 AS shared_keys, count(*) AS total_rows FROM panel")
def split_disjointness(spark, sf):
    """No (series, time) occurs in two parts, and the parts together hold every row."""
    return split_overlap(assign_split(hourly(spark, sf), "ts", SPLIT), ["series_id", "ts"])


@query(with_(sql_hourly()) + "SELECT series_id, ts FROM panel")
def feature_projection(spark, sf):
    return features_and_target(hourly(spark, sf), "y")[0]


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def distinct_years(spark, sf):
    return table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()


@query(
    with_(sql_hourly())
    + "SELECT CAST(count(*) FILTER (a) AS BIGINT) AS in_reference, CAST(count(*) FILTER (b) AS BIGINT) AS in_window FROM "
    "(SELECT ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-10' AS a, ts BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-20' AS b FROM panel)"
)
def overlapping_windows(spark, sf):
    """A row may belong to the reference and to a window at once."""
    panel = hourly(spark, sf)
    flags = {"in_reference": ("2024-01-01", "2024-01-10"), "in_window": ("2024-01-08", "2024-01-20")}
    return panel.agg(*[F.count_if(in_slice(F.col("ts"), "timestamp_ntz", *span)).alias(n) for n, span in flags.items()])


@query(
    with_(sql_filled())
    + f"SELECT series_id, CAST(count(*) AS BIGINT) AS n, {sql_r4('avg(y)')} AS mean FROM filled GROUP BY 1"
)
def filled_series_summary(spark, sf):
    return rounded(
        filled(spark, sf).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean")), "mean"
    )
