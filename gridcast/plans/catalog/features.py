"""Lags, rolling statistics, calendar, Fourier terms, folds, naive forecasts and point-in-time retrieval."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridcast.functions.calendar import add_calendar, national_holidays
from gridcast.functions.timegrid import floor_time
from gridcast.operators.asof import entities_without_features, point_in_time_join
from gridcast.operators.buckets import dense_index
from gridcast.operators.drift import monitored_columns
from gridcast.operators.features import (
    build_feature_matrix, feature_names, fourier_features, history_features, lag_by_join, lag_features, rolling_features,
)
from gridcast.operators.naive import hour_profile_baseline, last_season, seasonal_naive, tile_last_season
from gridcast.operators.requests import check_requests, expand_requests, request_features, valid_requests
from gridcast.operators.quantiles import unpivot
from gridcast.operators.split import assign_split, split_part, walk_forward_folds
from gridcast.params import FeatureParams
from gridcast.plans.catalog.base import (
    HOURLY, SPLIT, filled, grid, hourly, query, r4, rounded, sql_filled, sql_grid, sql_hourly, sql_r4, sql_split, table, with_,
)
from gridcast.sources.tables import cut

LAGS, WINDOWS = (1, 2, 3, 6, 12, 24, 48, 168), (6, 12, 24, 168)
PARAMS = FeatureParams(target="y")


def sql_lags(lags=LAGS) -> str:
    return ", ".join(f"lag(y, {h}) OVER w AS lag_{h}h" for h in lags)


def sql_rolling(windows=WINDOWS, digits: bool = True) -> str:
    parts = []
    for n in windows:
        frame = f"(PARTITION BY series_id ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        for name, fn in (("mean", "avg"), ("std", "stddev_samp")):
            value = f"CASE WHEN count(y) OVER {frame} >= {n // 2} THEN {fn}(y) OVER {frame} END"
            parts.append(f"{sql_r4(value) if digits else value} AS rolling_{name}_{n}h")
    return ", ".join(parts)


_WINDOW = " WINDOW w AS (PARTITION BY series_id ORDER BY ts)"


@query(with_(sql_filled()) + f"SELECT series_id, ts, y, {sql_lags()} FROM filled" + _WINDOW)
def lag_features_by_type(spark, sf):
    return lag_features(filled(spark, sf), HOURLY, "y", LAGS)


@query(with_(sql_hourly("user_id"), sql_grid()) + f"SELECT series_id, ts, {sql_rolling()} FROM grid" + _WINDOW)
def rolling_features_by_user(spark, sf):
    """Rolling statistics over sparse series: nulls are skipped, and half a window of known values is needed."""
    out = rolling_features(grid(spark, sf, "user_id"), HOURLY, "y", WINDOWS).drop("y")
    return rounded(out, *[c for c in out.columns if c.startswith("rolling_")])


@query(
    with_(sql_filled())
    + "SELECT f.series_id, f.ts, f.y, e.y AS lag_24h FROM filled f LEFT JOIN filled e "
    "ON e.series_id = f.series_id AND e.ts = f.ts - INTERVAL 24 HOUR"
)
def lag_as_time_join(spark, sf):
    return lag_by_join(filled(spark, sf), HOURLY, "y", 24)


# Easter Sundays of the order years, to state the holidays in SQL.
_EASTER = ("1995-04-16", "1996-04-07", "1997-03-30", "1998-04-12", "1999-04-04", "2000-04-23", "2001-04-15")
_HOLIDAYS = (
    "holidays AS (SELECT unnest([e - 2, e + 1, e + 39, e + 50, make_date(y, 1, 1), make_date(y, 5, 1), make_date(y, 10, 3), "
    "make_date(y, 12, 25), make_date(y, 12, 26)]) AS day FROM (SELECT d AS e, year(d) AS y FROM (SELECT unnest(["
    + ", ".join(f"DATE '{d}'" for d in _EASTER)
    + "]) AS d)))"
)
SQL_CALENDAR = """CAST(hour({t}) AS INTEGER) AS hour, CAST(isodow({t}) - 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear({t}) AS INTEGER) AS day_of_year, CAST(month({t}) AS INTEGER) AS month,
  CAST(week({t}) AS INTEGER) AS week_of_year, CASE WHEN isodow({t}) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CAST((month({t}) % 12) // 3 AS INTEGER) AS season"""


@query(
    with_(_HOLIDAYS)
    + "SELECT o_orderkey, "
    + SQL_CALENDAR.format(t="o_orderdate")
    + ", CASE WHEN h.day IS NULL THEN 0 ELSE 1 END AS is_holiday, "
    "CASE WHEN isodow(o_orderdate) < 6 AND h.day IS NULL THEN 1 ELSE 0 END AS is_working_day "
    "FROM orders LEFT JOIN holidays h ON h.day = CAST(o_orderdate AS DATE)"
)
def calendar_features(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return add_calendar(orders, "o_orderdate", national_holidays(spark)).drop("o_orderdate")


@query(
    with_(_HOLIDAYS)
    + "SELECT h.day AS date, count(*) AS orders FROM orders JOIN holidays h ON h.day = CAST(o_orderdate AS DATE) GROUP BY 1"
)
def orders_on_holidays(spark, sf):
    """The generated holiday table itself, as a filter."""
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    hits = days.join(F.broadcast(national_holidays(spark)), "date")  # about a thousand rows
    return hits.groupBy("date").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "SELECT event_id, "
    + SQL_CALENDAR.format(t="ts")
    + ", 0 AS is_holiday, CASE WHEN isodow(ts) < 6 THEN 1 ELSE 0 END AS is_working_day FROM events"
)
def calendar_features_compat(spark, sf):
    """Compatibility value: no holidays at all."""
    return add_calendar(table(spark, sf, "events").select("event_id", "ts"), "ts", None).drop("ts")


def sql_fourier(clock: str, periods=(24, 168), order=3) -> str:
    return ", ".join(
        f"{sql_r4(f'{f}({2 * math.pi * k / p!r}e0 * ({clock} % {p}))')} AS fourier_{p}h_{f}_{k}"
        for p in periods
        for k in range(1, order + 1)
        for f in ("sin", "cos")
    )


_CLOCK = "c AS (SELECT *, date_diff('hour', min(ts) OVER (PARTITION BY series_id), ts) AS t FROM panel)"


@query(with_(sql_hourly("user_id"), _CLOCK) + f"SELECT series_id, ts, {sql_fourier('t')} FROM c")
def fourier_terms(spark, sf):
    out = fourier_features(hourly(spark, sf, "user_id"), HOURLY, (24, 168), 3).drop("y")
    return rounded(out, *[c for c in out.columns if c.startswith("fourier_")])


_MATRIX = f"""m AS (
  SELECT series_id, ts, y, {sql_lags()}, {sql_rolling()}, {SQL_CALENDAR.format(t="ts")},
    CASE WHEN CAST(ts AS DATE) = DATE '2024-01-01' THEN 1 ELSE 0 END AS is_holiday,
    CASE WHEN isodow(ts) < 6 AND CAST(ts AS DATE) <> DATE '2024-01-01' THEN 1 ELSE 0 END AS is_working_day,
    {sql_fourier('i')} FROM filled {_WINDOW})"""


@query(
    with_(sql_filled(), _MATRIX)
    + "SELECT * FROM m WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in ["y", *[f"lag_{h}h" for h in LAGS], *[f"rolling_{s}_{w}h" for w in WINDOWS for s in ("mean", "std")]])
)
def feature_matrix(spark, sf):
    """All 37 features of the default parameters, incomplete rows dropped."""
    out = build_feature_matrix(filled(spark, sf), HOURLY, PARAMS)
    digits = [c for c in feature_names(PARAMS) if c.startswith(("rolling_", "fourier_"))]
    return rounded(out, *digits)


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in ["y", *[f"lag_{h}h" for h in LAGS], *[f"rolling_{s}_{w}h" for w in WINDOWS for s in ("mean", "std")]])
_MONITORED = [*[f"lag_{h}h" for h in LAGS], *[f"rolling_{s}_{w}h" for w in WINDOWS for s in ("mean", "std")], "hour", "day_of_week", "is_working_day"]


@query(
    with_(sql_filled(), _MATRIX, f"kept AS (SELECT * FROM m WHERE {_COMPLETE})")
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n, {sql_r4(f'avg({c})')} AS mean, {sql_r4(f'CAST(max({c}) AS DOUBLE)')} AS largest FROM kept" for c in _MONITORED)
)
def monitored_features(spark, sf):
    """What drift monitoring looks at: the columns of the feature matrix chosen by name, with count, mean and largest value."""
    matrix = build_feature_matrix(filled(spark, sf), HOURLY, PARAMS)
    chosen = monitored_columns(matrix, "y")
    matrix = rounded(matrix, *[c for c in chosen if c.startswith("rolling_")])
    long = unpivot(matrix, [], chosen, "feature", "value")
    return rounded(long.groupBy("feature").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("largest")), "mean", "largest")


_FOLDS = f"""train AS (
  SELECT series_id, ts, y, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos,
    count(*) OVER (PARTITION BY series_id) // 5 AS size
  FROM filled WHERE {sql_split()} = 'train')"""


@query(
    with_(sql_filled(), _FOLDS)
    + "SELECT series_id, ts, y, CAST(fold AS INTEGER) AS fold, CASE WHEN pos < size * fold THEN 'train' ELSE 'val' END AS role "
    "FROM train, (SELECT unnest([1, 2, 3, 4]) AS fold) WHERE pos < size * (fold + 1)"
)
def expanding_folds(spark, sf):
    train = split_part(assign_split(filled(spark, sf), "ts", SPLIT), "train")
    return walk_forward_folds(train, HOURLY, 4)


@query(
    with_(sql_hourly("user_id"))
    + "SELECT series_id, ts, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS position FROM panel"
)
def position_in_series(spark, sf):
    return dense_index(hourly(spark, sf, "user_id"), HOURLY).select("series_id", "ts", "position")


@query(with_(sql_filled()) + "SELECT series_id, ts, y, lag(y, 168) OVER w AS predicted FROM filled" + _WINDOW)
def seasonal_naive_forecast(spark, sf):
    return seasonal_naive(filled(spark, sf), HOURLY, "y", 168)


@query(
    with_(
        sql_filled(),
        "ends AS (SELECT series_id, max(ts) AS b FROM filled GROUP BY 1)",
        "tail AS (SELECT series_id, y, 168 - date_diff('hour', ts, b) - 1 AS slot FROM filled JOIN ends USING (series_id) WHERE ts > b - INTERVAL 168 HOUR)",
        "future AS (SELECT series_id, unnest(range(336)) AS step FROM ends)",
    )
    + "SELECT f.series_id, f.step, t.y AS predicted FROM future f LEFT JOIN tail t ON t.series_id = f.series_id AND t.slot = f.step % 168"
)
def tiled_naive_forecast(spark, sf):
    """Two weeks ahead from the last week alone."""
    panel = cut(filled(spark, sf))
    future = panel.select("series_id").distinct().withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(335).cast("bigint"))))
    return tile_last_season(future, last_season(panel, HOURLY, "y"), ["series_id"], "step")


@query(
    with_(
        sql_filled(),
        f"s AS (SELECT *, {sql_split()} AS split, hour(ts) AS h FROM filled)",
        "p AS (SELECT series_id, h, avg(y) AS predicted FROM s WHERE split = 'train' GROUP BY 1, 2)",
    )
    + f"SELECT s.series_id, s.ts, s.split, {sql_r4('p.predicted')} AS predicted FROM s LEFT JOIN p USING (series_id, h) WHERE split <> 'train'"
)
def hour_mean_forecast(spark, sf):
    labelled = cut(assign_split(filled(spark, sf), "ts", SPLIT))
    return hour_profile_baseline(labelled, HOURLY, "y").select("series_id", "ts", "split", r4("predicted").alias("predicted"))


def _asked(spark, sf):
    """One question per event: what was known of its user at that moment."""
    events = table(spark, sf, "events")
    return events.select("event_id", F.col("user_id").cast("string").alias("series_id"), F.col("ts").alias("asked_at"))


def _user_hours(spark, sf):
    return hourly(spark, sf, "user_id").withColumnRenamed("ts", "known_at")


_ASKED = "asked AS (SELECT event_id, CAST(user_id AS VARCHAR) AS series_id, ts AS asked_at FROM events)"


def _pit_sql(ttl: str) -> str:
    return (
        with_(sql_hourly("user_id"), _ASKED)
        + f"SELECT a.event_id, a.series_id, a.asked_at, CASE WHEN {ttl} THEN p.y END AS y, CASE WHEN {ttl} THEN p.ts END AS known_at_used "
        "FROM asked a ASOF LEFT JOIN panel p ON a.series_id = p.series_id AND a.asked_at >= p.ts"
    )


@query(_pit_sql("TRUE"))
def point_in_time_features(spark, sf):
    """Newest hourly feature of the user at each event."""
    return point_in_time_join(_asked(spark, sf), _user_hours(spark, sf), ["series_id"], "asked_at", "known_at")


@query(_pit_sql("a.asked_at <= p.ts + INTERVAL 90 MINUTE"))
def point_in_time_features_with_ttl(spark, sf):
    shifted = _user_hours(spark, sf)
    return point_in_time_join(_asked(spark, sf), shifted, ["series_id"], "asked_at", "known_at", ttl_seconds=5400)


@query(
    with_(sql_hourly("user_id"), _ASKED, "late AS (SELECT * FROM panel WHERE ts >= TIMESTAMP '2024-01-30 12:00:00')")
    + "SELECT event_id, series_id, asked_at FROM asked WHERE series_id NOT IN (SELECT series_id FROM late)"
)
def entities_lacking_features(spark, sf):
    late = _user_hours(spark, sf).where(F.col("known_at") >= F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"))
    return entities_without_features(_asked(spark, sf), late, ["series_id"])


def _requests(spark, sf):
    """One request per event, for the series of its type: horizon and arrays follow from the event's number and value."""
    events = table(spark, sf, "events")
    horizon = F.pmod("event_id", F.lit(200)).cast("int")
    values = F.transform(F.sequence(F.lit(0), F.least(horizon, F.lit(30))), lambda i: F.col("value") + i)
    return events.select(
        F.col("event_id").alias("request_id"), F.col("event_type").alias("series_id"),
        floor_time(F.col("ts"), HOURLY, "timestamp_ntz").alias("start_ts"), horizon.alias("horizon"),
        F.when(F.pmod("event_id", F.lit(3)) == 0, F.slice(values, 1, F.greatest(horizon, F.lit(1)))).alias("wind"),
        F.lit(None).cast("array<double>").alias("solar"),
    )


_REQUESTS = """requests AS (
  SELECT event_id AS request_id, event_type AS series_id, date_trunc('hour', ts) AS start_ts, CAST(event_id % 200 AS INTEGER) AS horizon, value,
    event_id % 3 = 0 AS has_wind FROM events),
checked AS (
  SELECT *, CASE WHEN horizon < 1 OR horizon > 168 THEN 'horizon out of range'
    WHEN has_wind AND least(horizon, 30) + 1 < horizon THEN 'wind length differs from horizon' END AS reject_reason FROM requests),
steps AS (
  SELECT request_id, series_id, start_ts + to_hours(step_no) AS ts, CAST(step_no AS INTEGER) AS step_no, horizon,
    CASE WHEN has_wind THEN value + step_no ELSE 0.0 END AS wind_mw, 0.0 AS solar_mw
  FROM (SELECT *, unnest(range(horizon)) AS step_no FROM checked WHERE reject_reason IS NULL))"""


@query(with_(_REQUESTS) + "SELECT request_id, horizon, reject_reason FROM checked")
def request_validation(spark, sf):
    return check_requests(_requests(spark, sf)).select("request_id", "horizon", "reject_reason")


@query(with_(_REQUESTS) + f"SELECT request_id, series_id, ts, step_no, {sql_r4('wind_mw')} AS wind_mw, solar_mw FROM steps")
def request_expansion(spark, sf):
    """One row per valid request and forecast hour."""
    out = expand_requests(valid_requests(check_requests(_requests(spark, sf))), HOURLY)
    return rounded(out.drop("start_ts"), "wind_mw")


@query(
    with_(_REQUESTS)
    + f"SELECT request_id, ts, step_no, {SQL_CALENDAR.format(t='ts')}, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-01' THEN 1 ELSE 0 END AS is_holiday, "
    "CASE WHEN isodow(ts) < 6 AND CAST(ts AS DATE) <> DATE '2024-01-01' THEN 1 ELSE 0 END AS is_working_day, "
    f"0.0 AS lag_1h, 0.0 AS rolling_mean_24h, {sql_fourier('step_no')} FROM steps"
)
def request_features_compat(spark, sf):
    """Request features without history: zero lags, and a Fourier clock that starts with the request."""
    out = request_features(valid_requests(check_requests(_requests(spark, sf))), HOURLY, PARAMS)
    keep = [c for c in out.columns if c not in ("series_id", "wind_mw", "solar_mw") and not c.startswith(("lag_", "rolling_"))]
    return rounded(out.select(*keep, "lag_1h", "rolling_mean_24h"), *[c for c in keep if c.startswith("fourier_")])


@query(
    with_(sql_filled(), f"h AS (SELECT series_id, ts AS known_at, {sql_lags()} FROM filled {_WINDOW})", _REQUESTS,
          "anchor AS (SELECT series_id, min(ts) AS a FROM filled GROUP BY 1)",
          "starts AS (SELECT request_id, start_ts FROM requests)")
    + f"SELECT x.request_id, x.ts, {', '.join(f'h.lag_{h}h' for h in LAGS)}, "
    + sql_r4(f"sin({2 * math.pi / 24!r}e0 * (date_diff('hour', a, x.ts) % 24))")
    + " AS fourier_24h_sin_1 FROM (SELECT s.request_id, series_id, s.ts, t.start_ts, a FROM steps s JOIN starts t USING (request_id) "
    "LEFT JOIN anchor USING (series_id)) x ASOF LEFT JOIN h ON x.series_id = h.series_id AND x.start_ts >= h.known_at"
)
def request_features_with_history(spark, sf):
    """Lags known at the request's start, and a Fourier clock in phase with the series."""
    panel = cut(filled(spark, sf))
    history = history_features(panel, HOURLY, "y", PARAMS.lags, PARAMS.windows)
    anchors = panel.groupBy("series_id").agg(
        (F.unix_seconds(F.min("ts").cast("timestamp")) / 3600).cast("bigint").alias("start_idx")
    )
    requests = valid_requests(check_requests(_requests(spark, sf)))
    out = request_features(requests, HOURLY, PARAMS, history.drop("y"), anchors)
    return rounded(out.select("request_id", "ts", *[f"lag_{h}h" for h in LAGS], "fourier_24h_sin_1"), "fourier_24h_sin_1")
