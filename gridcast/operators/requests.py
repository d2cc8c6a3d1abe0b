"""Batch scoring of forecast requests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.calendar import add_calendar, fourier_columns, holiday_table
from gridcast.functions.timegrid import step_index, type_of
from gridcast.operators.asof import point_in_time_join
from gridcast.operators.features import lag_names, rolling_names
from gridcast.operators.skew import join_groups
from gridcast.params import Axis, FeatureParams
from gridcast.sources.tables import cut

# Horizon bounds and default of a request.
MIN_HORIZON, MAX_HORIZON, DEFAULT_HORIZON = 1, 168, 24


def check_requests(requests: DataFrame) -> DataFrame:
    """Adds ``reject_reason`` (NULL for a valid request) and fills in the default horizon.

    Columns: ``request_id, start_ts, horizon`` and the optional arrays ``wind, solar``, whose length must equal the
    horizon when given.
    """
    out = requests.withColumn("horizon", F.coalesce("horizon", F.lit(DEFAULT_HORIZON)))

    def wrong_length(c: str):
        return F.col(c).isNotNull() & (F.size(c) > 0) & (F.size(c) != F.col("horizon"))

    reason = (
        F.when(F.col("start_ts").isNull(), "start missing")
        .when(~F.col("horizon").between(MIN_HORIZON, MAX_HORIZON), "horizon out of range")
        .when(wrong_length("wind"), "wind length differs from horizon")
        .when(wrong_length("solar"), "solar length differs from horizon")
    )
    return out.withColumn("reject_reason", reason)


def valid_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject_reason").isNotNull())


def expand_requests(requests: DataFrame, axis: Axis) -> DataFrame:
    """One row per forecast step: ``step_no`` from 0, its time, and wind and solar for that step (0 when not given).

    Requests are dealt out evenly first: they're small, so their tasks are few, and each becomes up to 168 rows.
    """
    kind = type_of(requests, "start_ts")
    width = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = requests.repartition(width).withColumn("step_no", F.explode(F.sequence(F.lit(0), F.col("horizon") - 1)))
    offset = F.col("step_no") * F.lit(timedelta(seconds=axis.step))

    def at_step(c: str):
        return F.coalesce(F.get(c, F.col("step_no")), F.lit(0.0)).alias(f"{c}_mw")

    carried = [c for c in requests.columns if c not in ("start_ts", "horizon", "wind", "solar")]
    return steps.select(
        *carried, "start_ts", (F.col("start_ts") + offset).cast(kind).alias(axis.ts), "step_no",
        at_step("wind"), at_step("solar"),
    )


def request_features(
    requests: DataFrame,
    axis: Axis,
    params: FeatureParams = FeatureParams(),
    history: DataFrame | None = None,
    anchors: DataFrame | None = None,
    ttl_seconds: int | None = None,
    holidays: DataFrame | None = None,
) -> DataFrame:
    """Feature rows of valid requests.

    With ``history`` (feature rows per series and time), lags and rolling columns are the newest ones known at the
    request's start, and ``anchors`` (series key, ``start_idx``) keeps the Fourier clock in phase with training.
    Without them both compatibility values apply: zeros, and a clock that starts at 0 with the request.
    """
    past = [*lag_names(params.lags), *rolling_names(params.windows)]
    # History and anchor belong to the request, so they're joined before a request becomes up to 168 rows.
    if history is not None:
        requests = point_in_time_join(requests, history, axis.keys, "start_ts", axis.ts, ttl_seconds, columns=past)
        requests = requests.drop(f"{axis.ts}_used")
    if anchors is not None:
        requests = join_groups(requests, anchors.select(*axis.keys, "start_idx"), list(axis.keys), "left")
    rows = expand_requests(requests, axis)
    if history is None:
        rows = rows.withColumns({c: F.lit(0.0) for c in past})
    if anchors is None:
        clock = F.col("step_no")
    else:
        clock = step_index(F.col(axis.ts), axis) - F.coalesce("start_idx", F.lit(0))
    rows = rows.withColumns(fourier_columns(clock, params.fourier_periods, params.fourier_order)).drop("start_idx")
    if params.holidays == "compat":
        days = None
    else:
        days = holiday_table(requests.sparkSession, params.country, holidays)
    return add_calendar(rows, axis.ts, days).drop("start_ts")


def score_requests(
    bundle, features: DataFrame, nested: bool = False, keys: Sequence[str] = ("request_id",), ts: str = "ts", missing: str = "null"
) -> DataFrame:
    """Forecast points per request, flat, or as one sorted array per request (at most 168 points).

    A point that lacks a feature, such as the lags of a series without history, gets a NULL forecast and NULL bounds;
    with ``missing="zero"`` the compatibility value applies: lacking features count as 0.
    """
    if missing not in ("null", "zero"):
        raise ValueError(f"unknown treatment of missing features {missing!r}")
    used = [c for c in bundle.features if c in features.columns]
    complete = F.lit(True)
    for c in used:
        complete = complete & F.col(c).isNotNull()
    scored = bundle.score(features.withColumn("_complete", complete).fillna(0.0, subset=used))
    bounds = [c for c in ("lower_bound", "upper_bound") if c in scored.columns]
    known = F.col("_complete") if missing == "null" else F.lit(True)
    points = scored.select(*keys, ts, *[F.when(known, F.col(c)).alias(c) for c in ("predicted", *bounds)])
    if not nested:
        return points
    return points.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(ts, "predicted", *bounds))).alias("forecast"))


def forecast_requests(
    bundle,
    requests: DataFrame,
    axis: Axis,
    params: FeatureParams = FeatureParams(),
    history: DataFrame | None = None,
    anchors: DataFrame | None = None,
    keys: Sequence[str] = ("request_id",),
    rows_per_task: int = 50_000,
) -> DataFrame:
    """Forecast points of valid requests, flat, as `score_requests` gives them for `request_features`.

    A forecast follows from the series, the start and the request's columns that the model reads. Requests that share them
    get the same points, so these are made once, up to the longest horizon asked for; each request takes its first steps.
    More than ``rows_per_task`` requests for one forecast are spread over several copies of it.
    """
    read = [c for c in requests.columns if c not in (*axis.keys, "start_ts", "horizon") and {c, f"{c}_mw"} & set(bundle.features)]
    by = [*axis.keys, "start_ts", *read]
    parts = F.ceil(F.count(F.lit(1)) / rows_per_task).cast("int")
    shared = requests.groupBy(*by).agg(F.max("horizon").alias("horizon"), parts.alias("_parts"))
    shared = cut(shared.withColumn("_forecast", F.monotonically_increasing_id()))
    none = {c: F.lit(None).cast("array<double>") for c in ("wind", "solar") if c not in read}
    features = request_features(shared.drop("_parts").withColumns(none), axis, params, history, anchors)
    points = score_requests(bundle, features, nested=True, keys=["_forecast"], ts=axis.ts)
    points = points.join(shared.select("_forecast", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part")), "_forecast")

    asked = join_groups(requests.select(*{c: 0 for c in (*keys, "horizon", *by)}), shared.select(*by, "_forecast", "_parts"), by)
    part = F.pmod(F.xxhash64(*keys, F.monotonically_increasing_id()), F.col("_parts")).cast("int").alias("_part")
    steps = asked.select(*keys, "horizon", "_forecast", part).join(points, ["_forecast", "_part"])
    return steps.select(*keys, F.inline(F.slice("forecast", F.lit(1), F.col("horizon"))))
