"""Leakage-free features: a feature at t reads values before t only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.calendar import CALENDAR_COLUMNS, add_calendar, fourier_columns, fourier_names, holiday_table
from gridcast.operators.buckets import (
    IDX, OWN, add_series_bounds, bucket_window, drop_helpers, halo, with_index,
)
from gridcast.params import Axis, FeatureParams


def lag_names(lags: Sequence[int]) -> list[str]:
    return [f"lag_{h}h" for h in lags]


def rolling_names(windows: Sequence[int]) -> list[str]:
    return [f"rolling_{stat}_{w}h" for w in windows for stat in ("mean", "std")]


def feature_names(params: FeatureParams) -> list[str]:
    """All derived feature columns, in the order `build_feature_matrix` makes them."""
    return [
        *lag_names(params.lags),
        *rolling_names(params.windows),
        *CALENDAR_COLUMNS,
        *fourier_names(params.fourier_periods, params.fourier_order),
    ]


def _lag_columns(axis: Axis, column: str, lags: Sequence[int]) -> dict[str, Column]:
    window = bucket_window(axis)
    return {f"lag_{h}h": F.first(column).over(window.rangeBetween(-h, -h)) for h in lags}


def _rolling_columns(axis: Axis, column: str, windows: Sequence[int]) -> dict[str, Column]:
    out = {}
    for w in windows:
        frame = bucket_window(axis).rangeBetween(-w, -1)
        enough = F.count(column).over(frame) >= w // 2
        out[f"rolling_mean_{w}h"] = F.when(enough, F.avg(column).over(frame))
        out[f"rolling_std_{w}h"] = F.when(enough, F.stddev_samp(column).over(frame))
    return out


def history_features(
    df: DataFrame, axis: Axis, column: str, lags: Sequence[int] = (), windows: Sequence[int] = ()
) -> DataFrame:
    """Lags and rolling mean/std by time, all from one shuffle on (series, bucket).

    ``lag_<h>h`` is the value h steps earlier; the rolling columns cover the w steps before t, without t, and need at
    least ``w // 2`` known values. Rows needn't form a complete grid, but a timestamp may occur once only.
    """
    reach = max([*lags, *windows])
    out = halo(df, axis, reach).withColumns({**_lag_columns(axis, column, lags), **_rolling_columns(axis, column, windows)})
    return drop_helpers(out.where(OWN))


def lag_features(df: DataFrame, axis: Axis, column: str, lags: Sequence[int]) -> DataFrame:
    return history_features(df, axis, column, lags=lags)


def rolling_features(df: DataFrame, axis: Axis, column: str, windows: Sequence[int]) -> DataFrame:
    return history_features(df, axis, column, windows=windows)


def lag_by_join(df: DataFrame, axis: Axis, column: str, lag: int) -> DataFrame:
    """The same lag as an equi-join on (series, time): the choice when a single lag is far beyond a bucket."""
    df = with_index(df, axis)
    earlier = df.select(*axis.keys, (F.col(IDX) + lag).alias(IDX), F.col(column).alias(f"lag_{lag}h"))
    return drop_helpers(df.join(earlier, [*axis.keys, IDX], "left"))


def fourier_features(
    df: DataFrame, axis: Axis, periods: Sequence[int], order: int, anchor_index: int | None = None
) -> DataFrame:
    """Fourier terms of the steps since the series' first row, or since a fixed grid index."""
    df = with_index(df, axis)
    if anchor_index is not None:
        return drop_helpers(df.withColumns(fourier_columns(F.col(IDX) - anchor_index, periods, order)))
    clock = F.col(IDX) - F.col("start_idx")
    out = add_series_bounds(df, axis).withColumns(fourier_columns(clock, periods, order))
    return drop_helpers(out.drop("start_idx", "end_idx", "n_rows"))


def build_feature_matrix(
    df: DataFrame, axis: Axis, params: FeatureParams = FeatureParams(), holidays: DataFrame | None = None
) -> DataFrame:
    """Lags, rolling statistics, calendar and Fourier columns; rows with any null are dropped at the end.

    ``holidays`` overrides the built-in calendar of ``params.country``.
    """
    out = fourier_features(df, axis, params.fourier_periods, params.fourier_order)
    out = history_features(out, axis, params.target, params.lags, params.windows)
    if params.holidays == "compat":
        days = None
    else:
        days = holiday_table(df.sparkSession, params.country, holidays)
    out = add_calendar(out, axis.ts, days).select(*df.columns, *feature_names(params))
    return out.dropna("any") if params.drop_nulls else out
