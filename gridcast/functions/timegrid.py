"""Column expressions that map timestamps to integer grid steps and back.

Works for TIMESTAMP and TIMESTAMP_NTZ alike; the session time zone must be UTC (`require_utc`).
"""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.params import Axis


# Usual names of UTC; not all of them are keys of the time zone database.
UTC_TEXTS = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00", "UTC+00:00", "GMT+00:00")


def require_utc(spark: SparkSession) -> None:
    """Raise unless the session's time zone is UTC: any other one shifts parsed text, grids and calendar columns."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:  # London, for one, agrees with UTC in winter only
        utc = zone in UTC_TEXTS or not any(datetime(2019, m, 1, tzinfo=ZoneInfo(zone)).utcoffset() for m in (1, 7))
    except (ZoneInfoNotFoundError, ValueError):  # an offset such as +01:00
        utc = False
    if not utc:
        raise ValueError(f"the session time zone is {zone!r}; set spark.sql.session.timeZone to UTC")


def step_index(ts: Column, axis: Axis) -> Column:
    """Number of whole grid steps between the epoch and ``ts``."""
    seconds = F.unix_seconds(ts.cast("timestamp")) - F.lit(axis.phase)
    return ((seconds - F.pmod(seconds, F.lit(axis.step))) / F.lit(axis.step)).cast("bigint")


def is_on_grid(ts: Column, axis: Axis) -> Column:
    micros = F.unix_micros(ts.cast("timestamp")) - F.lit(axis.phase * 1_000_000)
    return F.pmod(micros, F.lit(axis.step * 1_000_000)) == 0


def step_time(index: Column, axis: Axis, ts_type: str) -> Column:
    """Inverse of :func:`step_index`: start of the grid step, as ``ts_type``."""
    return F.timestamp_seconds(index * F.lit(axis.step) + F.lit(axis.phase)).cast(ts_type)


def floor_time(ts: Column, axis: Axis, ts_type: str) -> Column:
    return step_time(step_index(ts, axis), axis, ts_type)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def utc_time(value: Column) -> Column:
    """Parse text as UTC time. Text without an offset counts as UTC; text that is no time raises under ANSI mode."""
    return F.to_timestamp(value)


def number(value: Column) -> Column:
    """Text or number to DOUBLE; what cannot be read, and NaN, becomes NULL."""
    parsed = value.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def time_slice(df: DataFrame, ts: str, start: str, end: str, end_inclusive_day: bool = False) -> DataFrame:
    """Closed time slice, pushed down to the scan.

    A bare date as ``end`` means that day's midnight; ``end_inclusive_day`` takes the whole day instead.
    """
    return df.where(in_slice(F.col(ts), type_of(df, ts), start, end, end_inclusive_day))


def in_slice(ts: Column, ts_type: str, start: str, end: str, end_inclusive_day: bool = False) -> Column:
    low, high = F.lit(start).cast(ts_type), F.lit(end).cast(ts_type)
    if end_inclusive_day and len(end) == 10:
        return (ts >= low) & (ts < F.date_add(F.lit(end).cast("date"), 1).cast(ts_type))
    return ts.between(low, high)
