"""Exploratory aggregates: seasonal profiles, descriptions, autocorrelation, null counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.operators.buckets import BUCKET, IDX, OWN, bucket_window, dense_index, drop_helpers, halo, with_index
from gridcast.operators.quantiles import exact_quantiles
from gridcast.params import Axis

PARTS = {"hour": F.hour, "weekday": F.weekday, "month": F.month, "year": F.year}


def seasonal_profile(df: DataFrame, ts: str, column: str, parts: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean per calendar part (any of hour, weekday, month, year)."""
    exprs = [PARTS[p](F.col(ts)).alias(p) for p in parts]
    return df.groupBy(*by, *exprs).agg(F.avg(column).alias("mean"))


def profile_by_year(df: DataFrame, ts: str, column: str, years: Sequence[int]) -> DataFrame:
    """Monthly means with one column per year."""
    dated = df.select(F.month(ts).alias("month"), F.year(ts).alias("_year"), column)
    return dated.groupBy("month").pivot("_year", list(years)).agg(F.avg(column)).select(
        "month", *[F.col(str(y)).alias(f"y{y}") for y in years]
    )


def in_year(ts: Column, year: int) -> Column:
    """Year filter as a time range, so that it reaches the scan."""
    return (ts >= F.make_timestamp_ntz(*[F.lit(v) for v in (year, 1, 1, 0, 0, 0)])) & (
        ts < F.make_timestamp_ntz(*[F.lit(v) for v in (year + 1, 1, 1, 0, 0, 0)])
    )


def describe(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """count, mean, std, min, quartiles (exact, linear) and max."""
    basic = df.groupBy(*by).agg(
        F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"), F.max(column).alias("max"),
    )
    q = exact_quantiles(df, by, column, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("n")
    out = basic.join(q, list(by), "left") if by else basic.crossJoin(F.broadcast(q))  # one row each
    return out.select(*by, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def autocorrelation(df: DataFrame, axis: Axis, column: str, lags: Sequence[int], compact: bool = False) -> DataFrame:
    """Pearson correlation of a series with itself h steps earlier, one row per series and lag.

    Lags are in time; with ``compact`` nulls are removed first and lags count the remaining rows.
    """
    rows = df.where(F.col(column).isNotNull()).select(*axis.keys, axis.ts, F.col(column).cast("double").alias(column))
    if compact:
        rows = dense_index(rows, axis).drop(IDX, BUCKET).withColumnRenamed("position", IDX)
    else:
        rows = with_index(rows, axis)
    window = bucket_window(axis)
    out = halo(rows, axis, max(lags))
    out = out.withColumns({f"_l{h}": F.first(column).over(window.rangeBetween(-h, -h)) for h in lags}).where(OWN)
    wide = out.groupBy(*axis.keys).agg(*[F.corr(column, f"_l{h}").alias(f"_l{h}") for h in lags])
    entries = [F.struct(F.lit(h).alias("lag"), F.col(f"_l{h}").alias("acf")) for h in lags]
    return drop_helpers(wide.select(*axis.keys, F.inline(F.array(*entries))))


def profile_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows in all, known values per column, complete rows over all columns and over ``columns``."""

    def complete(names):
        ok = F.lit(True)
        for c in names:
            ok = ok & F.col(c).isNotNull()
        return F.count_if(ok)

    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        complete(df.columns).alias("complete_all"),
        complete(columns).alias("complete_chosen"),
        *[F.count(c).alias(f"known_{c}") for c in columns],
    )


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def missing_rows(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(any_null).alias("n_missing"))
