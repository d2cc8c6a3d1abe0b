"""Raw readings to a clean panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.timegrid import number, require_utc, utc_time
from gridcast.params import Axis, CleanParams

# Raw column names of the public hourly load data set, and the names used after cleaning.
RAW_COLUMNS = {
    "utc_timestamp": "ts",
    "DE_load_actual_entsoe_transparency": "load_mw",
    "DE_wind_generation_actual": "wind_mw",
    "DE_solar_generation_actual": "solar_mw",
}


def normalise_columns(df: DataFrame, names: Mapping[str, str] = RAW_COLUMNS, ts: str = "ts", keep: Sequence[str] = ()) -> DataFrame:
    """Rename and prune the raw columns, parse the time as UTC and values as DOUBLE (unreadable text becomes NULL).

    ``keep`` passes other columns, such as a series key, through unchanged.
    """
    require_utc(df.sparkSession)
    missing = [c for c in (*names, *keep) if c not in df.columns]
    if missing:
        raise ValueError(f"raw data lacks the columns {missing}")
    parsed = [
        (utc_time(F.col(raw)) if name == ts else number(F.col(raw))).alias(name) for raw, name in names.items()
    ]
    return df.select(*keep, *parsed)


def clip_negative(value: Column) -> Column:
    """Negative values become 0; NULL stays NULL (``greatest`` would turn it into 0)."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def enforce_non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clip_negative(F.col(c)) for c in columns})


def cleaning_stats(raw: DataFrame, clean: DataFrame, axis: Axis, params: CleanParams) -> DataFrame:
    """Per series: rows before and after, nulls left, and negative values before."""
    before = raw.groupBy(*axis.keys).agg(
        F.count(F.lit(1)).alias("rows_raw"),
        *[F.count(c).alias(f"known_raw_{c}") for c in params.columns],
        *[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in params.non_negative],
    )
    after = clean.groupBy(*axis.keys).agg(
        F.count(F.lit(1)).alias("rows_clean"), *[F.count_if(F.col(c).isNull()).alias(f"null_clean_{c}") for c in params.columns]
    )
    return before.join(after, list(axis.keys))
