"""Calendar, holiday and Fourier expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_YEAR, LAST_YEAR = 1991, 2100

# German national holidays, as (month, day) and as days from Easter Sunday.
FIXED_DATES = ((1, 1), (5, 1), (10, 3), (12, 25), (12, 26))
EASTER_OFFSETS = (-2, 1, 39, 50)
SINGLE_DATES = ("2017-10-31",)

CALENDAR_COLUMNS = (
    "hour", "day_of_week", "day_of_year", "month", "week_of_year", "is_weekend", "season", "is_holiday",
    "is_working_day",
)


def easter_sunday(year: Column) -> Column:
    """Date of Easter in the Gregorian calendar (anonymous computus)."""

    def div(a, b):
        return F.floor(a / b)

    a, b, c = year % 19, div(year, F.lit(100)), year % 100
    g = div(8 * b + 13, F.lit(25))
    h = (19 * a + b - div(b, F.lit(4)) - g + 15) % 30
    m = div(a + 11 * h, F.lit(319))
    r = (2 * (b % 4) + 2 * div(c, F.lit(4)) - (c % 4) - h + m + 32) % 7
    month = div(h - m + r + 90, F.lit(25))
    day = (h - m + r + month + 19) % 32
    return F.make_date(year, month.cast("int"), day.cast("int"))


def national_holidays(spark: SparkSession, country: str = "DE") -> DataFrame:
    """``(country, date)`` for the years 1991 to 2100: about a thousand rows, whatever the data's size."""
    if country != "DE":
        raise ValueError(f"no built-in calendar for {country!r}: pass a table of (country, date) instead")
    years = spark.range(FIRST_YEAR, LAST_YEAR + 1).select(F.col("id").cast("int").alias("y"))
    easter = easter_sunday(F.col("y"))
    dates = [F.make_date("y", F.lit(m), F.lit(d)) for m, d in FIXED_DATES]
    dates += [F.date_add(easter, offset) for offset in EASTER_OFFSETS]
    regular = years.select(F.explode(F.array(*dates)).alias("date"))
    single = spark.range(1).select(F.explode(F.array(*[F.lit(d).cast("date") for d in SINGLE_DATES])).alias("date"))
    return regular.unionByName(single).select(F.lit(country).alias("country"), "date")


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Everything the timestamp alone decides. Monday is 0; weeks are ISO weeks; 0 is winter."""
    month = F.month(ts)
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "day_of_year": F.dayofyear(ts),
        "month": month,
        "week_of_year": F.weekofyear(ts),
        "is_weekend": (F.weekday(ts) >= 5).cast("int"),
        "season": F.floor(F.pmod(month, F.lit(12)) / 3).cast("int"),
    }


def holiday_table(spark: SparkSession, country: str, own: DataFrame | None = None) -> DataFrame:
    """Holidays of one country: the rows of ``own`` for it (all rows if it has no country column), else the built-in ones."""
    if own is None:
        return national_holidays(spark, country)
    return own.where(F.col("country") == country) if "country" in own.columns else own


def add_calendar(df: DataFrame, ts: str, holidays: DataFrame | None) -> DataFrame:
    """Calendar columns with ``is_holiday`` and ``is_working_day``.

    ``holidays`` is a table with a ``date`` column, one row per holiday of one country and so small by nature; ``None``
    leaves ``is_holiday`` at 0, which is what comparing zoned timestamps with plain dates gives.
    """
    out = df.withColumns(calendar_columns(F.col(ts)))
    if holidays is None:
        out = out.withColumn("is_holiday", F.lit(0))
    else:
        days = holidays.select(F.col("date").cast("date").alias("_day")).distinct().withColumn("_hit", F.lit(1))
        out = (
            out.withColumn("_day", F.col(ts).cast("date"))
            .join(F.broadcast(days), "_day", "left")
            .withColumn("is_holiday", F.coalesce("_hit", F.lit(0)))
            .drop("_day", "_hit")
        )
    working = (F.col("is_weekend") == 0) & (F.col("is_holiday") == 0)
    return out.withColumn("is_working_day", working.cast("int"))


def fourier_names(periods: Sequence[int], order: int) -> list[str]:
    return [f"fourier_{p}h_{f}_{k}" for p in periods for k in range(1, order + 1) for f in ("sin", "cos")]


def fourier_columns(clock: Column, periods: Sequence[int], order: int) -> dict[str, Column]:
    """Sine and cosine pairs of an integer clock; the clock is reduced to one period first, which keeps full accuracy."""
    out = {}
    for p in periods:
        within = F.pmod(clock, F.lit(p)).cast("double")
        for k in range(1, order + 1):
            angle = within * F.lit(2.0 * math.pi * k / p)
            out[f"fourier_{p}h_sin_{k}"] = F.sin(angle)
            out[f"fourier_{p}h_cos_{k}"] = F.cos(angle)
    return out
