"""Seasonal-naive and mean-profile baselines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.timegrid import step_index
from gridcast.operators.buckets import IDX, OWN, add_series_bounds, bucket_window, drop_helpers, halo, join_series
from gridcast.operators.metrics import forecast_metrics
from gridcast.operators.model_meta import load_meta, save_meta
from gridcast.params import Axis


def seasonal_naive(df: DataFrame, axis: Axis, target: str, season: int = 168) -> DataFrame:
    """``predicted``: the value one season earlier. Early rows of a later part read the part before it."""
    earlier = F.first(target).over(bucket_window(axis).rangeBetween(-season, -season))
    return drop_helpers(halo(df, axis, season).withColumn("predicted", earlier).where(OWN))


def last_season(df: DataFrame, axis: Axis, target: str, season: int = 168) -> DataFrame:
    """The last ``season`` steps of each series as ``(keys, slot, value)``; slot 0 is the oldest."""
    rows = add_series_bounds(df, axis)
    slot = F.col(IDX) - F.col("end_idx") + season - 1
    return rows.where(slot >= 0).select(*axis.keys, slot.cast("int").alias("slot"), F.col(target).alias("value"))


def tile_last_season(horizon: DataFrame, profile: DataFrame, keys: Sequence[str], row: str, season: int = 168) -> DataFrame:
    """Forecast without history at hand: row i of a horizon gets slot ``i mod season`` of the profile."""
    slotted = horizon.withColumn("slot", F.pmod(F.col(row), F.lit(season)).cast("int"))
    return slotted.join(profile.withColumnRenamed("value", "predicted"), [*keys, "slot"], "left").drop("slot")


def hour_profile_baseline(df: DataFrame, axis: Axis, target: str) -> DataFrame:
    """``predicted`` for rows outside ``split = train``: the training mean of the row's hour of day.

    The profile is one row of 24 means per series.
    """
    hour = F.hour(axis.ts)
    means = F.array(*[F.avg(F.when(hour == h, F.col(target))) for h in range(24)])
    profile = df.where(F.col("split") == "train").groupBy(*axis.keys).agg(means.alias("_means"))
    rest = join_series(df.where(F.col("split") != "train"), profile, axis)
    return drop_helpers(rest.withColumn("predicted", F.get("_means", hour)).drop("_means"))


def naive_run(df: DataFrame, axis: Axis, target: str, season: int = 168, by: Sequence[str] = ()) -> DataFrame:
    """Validation metrics of the seasonal naive on a frame with a ``split`` column."""
    scored = seasonal_naive(df, axis, target, season).where(F.col("split") == "val")
    return forecast_metrics(scored, by, target, "predicted", prefix="val_")


@dataclass(frozen=True)
class NaiveModel:
    """The last season of each series, one row of ``season`` values in ``profile``, repeated over any later time."""

    profile: DataFrame
    season: int
    target: str
    axis: Axis

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``predicted``: the profile's value at the row's phase; NULL for a series without a profile."""
        phase = F.pmod(step_index(F.col(self.axis.ts), self.axis), F.lit(self.season)).cast("int")
        profiled = join_series(df, self.profile, self.axis)
        return drop_helpers(profiled.withColumn("predicted", F.get("_season", phase)).drop("_season"))

    def save(self, path: str) -> None:
        self.profile.write.mode("overwrite").parquet(f"{path}/profile")
        save_meta(path, "seasonal_naive", self.axis, season=self.season, target=self.target)

    @staticmethod
    def load(spark: SparkSession, path: str) -> NaiveModel:
        meta, axis = load_meta(spark, path, "seasonal_naive")
        return NaiveModel(spark.read.parquet(f"{path}/profile"), meta["season"], meta["target"], axis)


def fit_naive(train: DataFrame, axis: Axis, target: str, season: int = 168) -> NaiveModel:
    """Keep the last ``season`` steps of each series by their phase, the step number modulo ``season``."""
    rows = add_series_bounds(train, axis)
    last = rows.where(F.col(IDX) > F.col("end_idx") - season)
    phase = F.pmod(F.col(IDX), F.lit(season)).cast("int")
    entries = F.map_from_entries(F.collect_list(F.struct(phase, F.col(target).cast("double"))))  # at most ``season`` of them
    profile = last.groupBy(*axis.keys).agg(entries.alias("_map"))
    slots = F.sequence(F.lit(0), F.lit(season - 1))
    return NaiveModel(profile.select(*axis.keys, F.transform(slots, lambda i: F.col("_map")[i]).alias("_season")), season, target, axis)
