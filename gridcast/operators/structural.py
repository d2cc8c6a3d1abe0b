"""Structural forecaster: piecewise-linear trend plus daily, weekly and yearly seasonality, fitted by ridge regression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.calendar import fourier_columns
from gridcast.functions.timegrid import step_index
from gridcast.operators.boosted import assemble
from gridcast.operators.buckets import drop_helpers, join_series
from gridcast.operators.model_meta import load_meta, save_meta
from gridcast.params import Axis, TrainParams

# Seasonal periods in hours with their number of harmonics, and the share of training time with breaks.
SEASONS = ((24, 4), (168, 3), (8766, 10))
BREAK_RANGE = 0.8


@dataclass(frozen=True)
class StructuralModel:
    """Only time enters. Series share shape and trend; each has its own level (mean over its training rows)."""

    model: LinearRegressionModel
    levels: DataFrame
    start: int
    span: int
    changepoints: int
    multiplicative: bool
    target: str
    axis: Axis

    def predict(self, df: DataFrame) -> DataFrame:
        rows, names = _design(df, self.axis, self.start, self.span, self.changepoints)
        rows = join_series(rows, self.levels, self.axis)
        out = self.model.setPredictionCol("_shape").transform(assemble(rows, names))
        level = F.col("_shape") + F.col("_level")
        return drop_helpers(out.withColumn("predicted", F.exp(level) if self.multiplicative else level)).select(
            *df.columns, "predicted"
        )

    def score(self, df: DataFrame) -> DataFrame:
        return self.predict(df)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/regression")
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")
        numbers = {c: getattr(self, c) for c in ("start", "span", "changepoints", "multiplicative", "target")}
        save_meta(path, "structural", self.axis, **numbers)

    @staticmethod
    def load(spark: SparkSession, path: str) -> StructuralModel:
        meta, axis = load_meta(spark, path, "structural")
        del meta["kind"]
        model = LinearRegressionModel.load(f"{path}/regression")
        return StructuralModel(model, spark.read.parquet(f"{path}/levels"), axis=axis, **meta)


def _design(df: DataFrame, axis: Axis, start: int, span: int, changepoints: int) -> tuple[DataFrame, list[str]]:
    hours = step_index(F.col(axis.ts), axis) * axis.step / 3600
    t = (step_index(F.col(axis.ts), axis) - start) / F.lit(float(max(span, 1)))
    columns: dict[str, Column] = {"_trend": t}
    for i in range(1, changepoints + 1):
        at = BREAK_RANGE * i / (changepoints + 1)
        columns[f"_trend_{i}"] = F.greatest(t - at, F.lit(0.0))
    for period, order in SEASONS:
        if period * 3600 >= 2 * axis.step:
            columns.update(fourier_columns(hours, [period], order))
    return df.withColumns(columns), list(columns)


def fit_structural(train: DataFrame, axis: Axis, params: TrainParams = TrainParams()) -> StructuralModel:
    """Fit on the training rows. Multiplicative seasonality is additive in the logarithm, so the target must be
    positive then; rows with other values are left out."""
    target = params.target
    y = F.col(target).cast("double")
    rows = train.where(y.isNotNull() & (y > 0) if params.multiplicative else y.isNotNull())
    rows = rows.withColumn("_y", F.ln(y) if params.multiplicative else y)
    index = step_index(F.col(axis.ts), axis)
    edge = rows.agg(F.min(index).alias("a"), F.max(index).alias("b")).first()  # two numbers
    levels = rows.groupBy(*axis.keys).agg(F.avg("_y").alias("_level"))
    start, span = int(edge["a"]), int(edge["b"] - edge["a"])
    design, names = _design(rows, axis, start, span, params.changepoints)
    centred = join_series(design, levels, axis).withColumn("_y", F.col("_y") - F.col("_level"))
    solver = LinearRegression(featuresCol="_features", labelCol="_y", regParam=params.ridge / 1000, elasticNetParam=0.0, solver="normal")
    model = solver.fit(assemble(centred, names))
    return StructuralModel(model, levels, start, span, params.changepoints, params.multiplicative, target, axis)
