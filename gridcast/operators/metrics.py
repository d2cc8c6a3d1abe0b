"""Forecast error and interval metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.functions.timegrid import month_text


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error over rows whose actual isn't zero."""
    return F.avg(F.when(actual != 0, F.abs((actual - predicted) / actual))) * 100


def smape(actual: Column, predicted: Column) -> Column:
    scale = F.abs(actual) + F.abs(predicted)
    return F.avg(F.when(scale != 0, 2 * F.abs(actual - predicted) / scale)) * 100


def point_metrics(actual: Column, predicted: Column, prefix: str = "") -> list[Column]:
    """Aggregates MAPE, RMSE and MAE, over rows that have both values."""
    y, p = actual.cast("double"), predicted.cast("double")
    error = y - p
    return [
        F.count(error).alias("n"),
        mape(y, p).alias(f"{prefix}mape"),
        F.sqrt(F.avg(error * error)).alias(f"{prefix}rmse"),
        F.avg(F.abs(error)).alias(f"{prefix}mae"),
    ]


def forecast_metrics(
    df: DataFrame, by: Sequence[str], actual: str, predicted: str, prefix: str = "", with_smape: bool = False
) -> DataFrame:
    """MAPE, RMSE and MAE per group, over rows that have both values; groups without such rows are left out."""
    y, p = F.col(actual), F.col(predicted)
    columns = point_metrics(y, p, prefix)
    if with_smape:
        columns.append(smape(y.cast("double"), p.cast("double")).alias(f"{prefix}smape"))
    return df.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(*columns)


def forecast_metrics_rollup(df: DataFrame, by: Sequence[str], actual: str, predicted: str, prefix: str = "") -> DataFrame:
    """The same per group, per prefix of ``by`` and over all rows, told apart by ``level``: the number of columns of ``by``
    that are grouped over, so 0 is the finest and ``len(by)`` the total. A NULL in a group column is a group of its own.

    Rows are first summed into the finest groups; only those sums are rolled up, so the rows aren't copied per level.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error, share = y - p, F.when(y != 0, F.abs((y - p) / y))
    sums = df.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count(error).alias("_n"), F.count(share).alias("_shares"), F.sum(share).alias("_share"),
        F.sum(error * error).alias("_square"), F.sum(F.abs(error)).alias("_abs"),
    )
    rolled = sums.rollup(*by).agg(
        F.bit_count(F.grouping_id()).cast("int").alias("level"), F.sum("_n").alias("n"),
        (F.try_divide(F.sum("_share"), F.sum("_shares")) * 100).alias(f"{prefix}mape"),
        F.sqrt(F.sum("_square") / F.sum("_n")).alias(f"{prefix}rmse"), (F.sum("_abs") / F.sum("_n")).alias(f"{prefix}mae"),
    )
    return rolled.where("n > 0")  # the total of no rows


def error_columns(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``abs_error`` and ``mape_contribution``; the latter is NULL where the actual is zero."""
    error = F.abs(F.col(actual) - F.col(predicted))
    share = F.try_divide(error, F.abs(F.col(actual))) * 100
    return df.withColumn("abs_error", error).withColumn("mape_contribution", share)


def coverage(actual: str, lower: str, upper: str) -> Column:
    """Share of actuals inside the closed interval."""
    return F.avg(F.col(actual).between(F.col(lower), F.col(upper)).cast("int"))


def width(lower: str, upper: str) -> Column:
    return F.avg(F.col(upper) - F.col(lower))


def interval_metrics(df: DataFrame, by: Sequence[str], actual: str, lower: str, upper: str) -> DataFrame:
    """Coverage and mean width of the interval per group."""
    known = F.col(actual).between(F.col(lower), F.col(upper))
    return df.groupBy(*by).agg(
        F.count(known).alias("n"), coverage(actual, lower, upper).alias("coverage"), width(lower, upper).alias("width")
    )


def fold_summary(fold_metrics: DataFrame, by: Sequence[str], metric: str) -> DataFrame:
    """Mean and population standard deviation over folds."""
    return fold_metrics.groupBy(*by).agg(
        F.avg(metric).alias(f"cv_{metric}_mean"), F.stddev_pop(metric).alias(f"cv_{metric}_std")
    )


def monthly_error(df: DataFrame, by: Sequence[str], ts: str, actual: str) -> DataFrame:
    """Mean of ``abs_error / |actual|`` per calendar month, in percent."""
    share = F.try_divide(F.col("abs_error"), F.abs(F.col(actual)))
    return df.groupBy(*by, month_text(F.col(ts)).alias("month")).agg((F.avg(share) * 100).alias("mape"))


def concept_drift(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    actual: str,
    perturb_start: str = "",
    perturb_end: str = "",
    ratio: float = 1.5,
) -> DataFrame:
    """Monthly error against the median of the months outside the perturbed span.

    A month is flagged when its error is above ``ratio`` times that median. Without a span, all months count.
    """
    monthly = monthly_error(df, by, ts, actual)
    outside = F.lit(True)
    if perturb_start and perturb_end:
        outside = ~F.col("month").between(perturb_start[:7], perturb_end[:7])
    # One row per month: the window holds a few hundred rows at most.
    series = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    baseline = F.percentile(F.when(outside, F.col("mape")), F.lit(0.5)).over(series)
    return monthly.withColumn("baseline_mape", baseline).withColumn(
        "drift_flag", F.coalesce(F.col("mape") > F.col("baseline_mape") * ratio, F.lit(False))
    )
