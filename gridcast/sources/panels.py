"""Regular panels from event-like tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.timegrid import step_index, step_time, type_of
from gridcast.params import Axis


def aggregate_to_steps(
    df: DataFrame, axis: Axis, series: Column, ts: str, aggregates: dict[str, Column]
) -> DataFrame:
    """Events to one row per (series, grid step): partially aggregated before the only shuffle, so a hot series costs no
    more than its number of steps."""
    stepped = df.groupBy(series.alias(axis.keys[0]), step_index(F.col(ts), axis).alias("_i")).agg(
        *[c.alias(n) for n, c in aggregates.items()]
    )
    return stepped.select(
        axis.keys[0], step_time(F.col("_i"), axis, type_of(df, ts)).alias(axis.ts), *aggregates
    )


def cents(value: Column) -> Column:
    """Money-like doubles as whole cents, so that sums don't depend on the order of addition."""
    return F.round(value * 100).cast("bigint")


