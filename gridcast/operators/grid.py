"""Complete time grid per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.functions.timegrid import is_on_grid, require_utc, step_index, step_time, type_of
from gridcast.operators.buckets import BUCKET, IDX, bucket_keys, bucket_of, drop_helpers, with_index
from gridcast.params import Axis


def bucket_markers(bounds: DataFrame, axis: Axis) -> DataFrame:
    """One row per bucket a series touches: its first index there, and its last one as ``_last``."""
    first, last = bucket_of(F.col("start_idx"), axis), bucket_of(F.col("end_idx"), axis)
    buckets = bounds.select(*axis.keys, "start_idx", "end_idx", F.explode(F.sequence(first, last)).alias(BUCKET))
    low = F.greatest("start_idx", F.col(BUCKET) * axis.bucket)
    high = F.least("end_idx", (F.col(BUCKET) + 1) * axis.bucket - 1)
    return buckets.select(*bucket_keys(axis), low.alias(IDX), high.alias("_last"))


def event_bounds(events: DataFrame, axis: Axis, series: Column, ts: str) -> DataFrame:
    """First and last grid index per series straight from raw events: two columns scanned, folded map-side."""
    index = step_index(F.col(ts), axis)
    return events.groupBy(series.alias(axis.keys[0])).agg(F.min(index).alias("start_idx"), F.max(index).alias("end_idx"))


def make_grid(
    df: DataFrame,
    axis: Axis,
    columns: Sequence[str] | None = None,
    keep_helpers: bool = False,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """One row per series and grid step from the series' first to its last timestamp; missing steps carry nulls.

    Raises for a duplicate timestamp within a series and for a timestamp between grid steps. Each row is expanded up to
    the next one of its (series, bucket); a marker row opens every bucket, so stretches without data are covered too.
    One shuffle of the rows that exist, after which the result is partitioned for the bucket windows that follow.
    ``bounds`` (keys, ``start_idx``, ``end_idx``) spares a second pass over ``df`` where they are known more cheaply
    (`event_bounds`).
    """
    require_utc(df.sparkSession)
    ts_type = type_of(df, axis.ts)
    columns = list(columns or [c for c in df.columns if c not in (*axis.keys, axis.ts, IDX, BUCKET)])
    keys = bucket_keys(axis)
    data = with_index(df, axis).withColumn(
        IDX,
        F.when(is_on_grid(F.col(axis.ts), axis), F.col(IDX)).otherwise(
            F.raise_error(F.concat(F.lit("timestamp not on the grid: "), F.col(axis.ts).cast("string"))).cast("bigint")
        ),
    )
    if bounds is None:
        bounds = data.groupBy(*axis.keys).agg(F.min(IDX).alias("start_idx"), F.max(IDX).alias("end_idx"))
    rows = data.select(*axis.keys, bucket_of(F.col(IDX), axis).alias(BUCKET), IDX, F.lit(True).alias("_data"), *columns)
    markers = bucket_markers(bounds, axis)
    # A fixed partition count: sized by the sparse input, adaptive execution would merge partitions that the expansion
    # below then blows up again.
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = rows.unionByName(markers, allowMissingColumns=True).repartition(width, *keys)
    # Ordered by index, a marker precedes the data row it may share its index with.
    following = F.lead(IDX).over(Window.partitionBy(*keys).orderBy(IDX, F.coalesce("_data", F.lit(False))))
    last_in_bucket = F.max("_last").over(Window.partitionBy(*keys).orderBy(IDX, F.coalesce("_data", F.lit(False))))
    known = known.withColumns({"_next": following, "_last": last_in_bucket})
    until = F.coalesce(F.col("_next") - 1, F.col("_last"))
    twice = F.raise_error(
        F.concat(F.lit("duplicate timestamp: "), step_time(F.col(IDX), axis, "timestamp").cast("string"))
    ).cast("array<bigint>")
    covered = F.when(until >= F.col(IDX), F.sequence(F.col(IDX), until)).when(F.col("_data"), twice)
    out = known.select(*keys, F.col(IDX).alias("_at"), *columns, F.explode(covered).alias(IDX))
    here = F.col(IDX) == F.col("_at")
    out = out.select(
        *axis.keys, step_time(F.col(IDX), axis, ts_type).alias(axis.ts),
        *[F.when(here, F.col(c)).alias(c) for c in columns], IDX, BUCKET,
    )
    return out if keep_helpers else drop_helpers(out)
