"""Time buckets: the way every ordered operator here avoids holding a whole series in one task.

A series is cut into buckets of ``axis.bucket`` grid steps. Bounded look-back copies the rows near a bucket's edge into
the next bucket (`halo`); unbounded look-back passes one small row per (series, bucket) on (`neighbours`,
`dense_index`); per-series values reach the rows by a join on (series, bucket) (`join_series`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.functions.timegrid import step_index
from gridcast.params import Axis

IDX = "_idx"
BUCKET = "_bucket"
OWN = "_own"
HELPERS = (IDX, BUCKET, OWN)


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*HELPERS)


def bucket_of(index: Column, axis: Axis) -> Column:
    return F.floor(index / F.lit(axis.bucket)).cast("bigint")


def with_index(df: DataFrame, axis: Axis) -> DataFrame:
    return df if IDX in df.columns else df.withColumn(IDX, step_index(F.col(axis.ts), axis))


def with_bucket(df: DataFrame, axis: Axis) -> DataFrame:
    df = with_index(df, axis)
    return df if BUCKET in df.columns else df.withColumn(BUCKET, bucket_of(F.col(IDX), axis))


def bucket_keys(axis: Axis) -> list[str]:
    return [*axis.keys, BUCKET]


def bucket_window(axis: Axis):
    return Window.partitionBy(*bucket_keys(axis)).orderBy(IDX)


def halo(df: DataFrame, axis: Axis, reach: int) -> DataFrame:
    """Copy each row that the next bucket can see within ``reach`` steps; ``_own`` tells originals from copies.

    The share of copied rows is ``reach / axis.bucket``.
    """
    if reach > axis.bucket:
        raise ValueError(f"look-back of {reach} steps needs a bucket of at least that size, not {axis.bucket}")
    df = with_index(df.drop(BUCKET), axis)
    own, seen_by = bucket_of(F.col(IDX), axis), bucket_of(F.col(IDX) + reach, axis)
    return df.withColumn(
        BUCKET, F.explode(F.when(own == seen_by, F.array(own)).otherwise(F.array(own, seen_by)))
    ).withColumn(OWN, F.col(BUCKET) == own)


def join_series(df: DataFrame, stats: DataFrame, axis: Axis) -> DataFrame:
    """Left join one row per series onto the series' rows.

    ``stats`` is first spread over the buckets that exist, so the large join runs on (series, bucket) and a hot series
    is spread over as many tasks as it has buckets. A frame already partitioned that way isn't shuffled again.
    """
    df = with_bucket(df, axis)
    keys = bucket_keys(axis)
    spread = df.select(*keys).distinct().join(stats, list(axis.keys))
    return df.join(spread, keys, "left")


def add_series_bounds(df: DataFrame, axis: Axis) -> DataFrame:
    """First and last grid index, and row count, of each row's series, as ``start_idx, end_idx, n_rows``.

    One row per (series, bucket) is aggregated, completed over the series, and joined back on (series, bucket).
    """
    df = with_bucket(df, axis)
    keys = bucket_keys(axis)
    series = Window.partitionBy(*axis.keys)
    edges = (
        df.groupBy(*keys)
        .agg(F.min(IDX).alias("_lo"), F.max(IDX).alias("_hi"), F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            F.min("_lo").over(series).alias("start_idx"),
            F.max("_hi").over(series).alias("end_idx"),
            F.sum("_n").over(series).alias("n_rows"),
        )
    )
    return df.join(edges, keys)


def last_rows(df: DataFrame, axis: Axis, steps: int) -> DataFrame:
    """The last ``steps`` grid steps of each series."""
    rows = add_series_bounds(df, axis).where(F.col(IDX) > F.col("end_idx") - steps)
    return drop_helpers(rows.drop("start_idx", "end_idx", "n_rows"))


def dense_index(df: DataFrame, axis: Axis) -> DataFrame:
    """0-based position of each row within its series, as ``position``, without a per-series sort."""
    df = with_bucket(df, axis)
    keys = bucket_keys(axis)
    before = Window.partitionBy(*axis.keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        df.join(offsets, keys)
        .withColumn("position", F.col("_before") + F.row_number().over(bucket_window(axis)) - 1)
        .drop("_before")
    )


def neighbours(df: DataFrame, axis: Axis, columns: Sequence[str], short_run: int | None = None) -> DataFrame:
    """Nearest known point at or before, and at or after, each row of a complete grid, for each column.

    Adds ``_prev_<c>`` and ``_next_<c>`` (struct of index ``i`` and value ``v``) and the series' ``_start`` and ``_end``
    index. With ``short_run``, also ``_short_<c>``: whether the series has a null run of at most that many steps,
    leading and trailing runs included.

    Within a bucket these are windows; across buckets one edge row per (series, bucket) is carried forward and back.
    """
    df = with_bucket(df, axis)
    keys = bucket_keys(axis)
    within = bucket_window(axis)
    upto = (Window.unboundedPreceding, Window.currentRow)
    strictly_before = (Window.unboundedPreceding, -1)
    over = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY `{IDX}`)"

    def known_at(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col(IDX))

    def is_short(length: Column) -> Column:
        return length.between(1, short_run)

    base = df.select(*keys, IDX, *columns)
    if short_run is not None:
        gaps = {c: F.col(IDX) - F.last(known_at(c), True).over(within.rowsBetween(*strictly_before)) - 1 for c in columns}
        base = base.withColumns({f"_gap_{c}": F.when(F.col(c).isNotNull(), is_short(gap)) for c, gap in gaps.items()})

    per_bucket = [F.min(IDX).alias("_lo"), F.max(IDX).alias("_hi")]
    for c in columns:
        value = F.col(c).cast("double")
        per_bucket += [F.min(known_at(c)).alias(f"_fi_{c}"), F.max(known_at(c)).alias(f"_li_{c}")]
        per_bucket += [F.min_by(value, known_at(c)).alias(f"_fv_{c}"), F.max_by(value, known_at(c)).alias(f"_lv_{c}")]
        if short_run is not None:
            per_bucket.append(F.max(f"_gap_{c}").alias(f"_inner_{c}"))
    edges = base.groupBy(*keys).agg(*per_bucket)
    for c in columns:
        for side, i, v in (("first", "_fi_", "_fv_"), ("last", "_li_", "_lv_")):
            point = F.struct(F.col(f"{i}{c}").alias("i"), F.col(f"{v}{c}").alias("v"))
            edges = edges.withColumn(f"_{side}_{c}", F.when(F.col(f"{i}{c}").isNotNull(), point))

    series = Window.partitionBy(*axis.keys)
    forward, backward = series.orderBy(BUCKET), series.orderBy(F.desc(BUCKET))
    edges = edges.withColumn("_start", F.min("_lo").over(series)).withColumn("_end", F.max("_hi").over(series))
    for c in columns:
        edges = edges.withColumn(
            f"_before_{c}", F.last(f"_last_{c}", ignorenulls=True).over(forward.rowsBetween(*strictly_before))
        ).withColumn(
            f"_after_{c}", F.last(f"_first_{c}", ignorenulls=True).over(backward.rowsBetween(*strictly_before))
        )
    keep = ["_start", "_end", *[f"_{side}_{c}" for c in columns for side in ("before", "after")]]
    if short_run is not None:
        for c in columns:
            first, last = F.col(f"_first_{c}.i"), F.col(f"_last_{c}.i")
            crossing = is_short(first - F.col(f"_before_{c}.i") - 1)
            leading = F.col(f"_before_{c}").isNull() & is_short(first - F.col("_start"))
            trailing = F.col(f"_after_{c}").isNull() & is_short(F.col("_end") - last)
            all_null = (
                F.col(f"_before_{c}").isNull()
                & F.col(f"_after_{c}").isNull()
                & F.col(f"_first_{c}").isNull()
                & is_short(F.col("_end") - F.col("_start") + 1)
            )
            found = F.lit(False)
            for part in (F.col(f"_inner_{c}"), crossing, leading, trailing, all_null):
                found = found | F.coalesce(part, F.lit(False))
            edges = edges.withColumn(f"_short_{c}", F.max(found).over(series))
            keep.append(f"_short_{c}")

    # Windows first, then the join: its required order on (series, bucket) is already there.
    inside = {}
    for c in columns:
        inside[f"_pi_{c}"] = F.last(known_at(c), ignorenulls=True).over(within.rowsBetween(*upto))
        inside[f"_pv_{c}"] = F.last(F.col(c).cast("double"), ignorenulls=True).over(within.rowsBetween(*upto))
        inside[f"_ni_{c}"] = F.expr(f"lead(CASE WHEN `{c}` IS NOT NULL THEN `{IDX}` END) IGNORE NULLS {over}")
        inside[f"_nv_{c}"] = F.expr(f"lead(CAST(`{c}` AS DOUBLE)) IGNORE NULLS {over}")
    out = df.withColumns(inside).join(edges.select(*keys, *keep), keys)

    def point_or(i: str, v: str, otherwise: str) -> Column:
        return F.when(F.col(i).isNotNull(), F.struct(F.col(i).alias("i"), F.col(v).alias("v"))).otherwise(F.col(otherwise))

    found = {}
    for c in columns:
        itself = F.struct(F.col(IDX).alias("i"), F.col(c).cast("double").alias("v"))
        later = point_or(f"_ni_{c}", f"_nv_{c}", f"_after_{c}")
        found[f"_prev_{c}"] = point_or(f"_pi_{c}", f"_pv_{c}", f"_before_{c}")
        found[f"_next_{c}"] = F.when(F.col(c).isNotNull(), itself).otherwise(later)
    scratch = [f"_{p}_{c}" for c in columns for p in ("pi", "pv", "ni", "nv", "before", "after")]
    return out.withColumns(found).drop(*scratch)
