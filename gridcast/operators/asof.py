"""Point-in-time feature retrieval and latest-value tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def point_in_time_join(
    spine: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    spine_ts: str,
    feature_ts: str,
    ttl_seconds: int | None = None,
    columns: Sequence[str] | None = None,
    created: str | None = None,
    bucket_seconds: int = DAY,
    rows_per_task: int = 5_000_000,
) -> DataFrame:
    """For each spine row, the newest feature row of its entity with time in ``[t - ttl, t]``; nulls when there is none.

    Spine and features are united and walked in time order per (entity, time bucket): one shuffle, no range join. What
    was known before a bucket enters it as one extra row. A bucket with more than ``rows_per_task`` spine rows is split
    by row hash and gets its feature rows in each part; the list of such buckets can't be longer than the spine's row
    count divided by ``rows_per_task``, so it's broadcast. Of feature rows with equal entity and time the one with the
    largest ``created`` is used. The feature time is returned as ``<feature_ts>_used``.
    """
    keys = list(keys)
    columns = list(columns or [c for c in features.columns if c not in (*keys, feature_ts, created)])
    bucketed = [*keys, "_bucket"]

    def bucket(name: str):
        seconds = F.unix_seconds(F.col(name).cast("timestamp"))
        return ((seconds - F.pmod(seconds, F.lit(bucket_seconds))) / F.lit(bucket_seconds)).cast("bigint")

    packed = F.struct(F.col(feature_ts).alias("_at"), *columns)
    known = features.select(*keys, F.col(feature_ts).alias("_t"), packed.alias("_f"), *([created] if created else []))
    if created:
        known = known.groupBy(*keys, "_t").agg(F.max_by("_f", created).alias("_f"))
    known = known.withColumn("_bucket", bucket("_t"))
    asked = spine.select(
        *keys, F.col(spine_ts).alias("_t"), F.struct(*spine.columns).alias("_s"), bucket(spine_ts).alias("_bucket")
    )

    sizes = asked.groupBy(*bucketed).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") > rows_per_task).select(
        *bucketed, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_parts")
    )
    newest = known.groupBy(*bucketed).agg(F.max_by("_f", "_t").alias("_f"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        newest.join(sizes, bucketed, "full")
        .withColumn("_f", F.last("_f", ignorenulls=True).over(earlier))
        .where(F.col("_n").isNotNull() & F.col("_f").isNotNull())
        .select(*keys, F.col("_f._at").alias("_t"), "_f", "_bucket")
    )

    def parts(df: DataFrame, copies: bool) -> DataFrame:
        df = df.join(F.broadcast(hot), bucketed, "left")
        n = F.coalesce("_parts", F.lit(1))
        part = F.explode(F.sequence(F.lit(0), n - 1)) if copies else F.pmod(F.xxhash64("_s"), n).cast("int")
        return df.withColumn("_part", part).drop("_parts")

    rows = parts(known.unionByName(carried), copies=True).unionByName(
        parts(asked, copies=False).withColumn("_q", F.lit(1)), allowMissingColumns=True
    )
    order = Window.partitionBy(*bucketed, "_part").orderBy("_t", F.coalesce("_q", F.lit(0)))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_f", F.last("_f", ignorenulls=True).over(upto)).where(F.col("_q") == 1)
    if ttl_seconds is not None:
        age = F.unix_micros(F.col("_t").cast("timestamp")) - F.unix_micros(F.col("_f._at").cast("timestamp"))
        found = found.withColumn("_f", F.when(age <= ttl_seconds * 1_000_000, F.col("_f")))
    clash = {c: f"{c}_feature" if c in spine.columns else c for c in columns}
    return found.select(
        "_s.*", *[F.col(f"_f.{c}").alias(clash[c]) for c in columns], F.col("_f._at").alias(f"{feature_ts}_used")
    )


def entities_without_features(spine: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    return spine.join(features.select(*keys).distinct(), list(keys), "left_anti")


def materialize_latest(
    df: DataFrame, keys: Sequence[str], ts: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Latest row per entity within ``[start, end]``; folded map-side, so an entity's history is never gathered."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast(df.schema[ts].dataType))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end).cast(df.schema[ts].dataType))
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ts).alias("_row")).select(*keys, "_row.*")


def lookup_latest(requests: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi-join of requests with a latest-value table."""
    return requests.join(latest, list(keys), "left")
