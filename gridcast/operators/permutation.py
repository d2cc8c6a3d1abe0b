"""Permutation importance: how much a model's error grows when one feature's values are dealt anew over the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.metrics import point_metrics

BUCKET_DIGITS = 3  # hex digits of the digest: 4096 buckets, so a numbering has no task larger than a 4096th of the rows
METRICS = ("mape", "rmse", "mae")


def key_digest(keys: Sequence[str], *salt: Column) -> Column:
    """MD5 of the salt and the row's key, the same however the rows are partitioned."""
    return F.md5(F.concat_ws("|", *salt, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))


def number_by_digest(df: DataFrame, digest: Column, keys: Sequence[str], groups: Sequence[str] = (), name: str = "_at") -> DataFrame:
    """0-based position of each row in the order of its digest, then of its key, within ``groups``.

    Rows are numbered inside buckets of equal leading digits; the buckets' counts, a few thousand rows for each group,
    give the offsets. No task sees all rows.
    """
    rows = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, BUCKET_DIGITS))
    within = Window.partitionBy(*groups, "_bucket").orderBy("_digest", *keys)
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*groups, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = rows.join(offsets, [*groups, "_bucket"]).withColumn(name, F.row_number().over(within) - 1 + F.col("_before"))
    return numbered.drop("_digest", "_bucket", "_before")


def permuted(df: DataFrame, keys: Sequence[str], features: Sequence[str], repeats: int = 1, seed: int = 42) -> DataFrame:
    """Every row once for each feature and repeat (``_feature``, ``_repeat``), that feature's value taken from another row.

    The row at position i of one keyed order gets the value of the row at position i of another, so each value is used
    exactly once, and the deal depends on the keys, which must be unique, and the seed alone.
    """
    salt = F.lit(str(seed))
    own = number_by_digest(df, key_digest(keys, salt, F.lit("rows")), keys)
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(r).alias("r")) for f in features for r in range(repeats)])
    value = F.coalesce(*[F.when(F.col("_feature") == f, F.col(f).cast("double")) for f in features])
    deal = df.select(*keys, *[c for c in features if c not in keys], F.explode(pairs).alias("_p"))
    deal = deal.withColumn("_feature", F.col("_p.f")).withColumn("_repeat", F.col("_p.r")).withColumn("_value", value)
    digest = key_digest(keys, salt, F.col("_feature"), F.col("_repeat").cast("string"))
    deal = number_by_digest(deal.select(*keys, "_feature", "_repeat", "_value"), digest, keys, ["_feature", "_repeat"])
    each = own.withColumn("_p", F.explode(pairs)).withColumn("_feature", F.col("_p.f")).withColumn("_repeat", F.col("_p.r")).drop("_p")
    met = each.join(deal.select("_feature", "_repeat", "_at", "_value"), ["_feature", "_repeat", "_at"])
    swapped = {f: F.when(F.col("_feature") == f, F.col("_value").cast(df.schema[f].dataType)).otherwise(F.col(f)) for f in features}
    return met.withColumns(swapped).select("_feature", "_repeat", *df.columns)


def permutation_importance(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], score: Callable[[DataFrame], DataFrame], actual: str,
    predicted: str = "predicted", repeats: int = 1, seed: int = 42,
) -> DataFrame:
    """Per feature, the growth of MAPE, RMSE and MAE when the feature is permuted, averaged over the repeats.

    ``score`` adds the prediction to a frame and keeps its other columns; it is called twice, whatever the number of
    features. Rows whose actual or prediction is null don't count. The largest growth of MAE comes first.
    """
    known = lambda d: d.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    columns = point_metrics(F.col(actual), F.col(predicted))
    base = known(score(df)).agg(*[c for c in columns]).select(*[F.col(m).alias(f"_{m}") for m in METRICS])
    shuffled = known(score(permuted(df, keys, features, repeats, seed))).groupBy("_feature", "_repeat").agg(*columns)
    means = shuffled.groupBy(F.col("_feature").alias("feature")).agg(*[F.avg(m).alias(m) for m in METRICS])
    grown = means.crossJoin(F.broadcast(base))  # one row
    out = grown.select("feature", *[(F.col(m) - F.col(f"_{m}")).alias(f"{m}_growth") for m in METRICS])
    return out.orderBy(F.desc("mae_growth"), "feature")
