"""Chronological split, split metadata, walk-forward folds and data fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.timegrid import type_of
from gridcast.operators.buckets import IDX, add_series_bounds, drop_helpers
from gridcast.params import Axis, SplitParams

PARTS = ("train", "val", "test")


def assign_split(df: DataFrame, ts: str, params: SplitParams) -> DataFrame:
    """Label rows train (up to ``train_end``), val (up to ``val_end``) or test (after it)."""
    kind = type_of(df, ts)
    train_end, val_end = F.lit(params.train_end).cast(kind), F.lit(params.val_end).cast(kind)
    label = F.when(F.col(ts) <= train_end, "train").when(F.col(ts) <= val_end, "val").otherwise("test")
    return df.withColumn("split", label)


def split_part(df: DataFrame, part: str) -> DataFrame:
    return df.where(F.col("split") == part).drop("split")


def features_and_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Feature columns in their order, and the target alone."""
    return df.select(*[c for c in df.columns if c != target]), df.select(target)


def split_metadata(df: DataFrame, ts: str, target: str) -> DataFrame:
    """One row: start, end and row count per part, feature count and list, fingerprint of the training rows."""
    features = [c for c in df.columns if c not in (ts, target, "split")]
    bounds = []
    for part in PARTS:
        here = F.col("split") == part
        bounds += [
            F.min(F.when(here, F.col(ts))).cast("string").alias(f"{part}_start"),
            F.max(F.when(here, F.col(ts))).cast("string").alias(f"{part}_end"),
            F.count_if(here).alias(f"n_{part}"),
        ]
    train = fingerprint(split_part(df, "train").drop(target)).select(F.col("fingerprint").alias("train_data_hash"))
    out = df.agg(*bounds).crossJoin(F.broadcast(train))  # two one-row frames
    names = F.array(*[F.lit(c) for c in features])
    return out.withColumn("n_features", F.lit(len(features))).withColumn("feature_columns", names)


def check_split(df: DataFrame, ts: str) -> DataFrame:
    """One row with ``ok``; raises when a part is empty or the parts overlap in time."""
    lows = {p: F.min(F.when(F.col("split") == p, F.col(ts))) for p in PARTS}
    highs = {p: F.max(F.when(F.col("split") == p, F.col(ts))) for p in PARTS}
    ordered = (highs["train"] < lows["val"]) & (highs["val"] < lows["test"])
    return df.agg(F.coalesce(ordered, F.lit(False)).alias("ok")).select(
        F.when(F.col("ok"), True).otherwise(F.raise_error(F.lit("split boundary violated")).cast("boolean")).alias("ok")
    )


def split_overlap(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys occur in more than one part, and how many there are: disjointness and coverage in one pass."""
    per_key = df.groupBy(*keys).agg(F.count_distinct("split").alias("parts"), F.count(F.lit(1)).alias("rows"))
    return per_key.agg(F.count_if(F.col("parts") > 1).alias("shared_keys"), F.sum("rows").alias("total_rows"))


def walk_forward_folds(df: DataFrame, axis: Axis, folds: int) -> DataFrame:
    """Expanding folds per series: with n steps and size n // (folds + 1), fold i trains on the first i sizes and
    validates on the next one; the remainder is left out. Adds ``fold`` (from 1) and ``role``."""
    out = add_series_bounds(df, axis)
    position = F.col(IDX) - F.col("start_idx")
    size = F.floor((F.col("end_idx") - F.col("start_idx") + 1) / (folds + 1))
    roles = [
        F.struct(
            F.lit(i).alias("fold"),
            F.when(position < size * i, "train").when(position < size * (i + 1), "val").alias("role"),
        )
        for i in range(1, folds + 1)
    ]
    out = out.withColumn("_f", F.explode(F.array(*roles))).where(F.col("_f.role").isNotNull())
    return drop_helpers(out.select(*df.columns, "_f.fold", "_f.role"))


def fingerprint(df: DataFrame) -> DataFrame:
    """32 hex digits over all rows that don't depend on row order or partitioning."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in df.columns])
    row = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    text = F.concat_ws(
        "|", F.count(F.lit(1)).cast("string"), F.sum(row.cast("decimal(20,0)")).cast("string"), F.bit_xor(row).cast("string")
    )
    return df.agg(F.md5(text).alias("fingerprint"))
