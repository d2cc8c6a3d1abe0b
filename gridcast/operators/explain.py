"""Additive per-row attributions of the boosted model (path-dependent Shapley values of trees)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.operators.quantiles import unpivot
from gridcast.sources.tables import shared_folder


def stable_sample(df: DataFrame, keys: Sequence[str], rows: int, seed: int = 42) -> DataFrame:
    """The ``rows`` rows with the smallest key hashes: the same sample however the data is partitioned."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(digest, *keys).limit(rows)


def _leaf_paths(model: GBTRegressionModel, df: DataFrame) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
    """Every leaf of the ensemble as (weighted value, conditions); a condition is (feature, above, up to, cover share).

    Repeated splits on one feature are merged into one interval. The model is bounded: trees x 2^depth leaves.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/gridcast/{uuid.uuid4().hex}"
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict[int, object]] = {}
    for row in saved:
        trees.setdefault(row["treeID"], {})[row["id"]] = row
    leaves = []
    for tree, nodes in trees.items():
        stack = [(0, {})]
        while stack:
            at, conditions = stack.pop()
            node = nodes[at]
            if node["leftChild"] < 0:
                value = model.treeWeights[tree] * node["prediction"]
                leaves.append((value, [(f, lo, hi, share) for f, (lo, hi, share) in conditions.items()]))
                continue
            f, cut_at = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
            lo, hi, share = conditions.get(f, (-np.inf, np.inf, 1.0))
            for child, low, high in ((node["leftChild"], lo, min(hi, cut_at)), (node["rightChild"], max(lo, cut_at), hi)):
                part = share * nodes[child]["rawCount"] / node["rawCount"]
                stack.append((child, {**conditions, f: (low, high, part)}))
    return leaves


def _leaf_game(value: float, conditions: list, x: np.ndarray, out: np.ndarray) -> None:
    """Add one leaf's Shapley values for all rows of ``x``.

    A coalition sees a feature's condition as met or not; outside it the condition counts with its cover share. The
    payoff is a product, so the sum over coalitions of one size is a coefficient of a product of linear polynomials.
    """
    m = len(conditions)
    met = [((x[:, f] > lo) & (x[:, f] <= hi)).astype(float) for f, lo, hi, _ in conditions]
    for i, (f, _, _, share) in enumerate(conditions):
        poly = np.zeros((m, len(x)))
        poly[0] = 1.0
        degree = 0
        for j, (_, _, _, other) in enumerate(conditions):
            if j == i:
                continue
            degree += 1
            for d in range(degree, 0, -1):
                poly[d] = poly[d] * other + poly[d - 1] * met[j]
            poly[0] *= other
        weights = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
        out[:, f] += value * (met[i] - share) * (weights @ poly)


def attributions(model: GBTRegressionModel, df: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One attribution column per feature, and ``base``; their sum is the model's prediction."""
    leaves = _leaf_paths(model, df)
    base = sum(v * float(np.prod([share for *_, share in cs])) for v, cs in leaves)
    shipped = df.sparkSession.sparkContext.broadcast(leaves)  # bounded by the model's size
    features, keys = list(features), list(keys)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields]
    schema = ", ".join([*fields, *[f"`{c}` double" for c in features], "base double"])

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[features].to_numpy(dtype=float)
            phi = np.zeros_like(x)
            for value, conditions in shipped.value:
                _leaf_game(value, conditions, x, phi)
            out = batch[keys].copy()
            out[features] = phi
            out["base"] = base
            yield out

    inputs = df.select(*keys, *[F.col(c).cast("double").alias(f"{c}") for c in features if c not in keys])
    return inputs.mapInPandas(explain, schema)


def mean_attribution(values: DataFrame, features: Sequence[str], top: int = 20) -> DataFrame:
    """Features by mean absolute attribution, the ``top`` largest."""
    long = unpivot(values, [], features, "feature", "value")
    means = long.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"))
    return means.orderBy(F.desc("mean_abs"), "feature").limit(top)


def row_attribution(values: DataFrame, keys: Sequence[str], features: Sequence[str], top: int = 15) -> DataFrame:
    """Per row, the ``top`` features by absolute attribution, nulls last. Each row is ranked by itself, without a shuffle."""
    size = lambda c: F.coalesce(-F.abs(F.col(c)).cast("double"), F.lit(float("inf")))
    entries = [F.struct(size(c).alias("size"), F.lit(c).alias("feature"), F.col(c).alias("value")) for c in features]
    largest = F.slice(F.array_sort(F.array(*entries)), 1, top)
    out = values.select(*keys, F.posexplode(largest).alias("_at", "_entry"))
    return out.select(*keys, "_entry.feature", "_entry.value", (F.col("_at") + 1).alias("rank"))
