"""Outlier removal: per-series quantile fences, or an isolation forest over several columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.functions.timegrid import type_of
from gridcast.operators.buckets import BUCKET, IDX, drop_helpers, join_series, with_bucket
from gridcast.operators.gaps import fill_limited
from gridcast.operators.quantiles import linear_position, order_statistics, wide_quantiles
from gridcast.operators.skew import join_groups
from gridcast.params import Axis
from gridcast.sources.tables import cut

QUARTILES = {"q1": 0.25, "q3": 0.75}


def fences(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], multiplier: float = 3.0
) -> DataFrame:
    """``<c>_q1, <c>_q3, <c>_lo, <c>_hi`` per group."""
    out = wide_quantiles(df, by, columns, QUARTILES)
    for c in columns:
        iqr = F.col(f"{c}_q3") - F.col(f"{c}_q1")
        out = out.withColumn(f"{c}_lo", F.col(f"{c}_q1") - multiplier * iqr)
        out = out.withColumn(f"{c}_hi", F.col(f"{c}_q3") + multiplier * iqr)
    return out


def null_outside_fences(
    df: DataFrame,
    axis: Axis,
    columns: Sequence[str],
    multiplier: float = 3.0,
    until: str | None = None,
    keep_helpers: bool = False,
) -> DataFrame:
    """Set values strictly outside their series' fences to NULL.

    Fences come from the whole series; ``until`` takes them from rows up to that time only, so that later rows can't
    influence how earlier ones are cleaned.
    """
    basis = df if until is None else df.where(F.col(axis.ts) <= F.lit(until).cast(type_of(df, axis.ts)))
    limits = fences(basis, axis.keys, columns, multiplier)
    names = [f"{c}_{side}" for c in columns for side in ("lo", "hi")]
    out = join_series(df, limits.select(*axis.keys, *names), axis)
    kept = {
        c: F.when(F.col(c).isNull() | (F.col(c) < F.col(f"{c}_lo")) | (F.col(c) > F.col(f"{c}_hi")), None).otherwise(F.col(c))
        for c in columns
    }
    out = out.withColumns(kept).drop(*names)
    return out if keep_helpers else drop_helpers(out)


def fence_report(df: DataFrame, by: Sequence[str], column: str, multiplier: float = 3.0) -> DataFrame:
    """Quartiles, fences, and how many known values lie outside them."""
    limits = fences(df, by, [column], multiplier)
    rows = df.where(F.col(column).isNotNull())
    rows = join_groups(rows, limits, by)
    lo, hi, q1, q3 = (F.col(f"{column}_{n}") for n in ("lo", "hi", "q1", "q3"))
    outside = (F.col(column) < lo) | (F.col(column) > hi)
    return rows.groupBy(*by).agg(
        F.first(q1).alias("q1"), F.first(q3).alias("q3"), F.first(q3 - q1).alias("iqr"),
        F.first(lo).alias("lo"), F.first(hi).alias("hi"),
        F.count(F.lit(1)).alias("n"), F.count_if(outside).alias("n_outside"),
        F.avg(outside.cast("int")).alias("share_outside"),
    )


# Forest size and sample per tree of the published method.
TREES = 100
SAMPLE = 256
SCORING_BUCKET = 65_536


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random binary tree of n points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng: np.random.Generator) -> list[tuple[int, float, int, int, float]]:
    """One isolation tree as rows (feature, cut, left, right, depth at leaf); feature -1 marks a leaf."""
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes: list = [None]
    todo = [(0, points, 0)]
    while todo:
        at, part, depth = todo.pop()
        spans = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) > 1 else ()
        if depth >= limit or len(spans) == 0:
            nodes[at] = (-1, 0.0, -1, -1, depth + float(_average_path(len(part))))
            continue
        f = int(rng.choice(spans))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        left = part[:, f] < cut
        nodes[at] = (f, cut, len(nodes), len(nodes) + 1, 0.0)
        nodes += [None, None]
        todo += [(nodes[at][2], part[left], depth + 1), (nodes[at][3], part[~left], depth + 1)]
    return nodes


def _depths(nodes: np.ndarray, points: np.ndarray) -> np.ndarray:
    at = np.zeros(len(points), dtype=int)
    while True:
        feature = nodes[at, 0].astype(int)
        open_ = np.flatnonzero(feature >= 0)
        if len(open_) == 0:
            return nodes[at, 4]
        here = at[open_]
        goes_left = points[open_, feature[open_]] < nodes[here, 1]
        at[open_] = np.where(goes_left, nodes[here, 2], nodes[here, 3]).astype(int)


def isolation_scores(
    df: DataFrame, axis: Axis, columns: Sequence[str], trees: int = TREES, sample: int = SAMPLE, seed: int = 42
) -> DataFrame:
    """Anomaly score per row and series, as ``(keys, index, bucket, _score)``; rows with a null are left out.

    Each tree sees the rows with the smallest hashes, so samples don't depend on partitioning. A row is considered for
    the few trees whose hash bound it passes; a tree is grown from at most ``sample`` rows. Rows are scored per
    (series, time bucket) next to the series' trees.
    """
    keys, columns = list(axis.keys), list(columns)
    wide = Axis(axis.keys, axis.ts, axis.step, axis.phase, SCORING_BUCKET)
    rows = with_bucket(df.drop(BUCKET), wide).select(*keys, BUCKET, IDX, *[F.col(c).cast("double").alias(c) for c in columns])
    rows = rows.dropna("any", subset=columns)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # Twice the wanted rate: the chance that a tree then gets fewer than `sample` rows is negligible, and harmless.
    bound = F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("_n"))
    sized = join_series(rows, sizes, wide)
    row_hash = F.xxhash64(*keys, IDX, F.lit(seed))
    def drawn(tree):
        u = F.pmod(F.xxhash64(F.col("_h"), tree), F.lit(1 << 30)) / float(1 << 30)
        return F.struct(tree.alias("_tree"), u.alias("_u"))

    draws = F.filter(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), drawn), lambda d: d["_u"] < F.col("_bound"))
    picked = (
        sized.withColumn("_h", row_hash)
        .withColumn("_bound", bound)
        .select(*keys, *columns, F.inline(draws))
    )
    rank = F.row_number().over(Window.partitionBy(*keys, "_tree").orderBy("_u", *columns))
    sampled = picked.withColumn("_rank", rank).where(F.col("_rank") <= sample).select(*keys, "_tree", *columns)
    key_schema = ", ".join(f"`{k}` {type_of(df, k)}" for k in keys)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([seed, int(pdf["_tree"].iloc[0])])
        points = pdf[columns].to_numpy()
        points = points[np.lexsort(points.T)]
        flat = np.array(_grow(points, rng)).ravel().tolist()
        out = pdf[[*keys, "_tree"]].iloc[:1].copy()
        out["_size"], out["_nodes"] = len(points), [flat]
        return out

    forest = sampled.groupBy(*keys, "_tree").applyInPandas(
        grow, f"{key_schema}, _tree int, _size int, _nodes array<double>"
    )
    per_bucket = rows.select(*keys, BUCKET).distinct().join(forest, keys)
    per_bucket = per_bucket.toDF(*per_bucket.columns)  # own column identities, as both sides stem from `rows`

    def score(part: pd.DataFrame, trees_: pd.DataFrame) -> pd.DataFrame:
        out = part[[*keys, IDX]].copy()
        points = part[columns].to_numpy()
        depth = np.mean([_depths(np.reshape(n, (-1, 5)), points) for n in trees_["_nodes"]], axis=0)
        out["_score"] = 2.0 ** (-depth / max(float(_average_path(trees_["_size"].max())), 1e-12))
        return out

    return (
        rows.groupBy(*keys, BUCKET)
        .cogroup(per_bucket.groupBy(*keys, BUCKET))
        .applyInPandas(score, f"{key_schema}, {IDX} bigint, _score double")
    )


def null_isolated(
    df: DataFrame,
    axis: Axis,
    columns: Sequence[str],
    contamination: float = 0.01,
    seed: int = 42,
    trees: int = TREES,
    keep_helpers: bool = False,
    sample: int = SAMPLE,
) -> DataFrame:
    """Null all ``columns`` on the ``contamination`` share of rows with the highest isolation scores, per series."""
    df = with_bucket(df, axis)
    scores = cut(isolation_scores(df, axis, columns, trees=trees, sample=sample, seed=seed))  # read three times below
    p = 1.0 - contamination
    limits = order_statistics(scores, axis.keys, "_score", {"_limit": (p, linear_position(p))}).drop("n")
    flagged = join_groups(scores, limits, axis.keys).where(F.col("_score") > F.col("_limit"))
    flagged = flagged.select(*axis.keys, IDX, F.lit(True).alias("_out"))
    out = df.join(flagged, [*axis.keys, IDX], "left")
    out = out.withColumns({c: F.when(F.col("_out").isNull(), F.col(c)) for c in columns}).drop("_out")
    return out if keep_helpers else drop_helpers(out)


def remove_outliers(
    df: DataFrame,
    axis: Axis,
    columns: Sequence[str],
    method: str = "iqr",
    multiplier: float = 3.0,
    contamination: float = 0.01,
    refill_limit: int = 24,
    until: str | None = None,
    causal: bool = False,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = 42,
) -> DataFrame:
    """Null outliers by ``method`` ("iqr" or "isolation_forest"), then interpolate what became or was null.

    The forest looks at all ``columns`` together; ``trees``, ``sample`` (rows per tree) and ``seed`` are its own.
    """
    if method == "iqr":
        out = null_outside_fences(df, axis, columns, multiplier, until, keep_helpers=True)
    elif method == "isolation_forest":
        out = null_isolated(df, axis, columns, contamination, seed, trees, keep_helpers=True, sample=sample)
    else:
        raise ValueError(f"unknown outlier method {method!r}: use 'iqr' or 'isolation_forest'")
    return fill_limited(out, axis, columns, refill_limit, causal)

