"""Univariate feature drift: one reference period against several windows, all features in one job."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.timegrid import in_slice, type_of
from gridcast.operators.skew import join_groups
from gridcast.params import DriftParams, DriftWindow

# Which columns are monitored, how the test is chosen and when it fires.
MONITOR_PATTERNS = ("lag_", "rolling_", "hour", "day_of_week", "is_working")
FEW_VALUES = 5
DISTANCE_THRESHOLD = 0.1
P_VALUE_THRESHOLD = 0.05
MIN_SCALE = 1e-3

SPLITS = 64


def monitored_columns(df: DataFrame, target: str) -> list[str]:
    """All numeric columns other than the target whose name matches a monitored pattern, or all when none matches."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != target]
    matching = [c for c in numeric if any(p in c for p in MONITOR_PATTERNS)]
    return matching or numeric


def _flags(df: DataFrame, ts: str, params: DriftParams) -> list[Column]:
    """Membership of the reference (index 0) and of each window; windows may overlap."""
    kind = type_of(df, ts)
    periods = [params.reference, *params.windows]
    return [in_slice(F.col(ts), kind, p.start, p.end, params.end_inclusive_day).cast("int") for p in periods]


def _value_counts(df: DataFrame, by: list[str], features: Sequence[str], flags: list[Column]) -> DataFrame:
    """Rows per (feature, range, value) in the reference ``c0`` and each window ``c1..``.

    ``range`` cuts a feature's values at sketched quantiles, so that a feature with many distinct values is ordered by
    many tasks. The cut points are one array of 63 numbers per group and feature.
    """
    counters = [f"c{i}" for i in range(len(flags))]
    marked = df.select(*by, *[F.col(c).cast("double").alias(c) for c in features],
                       *[f.alias(c) for f, c in zip(flags, counters)])
    marked = marked.where(" or ".join(f"{c} = 1" for c in counters))
    cuts_at = [i / SPLITS for i in range(1, SPLITS)]
    sketches = marked.groupBy(*by).agg(
        *[F.percentile_approx(c, cuts_at, 1000).alias(f"_cuts_{c}") for c in features],
        *[F.stddev_pop(F.when(F.col("c0") == 1, F.col(c))).alias(f"_sd_{c}") for c in features],
    )
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(f"_cuts_{c}").alias("_cuts"), F.col(f"_sd_{c}").alias("_scale"))
        for c in features
    ]
    cuts = sketches.select(*by, F.inline(F.array(*entries)))
    long = marked.unpivot([*by, *counters], list(features), "feature", "value").where(F.col("value").isNotNull())
    counts = long.groupBy(*by, "feature", "value").agg(*[F.sum(c).alias(c) for c in counters])
    ranged = join_groups(counts, cuts, [*by, "feature"]).withColumn(
        "range", F.size(F.filter("_cuts", lambda cut: cut < F.col("value")))
    )
    return ranged.drop("_cuts")


def _erfc_tail(kind: str, statistic: float, n0: float, n1: float, distinct: int) -> float:
    """p-value of one test; called on one row per feature and window."""
    if kind == "ks":
        root = math.sqrt(n0 * n1 / (n0 + n1))
        x = (root + 0.12 + 0.11 / root) * statistic
        if x < 0.2:
            return 1.0
        return min(max(2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 101)), 0.0), 1.0)
    if kind == "z":
        return math.erfc(abs(statistic) / math.sqrt(2))
    if math.isinf(statistic):
        return 0.0
    half = statistic / 2  # chi-square with one to four degrees of freedom
    if distinct == 2:
        return math.erfc(math.sqrt(half))
    if distinct == 3:
        return math.exp(-half)
    if distinct == 4:
        return math.erfc(math.sqrt(half)) + math.sqrt(4 * half / math.pi) * math.exp(-half)
    return math.exp(-half) * (1 + half)


@F.pandas_udf(T.DoubleType())
def _p_value(kind: pd.Series, statistic: pd.Series, n0: pd.Series, n1: pd.Series, distinct: pd.Series) -> pd.Series:
    rows = zip(kind, statistic, n0, n1, distinct)
    return pd.Series([None if k == "" or s is None or math.isnan(s) else _erfc_tail(k, s, a, b, d) for k, s, a, b, d in rows])


def drift_statistics(
    df: DataFrame, ts: str, params: DriftParams, features: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Distances per (group, feature, window): Wasserstein-1, KS, Jensen-Shannon, chi-square and their ingredients.

    The empirical distributions are running counts. Each range of values is ordered by itself; prefix sums over the
    ranges (64 rows per feature) supply what came before, and the smallest value of the next range closes the gap.
    """
    by = list(by)
    flags = _flags(df, ts, params)
    counters = [f"c{i}" for i in range(len(flags))]
    windows = [(f"c{i}", w) for i, w in enumerate(params.windows, start=1)]
    counts = _value_counts(df, by, features, flags)
    group, ranged = [*by, "feature"], [*by, "feature", "range"]

    totals = counts.groupBy(*ranged).agg(F.min("value").alias("_first"), *[F.sum(c).alias(f"_r_{c}") for c in counters])
    whole = Window.partitionBy(*group)
    ordered = whole.orderBy("range")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(
        *ranged,
        F.lead("_first").over(ordered).alias("_next_first"),
        *[F.coalesce(F.sum(f"_r_{c}").over(before), F.lit(0)).alias(f"_p_{c}") for c in counters],
        *[F.sum(f"_r_{c}").over(whole).alias(f"n_{c}") for c in counters],
    )
    within = Window.partitionBy(*ranged).orderBy("value")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = counts.join(prefix, ranged).withColumn(
        "_width", F.coalesce(F.lead("value").over(within), F.col("_next_first")) - F.col("value")
    )
    steps = steps.withColumns({f"_f_{c}": F.col(f"_p_{c}") + F.sum(c).over(upto) for c in counters})

    n0 = F.first("n_c0")
    q0 = F.try_divide(F.col("c0"), F.col("n_c0"))
    aggregates = [
        n0.alias("n_reference"),
        F.first("_scale").alias("reference_std"),
    ]
    for c, _ in windows:
        gap = F.abs(F.try_divide(F.col("_f_c0"), F.col("n_c0")) - F.try_divide(F.col(f"_f_{c}"), F.col(f"n_{c}")))
        q = F.try_divide(F.col(c), F.col(f"n_{c}"))
        m = (q0 + q) / 2
        kl = F.when(q0 > 0, q0 * F.ln(q0 / m)).otherwise(0.0) + F.when(q > 0, q * F.ln(q / m)).otherwise(0.0)
        expected = F.col("c0") * F.try_divide(F.col(f"n_{c}"), F.col("n_c0"))
        misfit = F.when(expected > 0, (F.col(c) - expected) * (F.col(c) - expected) / expected).when(
            F.col(c) > 0, F.lit(float("inf"))
        )
        seen = (F.col("c0") > 0) | (F.col(c) > 0)
        aggregates += [
            F.struct(
                F.first(f"n_{c}").alias("n_window"),
                F.sum(gap * F.coalesce("_width", F.lit(0.0))).alias("wasserstein"),
                F.max(gap).alias("ks"),
                F.sqrt(F.greatest(F.sum(kl) / 2, F.lit(0.0))).alias("jensen_shannon"),
                F.sum(misfit).alias("chi_square"),
                F.count_if(seen).alias("distinct_values"),
                F.max_by(q0, F.when(seen, F.col("value"))).alias("top_share_reference"),
                F.max_by(q, F.when(seen, F.col("value"))).alias("top_share_window"),
            ).alias(c)
        ]
    grouped = steps.groupBy(*group).agg(*aggregates)
    labelled = [
        F.struct(F.lit(w.label).alias("window"), F.col(c).alias("s")) for c, w in windows
    ]
    out = grouped.withColumn("_w", F.explode(F.array(*labelled)))
    return out.select(
        *group, "_w.window", "n_reference", "reference_std", "_w.s.*"
    )


def feature_drift(
    df: DataFrame, ts: str, params: DriftParams, features: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Drift verdict per (group, feature, window): ``drift_detected, stattest, drift_score, threshold``.

    ``params.test`` names the test, the same at every size. ``"distance"``: Wasserstein distance in reference standard
    deviations, or Jensen-Shannon distance for a feature of at most five values; drift from 0.1 up. ``"p_value"``:
    Kolmogorov-Smirnov, chi-square or, for two values, the z-test of proportions; drift for p below 0.05. Windows
    without rows are left out.
    """
    if params.test not in ("distance", "p_value"):
        raise ValueError(f"unknown drift test {params.test!r}")
    by = list(by)
    stats = drift_statistics(df, ts, params, features, by).where((F.col("n_reference") > 0) & (F.col("n_window") > 0))
    distance, few = F.lit(params.test == "distance"), F.col("distinct_values") <= FEW_VALUES
    test = (
        F.when(distance & ~few, "Wasserstein distance (normed)")
        .when(distance, "Jensen-Shannon distance")
        .when(~few, "K-S p_value")
        .when(F.col("distinct_values") > 2, "chi-square p_value")
        .otherwise("Z-test p_value")
    )
    kind = (
        F.when(distance, "").when(~few, "ks").when(F.col("distinct_values") > 2, "chi").otherwise("z")
    )
    n0, n1 = F.col("n_reference"), F.col("n_window")
    pooled = (F.col("top_share_reference") * n0 + F.col("top_share_window") * n1) / (n0 + n1)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n0 + 1 / n1))
    z = F.try_divide(F.col("top_share_reference") - F.col("top_share_window"), spread)
    statistic = (
        F.when(kind == "ks", F.col("ks")).when(kind == "chi", F.col("chi_square")).when(kind == "z", F.coalesce(z, F.lit(0.0)))
    )
    scored = stats.withColumn("stattest", test).withColumn(
        "p_value", _p_value(kind, statistic, F.col("n_reference").cast("double"), F.col("n_window").cast("double"),
                            F.col("distinct_values").cast("int"))
    )
    normed = F.col("wasserstein") / F.greatest(F.col("reference_std"), F.lit(MIN_SCALE))
    score = F.when(distance & ~few, normed).when(distance, F.col("jensen_shannon")).otherwise(F.col("p_value"))
    threshold = F.when(distance, F.lit(DISTANCE_THRESHOLD)).otherwise(F.lit(P_VALUE_THRESHOLD))
    detected = F.when(distance, score >= DISTANCE_THRESHOLD).otherwise(score < P_VALUE_THRESHOLD)
    return scored.select(
        *by, "feature", detected.alias("drift_detected"), "stattest", score.alias("drift_score"),
        threshold.alias("threshold"), "window",
    )


def drift_summary(results: DataFrame, windows: Sequence[DriftWindow], rows: DataFrame | None = None) -> DataFrame:
    """One row per window: period, feature counts, names of drifted features, verdict and note."""
    drifted = F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature"))))
    out = results.groupBy("window").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if("drift_detected").alias("n_drifted_features"),
        drifted.alias("drifted_features"),
    )
    out = out.withColumn("drift_detected", F.col("n_drifted_features") > 0)
    period = F.lit(None).cast("string")
    note = F.lit(None).cast("string")
    for w in windows:
        period = F.when(F.col("window") == w.label, F.lit(f"{w.start} → {w.end}")).otherwise(period)
        note = F.when(F.col("window") == w.label, F.lit(w.note)).otherwise(note)
    out = out.withColumn("period", period).withColumn("note", note)
    return out if rows is None else out.join(rows, "window", "left")


def window_rows(df: DataFrame, ts: str, params: DriftParams) -> DataFrame:
    """Rows per window, the reference included."""
    periods = [params.reference, *params.windows]
    counts = df.agg(*[F.sum(f).alias(f"c{i}") for i, f in enumerate(_flags(df, ts, params))])
    entries = [F.struct(F.lit(p.label).alias("window"), F.col(f"c{i}").alias("n_rows")) for i, p in enumerate(periods)]
    return counts.select(F.inline(F.array(*entries)))


def drift_pivot(results: DataFrame, windows: Sequence[str], order_by: str) -> DataFrame:
    """Scores with one column per window, sorted by one of them."""
    return results.groupBy("feature").pivot("window", list(windows)).agg(F.max("drift_score")).orderBy(order_by, "feature")
