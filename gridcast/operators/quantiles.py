"""Exact order statistics per group with bounded state.

``percentile`` keeps every distinct value of a group in one task. Here a mergeable sketch first narrows each wanted rank
to a thin slice of the value range (the sketch's rank error is bounded), then only the rows of that slice are sorted
and everything outside collapses into counts before the shuffle. Two passes over the data; of a group's slice (0.2 % of
its rows per rank) only the 256th that holds the rank is sorted. A check that the rank really fell into its slice raises
otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.skew import join_groups, join_null_safe

ACCURACY = 10_000
MARGIN = 10.0 / ACCURACY
SMALL_GROUP = 10_000
SLICE_PARTS = 256
LOWEST = -1.7976931348623157e308  # smallest finite double: sorts below every value

Position = Callable[[Column], Column]


def linear_position(p: float) -> Position:
    """0-based fractional rank of the p-quantile under linear interpolation."""
    return lambda n: F.lit(float(p)) * (n - 1)


def order_statistics(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    picks: Mapping[str, tuple[float, Position]],
) -> DataFrame:
    """One row per group with its non-null count ``n`` and one value per pick.

    A pick is ``(p, position)``: roughly where the rank lies as a share of the group, and its exact 0-based position as
    a function of ``n``. A fractional position interpolates between its two neighbours.
    """
    by = list(by)
    values = df.select(*by, F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    lows = [max(p - MARGIN, 0.0) for p, _ in picks.values()]
    highs = [min(p + MARGIN, 1.0) for p, _ in picks.values()]
    inf = float("inf")
    sketch = values.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", lows, ACCURACY).alias("_lo"),
        F.percentile_approx("_v", highs, ACCURACY).alias("_hi"),
    )
    small = F.col("_n") <= SMALL_GROUP
    slices = []
    for i in range(len(picks)):
        lo = F.when(small | F.lit(lows[i] == 0.0), F.lit(-inf)).otherwise(F.col("_lo")[i])
        hi = F.when(small | F.lit(highs[i] == 1.0), F.lit(inf)).otherwise(F.col("_hi")[i])
        # Steps of the slice per unit of value; 0 leaves an open or empty slice in one part.
        scale = F.when((lo > -inf) & (hi < inf) & (lo < hi), SLICE_PARTS / (hi - lo)).otherwise(F.lit(0.0))
        base = F.when(lo > -inf, lo).otherwise(F.lit(0.0))
        slices += [lo.alias(f"_lo{i}"), hi.alias(f"_hi{i}"), scale.alias(f"_sc{i}"), base.alias(f"_ba{i}")]
    tagged = join_groups(values, sketch.select(*by, *slices), by)

    v = F.col("_v")
    slice_names = [f"{n}{i}" for i in range(len(picks)) for n in ("_sc", "_ba")]
    inside = F.lit(False)
    floor = F.lit(LOWEST)
    for i in range(len(picks)):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        inside = inside | ((v >= lo) & (v <= hi))
        floor = F.greatest(floor, F.when(hi < v, hi).otherwise(F.lit(LOWEST)))
    # Rows outside every slice fold into one counter that sorts right after the slice below them. `_z` numbers equal
    # parts of each slice: a sum of clipped, growing functions of the value, so it grows with the value.
    placed = tagged.select(*by, *slice_names, "_v", inside.alias("_in"), floor.alias("_floor"))
    placed = placed.select(
        *by, *slice_names, F.when(F.col("_in"), v).otherwise(F.col("_floor")).alias("_x"), (~F.col("_in")).alias("_gap")
    )
    part = F.lit(0.0)
    for i in range(len(picks)):
        steps = (F.col("_x") - F.col(f"_ba{i}")) * F.col(f"_sc{i}")
        part = part + F.least(F.greatest(steps, F.lit(0.0)), F.lit(float(SLICE_PARTS)))
    counted = (
        placed.select(*by, F.floor(part).alias("_z"), "_x", "_gap")
        .groupBy(*by, "_z", "_x", "_gap")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    # Only the parts that hold a wanted rank are sorted.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # a few hundred parts per group
    earlier = group.orderBy("_z").rowsBetween(Window.unboundedPreceding, -1)
    parts = counted.groupBy(*by, "_z").agg(F.sum("_c").alias("_zc"))
    parts = parts.select(
        *by, "_z", "_zc", F.coalesce(F.sum("_zc").over(earlier), F.lit(0)).alias("_before"), F.sum("_zc").over(group).alias("_n")
    )
    wanted = F.lit(False)
    for _, position in picks.values():
        pos = position(F.col("_n"))
        wanted = wanted | ((F.ceil(pos) >= F.col("_before")) & (F.floor(pos) < F.col("_before") + F.col("_zc")))
    local = Window.partitionBy(*by, "_z").orderBy("_x", "_gap").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = join_null_safe(counted, parts.where(wanted).drop("_zc"), [*by, "_z"]).withColumn(
        "_cum", F.col("_before") + F.sum("_c").over(local)
    )

    value = F.when(~F.col("_gap"), F.col("_x")).otherwise(
        F.raise_error(F.lit("order statistic outside its sketched slice")).cast("double")
    )

    def at(position: Column) -> Column:
        here = (F.col("_cum") - F.col("_c") <= position) & (position < F.col("_cum"))
        return F.max(F.when(here, value))

    aggregates, outputs = [F.first("_n").alias("n")], []
    for i, (name, (_, position)) in enumerate(picks.items()):
        pos = position(F.col("_n"))
        low, high = F.floor(pos), F.ceil(pos)
        aggregates += [at(low).alias(f"_a{i}"), at(high).alias(f"_b{i}"), F.first(pos - low).alias(f"_f{i}")]
        a, b, f = F.col(f"_a{i}"), F.col(f"_b{i}"), F.col(f"_f{i}")
        outputs.append((a + (b - a) * f).alias(name))
    return ranked.groupBy(*by).agg(*aggregates).select(*by, "n", *outputs)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], column: str, probs: Mapping[str, float]
) -> DataFrame:
    """Linear-interpolation quantiles of one column per group: ``by``, ``n`` and one column per name in ``probs``."""
    picks = {name: (p, linear_position(p)) for name, p in probs.items()}
    return order_statistics(df, by, column, picks)


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long, one output row per input row and column, as DOUBLE."""
    doubles = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(ids), list(columns), name, value)


def wide_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """Quantiles of several columns at once, as ``<column>_<name>``; one pass of :func:`exact_quantiles` for all."""
    long = exact_quantiles(unpivot(df, by, columns, "_column", "_value"), [*by, "_column"], "_value", probs)
    picked = [
        F.max(F.when(F.col("_column") == c, F.col(name))).alias(f"{c}_{name}") for c in columns for name in probs
    ]
    return long.groupBy(*by).agg(*picked)


def approx_quantiles(df: DataFrame, by: Sequence[str], column: str, probs: Mapping[str, float]) -> DataFrame:
    """Opt-in sketch quantiles (one pass, rank error 1/10,000)."""
    array = F.percentile_approx(column, list(probs.values()), ACCURACY)
    return df.groupBy(*by).agg(F.count(column).alias("n"), array.alias("_q")).select(
        *by, "n", *[F.col("_q")[i].alias(name) for i, name in enumerate(probs)]
    )
