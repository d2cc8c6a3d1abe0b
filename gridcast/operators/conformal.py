"""Conformal calibration of prediction intervals: one fixed offset, or an adaptive one."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.operators.quantiles import order_statistics
from gridcast.params import AdaptiveParams


def conformity_score(actual: str, lower: str, upper: str) -> Column:
    """How far the actual lies outside the interval; negative inside. NULL when any input is NULL."""
    known = F.col(actual).isNotNull() & F.col(lower).isNotNull() & F.col(upper).isNotNull()
    return F.when(known, F.greatest(F.col(lower) - F.col(actual), F.col(actual) - F.col(upper)))


def _offset_position(alpha: float):
    def position(n: Column) -> Column:
        rank = F.least(F.ceil((n + 1) * F.lit(1.0 - alpha)) / n, F.lit(1.0))
        return F.ceil(rank * (n - 1))

    return position


def conformal_offset(
    df: DataFrame, by: Sequence[str], alpha: float, actual: str = "y", lower: str = "y_lower", upper: str = "y_upper"
) -> DataFrame:
    """Split-conformal offset ``q`` per group: the score at rank ceil((n+1)(1-alpha))/n, rounded up to a data point."""
    scored = df.select(*by, conformity_score(actual, lower, upper).alias("_score"))
    return order_statistics(scored, by, "_score", {"q": (1.0 - alpha, _offset_position(alpha))})


def widen(df: DataFrame, lower: str, upper: str, q: str | Column) -> DataFrame:
    """Shift both bounds outward by the offset."""
    q = F.col(q) if isinstance(q, str) else q
    return df.withColumn(lower, F.col(lower) - q).withColumn(upper, F.col(upper) + q)


class SortedScores:
    """Sorted multiset of floats in blocks, so that insertion and rank lookup stay cheap for long series.

    ``order`` lists the blocks' ids from small to large scores, ``tops`` and ``counts`` each block's largest score and
    size. They suffice to find a block, so a subclass may keep the blocks elsewhere and `fetch` one when it's needed.
    """

    BLOCK = 1024

    def __init__(self, values: Sequence[float] = ()):
        ordered = sorted(values)
        parts = [ordered[i : i + self.BLOCK] for i in range(0, len(ordered), self.BLOCK)] or [[]]
        self.blocks = dict(enumerate(parts))
        self.order = list(self.blocks)
        self.tops = [b[-1] if b else -math.inf for b in parts]
        self.counts = [len(b) for b in parts]
        self.next_id, self.size = len(parts), len(ordered)
        self.changed = set(self.blocks)

    def fetch(self, block_id: int) -> list[float]:
        raise KeyError(block_id)

    def _block(self, at: int) -> list[float]:
        block_id = self.order[at]
        if block_id not in self.blocks:
            self.blocks[block_id] = self.fetch(block_id)
        return self.blocks[block_id]

    def add(self, value: float) -> None:
        at = min(bisect_left(self.tops, value), len(self.tops) - 1)
        block = self._block(at)
        insort(block, value)
        self.size += 1
        self.tops[at], self.counts[at] = block[-1], len(block)
        self.changed.add(self.order[at])
        if len(block) > 2 * self.BLOCK:
            upper, self.blocks[self.order[at]] = block[self.BLOCK :], block[: self.BLOCK]
            self.blocks[self.next_id] = upper
            self.order.insert(at + 1, self.next_id)
            self.tops[at : at + 1] = [block[self.BLOCK - 1], upper[-1]]
            self.counts[at : at + 1] = [self.BLOCK, len(upper)]
            self.changed.add(self.next_id)
            self.next_id += 1

    def __getitem__(self, rank: int) -> float:
        for at, count in enumerate(self.counts):
            if rank < count:
                return self._block(at)[rank]
            rank -= count
        raise IndexError(rank)

    def higher(self, p: float) -> float:
        return self[math.ceil((self.size - 1) * p)]

    def values(self) -> list[float]:
        return [v for at in range(len(self.order)) for v in self._block(at)]


class AdaptiveState:
    """State of the adaptive recursion for one series: miscoverage level, offset and scores seen."""

    def __init__(self, params: AdaptiveParams, q: float, scores: Sequence[float] = (), level: float | None = None):
        self.target = 1.0 - params.target_coverage
        self.gamma = params.gamma
        self.level = self.target if level is None else level
        self.q = q
        self.scores = SortedScores(scores)

    def step(self, y: float, lower: float, upper: float) -> tuple[float, int]:
        """Judge one observation with the current offset, then learn from it. Returns the offset used and the hit."""
        used = self.q
        hit = int(lower - used <= y <= upper + used)
        self.scores.add(max(lower - y, y - upper))
        self.level = min(max(self.level + self.gamma * (self.target - (1 - hit)), 1e-4), 1.0 - 1e-4)
        if self.scores.size >= 2:
            self.q = self.scores.higher(1.0 - self.level)
        return used, hit


def adaptive_conformal(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    params: AdaptiveParams = AdaptiveParams(),
    actual: str = "y",
    lower: str = "y_lower",
    upper: str = "y_upper",
    initial_q: str | None = None,
    seed_scores: str | None = None,
) -> DataFrame:
    """Adaptive conformal intervals: adds ``q`` (offset used), ``hit``, ``lower_aci`` and ``upper_aci``.

    Each step needs the outcome of the one before, so a series is walked in time order by one task; series run in
    parallel. Rows arrive in Arrow batches, never as one frame; what a task keeps per series is one float per row.
    ``initial_q`` names a column with the starting offset (else 0); ``seed_scores`` an array column with calibration
    scores (else the history starts empty). Rows with a null among their values are passed on with nulls.
    """
    keys = list(keys)
    schema = T.StructType(
        [*[f for f in df.schema.fields], T.StructField("q", T.DoubleType()), T.StructField("hit", T.IntegerType()),
         T.StructField("lower_aci", T.DoubleType()), T.StructField("upper_aci", T.DoubleType())]
    )

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, last = None, None
        for batch in batches:
            if state is None:
                first = batch.iloc[0]
                seeds = first[seed_scores] if seed_scores else None
                state = AdaptiveState(
                    params, float(first[initial_q]) if initial_q else 0.0, () if seeds is None else list(seeds)
                )
            times = batch[ts]
            if not times.is_monotonic_increasing or (last is not None and times.iloc[0] < last):
                raise ValueError("rows of a series reached the recursion out of time order")
            last = times.iloc[-1]
            values = batch[[actual, lower, upper]].to_numpy(dtype=float)
            q, hit = np.full(len(values), np.nan), [None] * len(values)
            for i, (y, lo, hi) in enumerate(values):
                if not (math.isnan(y) or math.isnan(lo) or math.isnan(hi)):
                    q[i], hit[i] = state.step(y, lo, hi)
            yield batch.assign(
                q=q, hit=pd.array(hit, dtype="Int32"), lower_aci=values[:, 1] - q, upper_aci=values[:, 2] + q
            )

    ordered = df.repartition(*keys).sortWithinPartitions(*keys, ts)
    return ordered.groupBy(*keys).applyInPandas(walk, schema)


def adaptive_summary(df: DataFrame, by: Sequence[str], ts: str) -> DataFrame:
    """Coverage, mean width and the offset's first, last and largest value."""
    return df.groupBy(*by).agg(
        F.avg("hit").alias("coverage"),
        F.avg(F.col("upper_aci") - F.col("lower_aci")).alias("width"),
        F.min_by("q", ts).alias("q_initial"),
        F.max_by("q", ts).alias("q_final"),
        F.max("q").alias("q_max"),
    )
