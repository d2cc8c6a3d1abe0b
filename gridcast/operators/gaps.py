"""Null runs and time-linear gap filling on a complete grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.operators.buckets import IDX, drop_helpers, neighbours
from gridcast.params import Axis


def _run_length(c: str) -> Column:
    """Length of the null run a row sits in; leading and trailing runs end at the series' edge."""
    before = F.coalesce(F.col(f"_prev_{c}.i"), F.col("_start") - 1)
    after = F.coalesce(F.col(f"_next_{c}.i"), F.col("_end") + 1)
    return F.when(F.col(c).isNull(), after - before - 1)


def _run_position(c: str) -> Column:
    return F.when(F.col(c).isNull(), F.col(IDX) - F.coalesce(F.col(f"_prev_{c}.i"), F.col("_start") - 1))


def _filled(c: str, limit: int | None, causal: bool) -> Column:
    """Value on the line between the known neighbours; after the last known point its value is repeated."""
    prev, nxt = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
    share = (F.col(IDX) - prev["i"]) / (nxt["i"] - prev["i"])
    line = prev["v"] if causal else F.when(nxt.isNull(), prev["v"]).otherwise(prev["v"] + (nxt["v"] - prev["v"]) * share)
    allowed = prev.isNotNull() if limit is None else prev.isNotNull() & (F.col(IDX) - prev["i"] <= limit)
    return F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(allowed, line)


def _clean_up(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    scratch = [f"_{side}_{c}" for c in columns for side in ("prev", "next", "short")]
    return df.drop("_start", "_end", *scratch)


def label_null_runs(df: DataFrame, axis: Axis, column: str) -> DataFrame:
    """Rows inside null runs with the run's first timestamp index (``run_id``), length and the row's position in it."""
    out = neighbours(df, axis, [column])
    start = F.coalesce(F.col(f"_prev_{column}.i") + 1, F.col("_start"))
    out = out.where(F.col(column).isNull()).select(
        *axis.keys,
        axis.ts,
        start.alias("run_id"),
        _run_length(column).alias("run_length"),
        _run_position(column).alias("run_position"),
    )
    return out


def fill_gaps(
    df: DataFrame,
    axis: Axis,
    columns: Sequence[str],
    max_gap: int = 6,
    mode: str = "reference",
    causal: bool = False,
    keep_helpers: bool = False,
) -> DataFrame:
    """Interpolate nulls on a complete grid.

    ``mode="strict"`` fills only runs of at most ``max_gap`` steps. ``mode="reference"`` fills the first ``max_gap``
    steps of every run of a column, provided the column has at least one run that short (leading and trailing runs
    count); otherwise it fills nothing. Leading nulls stay; trailing nulls repeat the last value. ``causal`` carries the
    last value instead of looking at the next one.
    """
    if mode not in ("reference", "strict"):
        raise ValueError(f"unknown fill mode {mode!r}: use 'reference' or 'strict'")
    out = neighbours(df, axis, columns, short_run=max_gap if mode == "reference" else None)
    filled = {}
    for c in columns:
        value = _filled(c, max_gap, causal)
        may_fill = F.col(f"_short_{c}") if mode == "reference" else _run_length(c) <= max_gap
        filled[c] = F.when(F.col(c).isNotNull() | may_fill, value)
    out = _clean_up(out.withColumns(filled), columns)
    return out if keep_helpers else drop_helpers(out)


def fill_limited(
    df: DataFrame, axis: Axis, columns: Sequence[str], limit: int = 24, causal: bool = False, keep_helpers: bool = False
) -> DataFrame:
    """Interpolate the first ``limit`` steps of every null run (used after outliers were removed)."""
    out = neighbours(df, axis, columns)
    out = _clean_up(out.withColumns({c: _filled(c, limit, causal) for c in columns}), columns)
    return out if keep_helpers else drop_helpers(out)
