"""Declarative quality checks in one pass, with a hard-failing gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridcast.params import QualityParams

SCHEMA = "check string, column string, severity string, observed double, threshold double, success boolean"


@dataclass(frozen=True)
class Check:
    """``kind``: exists, not_null (null share at most ``limit``), between (share of known values in ``[low, high]`` at
    least ``limit``), unique (no value twice) or row_count (at least ``limit`` rows)."""

    kind: str
    column: str = ""
    limit: float = 0.0
    low: float | None = None
    high: float | None = None

    @property
    def severity(self) -> str:
        return "hard" if self.kind in ("exists", "unique", "row_count") else "soft"


def default_checks(p: QualityParams = QualityParams()) -> list[Check]:
    return [
        *[Check("exists", c) for c in (p.timestamp, p.load, p.wind, p.solar)],
        Check("not_null", p.load, p.max_null_fraction),
        Check("not_null", p.wind, p.max_null_fraction),
        Check("between", p.load, p.mostly, p.min_load, p.max_load),
        Check("between", p.wind, p.mostly, p.min_wind, p.max_wind),
        Check("unique", p.timestamp),
        Check("row_count", limit=p.min_rows),
    ]


def _plan(columns: Sequence[str], checks: Sequence[Check]) -> tuple[list[Column], list[Column]]:
    """The aggregates that the checks need over the rows, and each check's verdict from their values."""
    aggregates, verdicts = [F.count(F.lit(1)).alias("_rows")], []
    rows = F.col("_rows").cast("double")
    for i, c in enumerate(checks):
        present = c.column in columns
        threshold, success = F.lit(float(c.limit)), None
        if c.kind == "exists":
            observed, threshold = F.lit(float(present)), F.lit(1.0)
            success = F.lit(present)
        elif c.kind == "row_count":
            observed, success = rows, rows >= c.limit
        elif not present:
            observed, success = F.lit(None).cast("double"), F.lit(False)
        elif c.kind == "not_null":
            aggregates.append(F.count(c.column).alias(f"_a{i}"))
            observed = F.when(rows > 0, (rows - F.col(f"_a{i}")) / rows).otherwise(0.0)
            success = observed <= c.limit + 1e-12
        elif c.kind == "between":
            aggregates += [
                F.count(c.column).alias(f"_a{i}"),
                F.count_if(F.col(c.column).between(c.low, c.high)).alias(f"_b{i}"),
            ]
            observed = F.when(F.col(f"_a{i}") > 0, F.col(f"_b{i}") / F.col(f"_a{i}")).otherwise(1.0)
            success = observed >= c.limit - 1e-12
        elif c.kind == "unique":
            observed, threshold = F.col(f"_a{i}").cast("double"), F.lit(0.0)
            success = F.col(f"_a{i}") == 0
        else:
            raise ValueError(f"unknown check {c.kind!r}")
        verdicts.append(
            F.struct(
                F.lit(c.kind).alias("check"), F.lit(c.column).alias("column"), F.lit(c.severity).alias("severity"),
                observed.alias("observed"), threshold.alias("threshold"), success.alias("success"),
            )
        )
    return aggregates, verdicts


def _repeats(df: DataFrame, checks: Sequence[Check]) -> list[DataFrame]:
    """For each uniqueness check, one row with the number of rows whose value occurs more than once."""
    out = []
    for i, c in enumerate(checks):
        if c.kind == "unique" and c.column in df.columns:
            per_value = df.where(F.col(c.column).isNotNull()).groupBy(c.column).agg(F.count(F.lit(1)).alias("_n"))
            out.append(per_value.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias(f"_a{i}")))
    return out


def _verdict_rows(wide: DataFrame, repeats: Sequence[DataFrame], verdicts: Sequence[Column]) -> DataFrame:
    for r in repeats:
        wide = wide.crossJoin(F.broadcast(r))  # one row each
    return wide.select(F.inline(F.array(*verdicts)))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``check, column, severity, observed, threshold, success``.

    All share-type checks come from one aggregation over the data; each uniqueness check adds one grouping by its
    column. A check on a missing column fails.
    """
    aggregates, verdicts = _plan(df.columns, checks)
    return _verdict_rows(df.agg(*aggregates), _repeats(df, checks), verdicts)


def checks_on_write(df: DataFrame, checks: Sequence[Check], write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The checks ride along while ``df`` is written: returns the written table and the results of `run_checks`.

    ``write`` stores the frame it is given, with whatever projection it needs but all rows, and returns the stored table,
    in which a column to be unique must keep its name. Counts, nulls and ranges are observed during that one pass over
    ``df``, which isn't read again; a uniqueness check groups the stored column.
    """
    aggregates, verdicts = _plan(df.columns, checks)
    seen = Observation()
    stored = write(df.observe(seen, *aggregates))
    values = {k: int(v) for k, v in seen.get.items()}
    wide = df.sparkSession.createDataFrame([tuple(values.values())], ", ".join(f"`{k}` long" for k in values))
    return stored, _verdict_rows(wide, _repeats(stored, checks), verdicts)


def check_statistics(results: DataFrame) -> DataFrame:
    passed = F.count_if("success")
    return results.agg(
        F.count(F.lit(1)).alias("evaluated"), passed.alias("passed"), F.count_if(~F.col("success")).alias("failed")
    )


def quality_report(results: DataFrame, suite: str) -> DataFrame:
    """The whole result as one JSON text."""
    entry = F.struct("check", "column", "severity", "observed", "threshold", "success")
    body = F.struct(
        F.lit(suite).alias("suite"),
        F.min("success").alias("success"),
        F.array_sort(F.collect_list(entry)).alias("results"),
    )
    return results.agg(F.to_json(body).alias("report"))


def gate(df: DataFrame, results: DataFrame) -> DataFrame:
    """``df`` unchanged if every hard check passed; otherwise reading it raises.

    The verdict is part of the plan, so nothing downstream can run around it.
    """
    failed = F.concat_ws(", ", F.array_sort(F.collect_list(F.when(
        (F.col("severity") == "hard") & ~F.col("success"), F.concat_ws(":", "check", "column")))))
    verdict = results.agg(failed.alias("_failed")).select(
        F.when(F.col("_failed") == "", F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("hard quality checks failed: "), F.col("_failed"))).cast("boolean")
        ).alias("_passed")
    )
    return df.crossJoin(F.broadcast(verdict)).where("_passed").drop("_passed")  # one row


def require(results: DataFrame) -> None:
    """Raise now if a hard check failed (reads one row per failed check)."""
    failed = results.where((F.col("severity") == "hard") & ~F.col("success")).select("check", "column").collect()
    if failed:
        raise ValueError("hard quality checks failed: " + ", ".join(f"{r[0]}:{r[1]}" for r in failed))
