"""Run and model-version tables: append-only records, winner selection and stage changes as pure functions.

The version table is a log: a version's row is never changed, a new stage is a new row with a higher ``change`` number, and
`current_versions` gives the newest row of each version. Readers so see either the registry before a promotion or after it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "run_id string, run_name string, model_type string, parent_run_id string, fold_index int, metric string, "
    "value double, data_hash string"
)
VERSION_SCHEMA = "version int, run_id string, path string, stage string"
VERSION_LOG_SCHEMA = VERSION_SCHEMA + ", change int"


def run_rows(
    spark: SparkSession,
    run_id: str,
    run_name: str,
    model_type: str,
    metrics: Mapping[str, float],
    parent_run_id: str | None = None,
    fold_index: int | None = None,
    data_hash: str | None = None,
) -> DataFrame:
    """One row per metric of a run, to be appended to the runs table."""
    rows = [(run_id, run_name, model_type, parent_run_id, fold_index, m, float(v), data_hash) for m, v in metrics.items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def candidates(runs: DataFrame) -> DataFrame:
    """Top-level runs with their validation metrics as columns."""
    picked = {m: F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in ("val_mape", "val_rmse", "val_mae")}
    return runs.where(F.col("parent_run_id").isNull()).groupBy("run_id", "model_type").agg(*picked.values())


def ranked_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    """Candidates by validation MAPE, best first."""
    return candidates(runs).orderBy(F.asc_nulls_last("val_mape"), "val_rmse", "model_type").limit(limit)


def fold_rows(runs: DataFrame, metric: str = "fold_mape") -> DataFrame:
    """Fold metrics by fold number, read from run names of the form ``fold_<i>``, with their mean."""
    folds = runs.where(F.col("run_name").startswith("fold_") & (F.col("metric") == metric))
    number = F.split("run_name", "_")[1].cast("int")
    whole = Window.partitionBy("parent_run_id")  # one row per fold
    return folds.select(
        "parent_run_id", number.alias("fold"), F.col("value").alias(metric), F.avg("value").over(whole).alias("mean")
    ).orderBy("parent_run_id", "fold")


def register_version(versions: DataFrame, run_id: str, path: str) -> DataFrame:
    """The row for a new version, numbered one above the largest so far."""
    return versions.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).cast("int").alias("version")).select(
        "version", F.lit(run_id).alias("run_id"), F.lit(path).alias("path"), F.lit("None").alias("stage")
    )


def _winner(table: DataFrame, metric: str) -> DataFrame:
    order = F.struct(F.col(metric), F.col("val_rmse"), F.col("model_type"))
    known = table.where(F.col(metric).isNotNull())
    return known.agg(F.min_by("run_id", order).alias("_best"), F.min(metric).alias("_best_value"))


def _promotion(table: DataFrame, versions: DataFrame, metric: str, require_improvement: bool) -> DataFrame:
    """One row: winning run, its newest version, and whether it may be promoted."""
    best = _winner(table, metric)
    out = versions.crossJoin(F.broadcast(best)).agg(
        F.max(F.when(F.col("run_id") == F.col("_best"), F.col("version"))).alias("_version"),
        F.max(F.when(F.col("stage") == "Production", F.col("run_id"))).alias("_incumbent"),
    )
    out = out.crossJoin(F.broadcast(best))
    allowed = F.col("_version").isNotNull()
    if require_improvement:
        old = table.select(F.col("run_id").alias("_incumbent"), F.col(metric).alias("_old"))
        out = out.join(old, "_incumbent", "left")
        allowed = allowed & (F.col("_old").isNull() | (F.col("_best_value") < F.col("_old")))
    return out.select("_best", "_version", allowed.alias("_allowed"))  # one row


def select_model(
    table: DataFrame, versions: DataFrame, metric: str = "val_mape", require_improvement: bool = False
) -> DataFrame:
    """Candidates, best first, with ``promoted`` set on the winner. Ties go to RMSE, then to the model's name. Nothing is
    promoted when the winner has no registered version or, with ``require_improvement``, doesn't beat the incumbent."""
    choice = _promotion(table, versions, metric, require_improvement)
    out = table.crossJoin(F.broadcast(choice))
    promoted = F.col("_allowed") & (F.col("run_id") == F.col("_best"))
    return out.withColumn("promoted", promoted).drop("_best", "_version", "_allowed").orderBy(
        F.asc_nulls_last(metric), "val_rmse", "model_type"
    )


def promote(
    table: DataFrame, versions: DataFrame, metric: str = "val_mape", require_improvement: bool = False
) -> DataFrame:
    """Versions after the winner's newest version went to Production; versions staged or in production before are
    archived."""
    choice = _promotion(table, versions, metric, require_improvement)
    moved = F.when(~F.col("_allowed"), F.col("stage")).when(
        F.col("version") == F.col("_version"), "Production"
    ).when(F.col("stage").isin("Staging", "Production"), "Archived").otherwise(F.col("stage"))
    return versions.crossJoin(F.broadcast(choice)).withColumn("stage", moved).drop("_best", "_version", "_allowed")


def current_versions(log: DataFrame) -> DataFrame:
    """The newest row of every version in the log."""
    newest = log.groupBy("version").agg(F.max_by(F.struct("run_id", "path", "stage"), "change").alias("_row"))
    return newest.select("version", "_row.run_id", "_row.path", "_row.stage")


def version_changes(before: DataFrame, after: DataFrame, log: DataFrame) -> DataFrame:
    """The rows to append to the log: versions that are new or whose stage changed, under one new change number."""
    old = before.select("version", F.col("stage").alias("_old"))
    number = log.agg((F.coalesce(F.max("change"), F.lit(0)) + 1).cast("int").alias("change"))
    changed = after.join(old, "version", "left").where(~F.col("stage").eqNullSafe(F.col("_old")))
    return changed.drop("_old").crossJoin(F.broadcast(number)).select("version", "run_id", "path", "stage", "change")  # one number


def register_versions(versions: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """``versions`` and a new one for each run id of ``paths``, numbered on from the largest so far in the given order."""
    spark = versions.sparkSession
    rows = [(i, run_id, path) for i, (run_id, path) in enumerate(paths.items(), 1)]
    new = spark.createDataFrame(rows, "_at int, run_id string, path string")
    last = versions.agg(F.coalesce(F.max("version"), F.lit(0)).alias("_last"))
    number = (F.col("_last") + F.col("_at")).cast("int").alias("version")
    numbered = new.crossJoin(F.broadcast(last)).select(number, "run_id", "path", F.lit("None").alias("stage"))  # one number
    return versions.select("version", "run_id", "path", "stage").unionByName(numbered)


def record_training(
    runs: DataFrame, paths: Mapping[str, str], log: DataFrame, metric: str = "val_mape", require_improvement: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Register the models of one training (run id to path), promote its best run, and give the selection table and the
    rows to append to the version log. ``runs`` are all recorded runs, so that the incumbent's error is known."""
    before = current_versions(log)
    registered = register_versions(before, paths)
    table = candidates(runs)
    ours = table.where(F.col("run_id").isin(list(paths)))
    contest = table.join(before.where("stage = 'Production'").select("run_id"), "run_id", "left_semi").unionByName(ours) if require_improvement else ours
    selection = select_model(contest, registered, metric, require_improvement).where(F.col("run_id").isin(list(paths)))
    return selection, version_changes(before, promote(contest, registered, metric, require_improvement), log)


def production_path(log: DataFrame) -> str:
    """Where the model in production is stored; an error if there is none."""
    row = current_versions(log).where("stage = 'Production'").orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError("no model version is in production")
    return row["path"]
