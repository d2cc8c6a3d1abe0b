"""Whole jobs, each a chain of operators between two stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.operators import boosted, registry
from gridcast.operators.buckets import drop_helpers
from gridcast.operators.cleaning import RAW_COLUMNS, enforce_non_negative, normalise_columns
from gridcast.operators.conformal import adaptive_conformal
from gridcast.operators.drift import drift_summary, feature_drift, monitored_columns, window_rows
from gridcast.operators.explain import attributions, stable_sample
from gridcast.operators.features import build_feature_matrix, feature_names
from gridcast.operators.gaps import fill_gaps
from gridcast.operators.grid import make_grid
from gridcast.operators.metrics import concept_drift, error_columns, fold_summary, forecast_metrics
from gridcast.operators.model_store import Forecaster, production_model
from gridcast.operators.naive import fit_naive, seasonal_naive
from gridcast.operators.outliers import remove_outliers
from gridcast.operators.quality import Check, checks_on_write, default_checks, gate, quality_report, require, run_checks
from gridcast.operators.split import assign_split, check_split, split_metadata
from gridcast.operators.structural import fit_structural
from gridcast.params import AdaptiveParams, Axis, CleanParams, DriftParams, FeatureParams, SplitParams, TrainParams
from gridcast.sources.tables import TableLayout, cut


def clean(df: DataFrame, axis: Axis, params: CleanParams = CleanParams()) -> DataFrame:
    """Named columns to a clean panel: grid, gap filling, outliers, non-negative values.

    The filled panel is read several times (fences, then the rows), so it's written once in between.
    """
    columns = list(params.columns)
    filled = make_grid(df, axis, columns, keep_helpers=True)
    filled = fill_gaps(filled, axis, columns, params.max_gap, params.mode, params.causal, keep_helpers=True)
    out = remove_outliers(
        cut(filled), axis, columns, params.outlier_method, params.iqr_multiplier, params.contamination,
        params.refill_limit, params.fence_until, params.causal,
    )
    return enforce_non_negative(drop_helpers(out), params.non_negative)


def ingest(
    raw: DataFrame,
    axis: Axis,
    layout: TableLayout,
    params: CleanParams = CleanParams(),
    checks: Sequence[Check] | None = None,
    names: Mapping[str, str] = RAW_COLUMNS,
) -> DataFrame:
    """Quality gate, then cleaning. Cleaning reads the data through the gate, so a hard failure stops it.

    The raw files are read once: the checks are observed while the parsed readings are written. Without a series key in
    the raw data one constant series is assumed.
    """
    raw = raw if set(axis.keys) <= set(raw.columns) else raw.withColumn(axis.keys[0], F.lit("DE"))
    checks = checks or default_checks()
    if not set(names) <= set(raw.columns):  # nothing can be parsed; the report says which columns are missing
        results = cut(run_checks(raw, checks))
        layout.write(quality_report(results, "raw_readings"), "quality_report")
        require(results)
    unique = [c.column for c in checks if c.kind == "unique" and c.column in raw.columns and c.column not in {*axis.keys, *names.values()}]
    kept = list(dict.fromkeys([*axis.keys, *unique]))
    stored, results = checks_on_write(raw, checks, lambda rows: cut(normalise_columns(rows, names, axis.ts, kept)))
    results = cut(results)
    layout.write(quality_report(results, "raw_readings"), "quality_report")
    return layout.save(clean(gate(stored.drop(*unique), results), axis, params), "clean")


def prepare(
    cleaned: DataFrame,
    axis: Axis,
    layout: TableLayout,
    features: FeatureParams = FeatureParams(),
    split: SplitParams = SplitParams(),
    holidays: DataFrame | None = None,
) -> DataFrame:
    """Feature matrix, then the chronological split; both stored, the split with its metadata."""
    matrix = layout.save(build_feature_matrix(cleaned, axis, features, holidays), "features")
    labelled = layout.save(assign_split(matrix, axis.ts, split), "model_input")
    check_split(labelled, axis.ts).first()
    layout.write(split_metadata(labelled, axis.ts, features.target), "split_metadata")
    return labelled


@dataclass(frozen=True)
class TrainResult:
    bundle: boosted.ForecastBundle
    runs: DataFrame
    versions: DataFrame
    selection: DataFrame


def predictors(features: FeatureParams, exogenous: Sequence[str] = ("wind_mw", "solar_mw")) -> list[str]:
    return [*exogenous, *feature_names(features)]


def train_and_select(
    cleaned: DataFrame,
    labelled: DataFrame,
    axis: Axis,
    layout: TableLayout,
    params: TrainParams = TrainParams(),
    features: FeatureParams = FeatureParams(),
    exogenous: Sequence[str] = ("wind_mw", "solar_mw"),
    forest_trees: int = 20,
) -> TrainResult:
    """Seasonal naive, boosted trees (with walk-forward validation, interval heads and attributions) and structural model;
    the best validation error is promoted."""
    spark, target = labelled.sparkSession, params.target
    names = predictors(features, exogenous)
    train, val = labelled.where(F.col("split") == "train"), labelled.where(F.col("split") == "val")
    by: list[str] = []
    data_hash = layout.read(spark, "split_metadata").first()["train_data_hash"]

    def metrics_of(frame: DataFrame) -> dict[str, float]:
        return {k: v for k, v in frame.first().asDict().items() if v is not None and k != "n"}

    def record(model_type: str, metrics: Mapping[str, float]) -> tuple[str, DataFrame]:
        run_id = uuid.uuid4().hex
        return run_id, registry.run_rows(spark, run_id, model_type, model_type, metrics, data_hash=data_hash)

    history = cleaned.select(*axis.keys, axis.ts, target)
    naive = seasonal_naive(history, axis, target, params.season).drop(target)
    naive_val = val.select(*axis.keys, axis.ts, target).join(naive, [*axis.keys, axis.ts], "left")
    naive_id, runs = record("seasonal_naive", metrics_of(forecast_metrics(naive_val, by, target, "predicted", "val_")))
    known = labelled.select("split", *axis.keys, axis.ts, target).where(F.col("split") != "test")
    models: dict[str, tuple[str, Forecaster]] = {naive_id: ("seasonal_naive", fit_naive(known, axis, target, params.season))}

    bundle = boosted.fit_bundle(labelled, names, params, forest_trees=forest_trees)
    folds = cut(boosted.cross_validate(train.drop("split"), axis, names, params))
    metrics = metrics_of(boosted.bundle_metrics(bundle, val, target))
    metrics |= metrics_of(fold_summary(folds, [], "fold_mape"))
    metrics |= {"conformal_q": bundle.q, "best_iteration": float(bundle.point.getNumTrees)}
    boosted_id, rows = record("boosted_trees", metrics)
    runs = runs.unionByName(rows)
    for fold in folds.collect():  # one row per fold
        values = {m: fold[m] for m in ("fold_mape", "fold_rmse", "fold_mae")}
        runs = runs.unionByName(
            registry.run_rows(
                spark, uuid.uuid4().hex, f"fold_{fold['fold']}", "boosted_trees", values, boosted_id, fold["fold"], data_hash
            )
        )
    models[boosted_id] = ("boosted_trees", bundle)
    layout.write(boosted.importance(bundle.point, names, spark), "feature_importance")
    explained = val if params.explain_rows is None else stable_sample(val, [*axis.keys, axis.ts], params.explain_rows)
    layout.write(attributions(bundle.point, explained, names, [*axis.keys, axis.ts]), "attributions")

    structural = fit_structural(train.select(*axis.keys, axis.ts, target), axis, params)
    predicted = structural.predict(val.select(*axis.keys, axis.ts, target))
    structural_id, rows = record("structural", metrics_of(forecast_metrics(predicted, by, target, "predicted", "val_")))
    models[structural_id] = ("structural", structural)
    layout.append(runs.unionByName(rows), "runs")
    runs = layout.read(spark, "runs", registry.RUN_SCHEMA)

    paths = {run_id: f"{layout.root}/06_models/{name}/{run_id}" for run_id, (name, _) in models.items()}
    for run_id, (_, model) in models.items():
        model.save(paths[run_id])
    log = layout.read_or_empty(spark, "model_versions", registry.VERSION_LOG_SCHEMA)
    selection, changes = registry.record_training(runs, paths, log, require_improvement=params.require_improvement)
    selection, changes = cut(selection), cut(changes)  # both read the log that is about to grow
    layout.write(selection, "model_selection")
    layout.append(changes, "model_versions")
    return TrainResult(bundle, runs, layout.read(spark, "model_versions", registry.VERSION_LOG_SCHEMA), selection)


def inference(
    model: Forecaster,
    labelled: DataFrame,
    axis: Axis,
    layout: TableLayout,
    target: str = "load_mw",
    adaptive: AdaptiveParams | None = AdaptiveParams(),
    drift: DriftParams | None = None,
) -> DataFrame:
    """Score the test part with fixed and adaptive intervals; then, if periods are given, feature drift and monthly error
    drift. Any stored model will do; the intervals of one that has none are NULL."""
    test = labelled.where(F.col("split") == "test")
    scored = model.score(test)
    kept = [*axis.keys, axis.ts, F.col(target).alias("actual"), "predicted"]
    bounds = ("y_lower", "y_upper", "lower_bound", "upper_bound")
    intervals = [F.col(c) if c in scored.columns else F.lit(None).cast("double").alias(c) for c in bounds]
    out = scored.select(*kept, *intervals)
    if adaptive is not None:
        out = adaptive_conformal(
            out.withColumn("_q0", F.lit(float(getattr(model, "q", 0.0)))), axis.keys, axis.ts, adaptive, "actual", initial_q="_q0"
        ).drop("_q0")
    predictions = layout.save(error_columns(out, "actual", "predicted"), "predictions")
    if drift is None:
        return predictions

    watched = monitored_columns(labelled.drop("split"), target)
    results = cut(feature_drift(labelled, axis.ts, drift, watched))
    layout.write(results, "drift_results")
    counts = window_rows(labelled, axis.ts, drift)
    reference = counts.where(F.col("window") == drift.reference.label).select(
        F.lit(f"{drift.reference.start} → {drift.reference.end}").alias("period"), "n_rows",
        F.lit("reference_baseline").alias("status"), F.lit(len(watched)).alias("n_features"),
    )
    layout.write(reference.select(F.to_json(F.struct("*")).alias("value")), "drift_reference")
    summary = drift_summary(results, drift.windows, counts)
    layout.write(summary.select(F.to_json(F.struct("*")).alias("value")), "drift_analysis")
    monthly = concept_drift(
        predictions, axis.keys, axis.ts, "actual", drift.perturb_start, drift.perturb_end, drift.flag_ratio
    )
    layout.write(monthly, "concept_drift")
    return predictions


def full(
    raw: DataFrame,
    axis: Axis,
    layout: TableLayout,
    clean_params: CleanParams = CleanParams(),
    features: FeatureParams = FeatureParams(),
    split: SplitParams = SplitParams(),
    train: TrainParams = TrainParams(),
    drift: DriftParams | None = None,
    checks: Sequence[Check] | None = None,
    forest_trees: int = 20,
) -> TrainResult:
    """Everything from raw readings to drift reports. The model in production scores, whichever kind it is."""
    cleaned = ingest(raw, axis, layout, clean_params, checks)
    labelled = prepare(cleaned, axis, layout, features, split)
    result = train_and_select(cleaned, labelled, axis, layout, train, features, forest_trees=forest_trees)
    model = production_model(raw.sparkSession, result.versions)
    inference(model, labelled, axis, layout, train.target, drift=drift)
    return result


JOBS = {
    "ingest": ingest,
    "prepare": prepare,
    "train_and_select": train_and_select,
    "inference": inference,
    "full": full,
}
