"""Trained forecasters: rows-only checks. Features, folds and forest are the package's defaults; boosting grows ``TREES`` trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcast.operators.boosted import bundle_metrics, cross_validate, fit_bundle, importance
from gridcast.operators.explain import attributions
from gridcast.operators.features import build_feature_matrix, feature_names, history_features
from gridcast.operators.metrics import forecast_metrics
from gridcast.operators.requests import check_requests, forecast_requests, valid_requests
from gridcast.operators.split import assign_split, split_part
from gridcast.operators.structural import fit_structural
from gridcast.params import BoostParams, FeatureParams, TrainParams
from gridcast.plans.catalog.base import HOURLY, SPLIT, filled, query, rounded
from gridcast.plans.catalog.features import _requests
from gridcast.sources.tables import cut

TREES = 16  # of the default 500, so that a query ends within a minute on one machine; the step is larger instead
FEATURES = FeatureParams(target="y")
TRAIN = TrainParams(target="y", boost=BoostParams(trees=TREES, learning_rate=0.3))
NAMES = feature_names(FEATURES)


def matrix(spark, sf):
    """Feature matrix of the hourly panel by event type, split in time; read many times by training, so written once."""
    return cut(assign_split(build_feature_matrix(filled(spark, sf), HOURLY, FEATURES), "ts", SPLIT))


def bundle(spark, sf, intervals: bool = True):
    rows = matrix(spark, sf)
    return rows, fit_bundle(rows, NAMES, TRAIN, intervals)


@query()
def boosted_forecast(spark, sf):
    """Point forecast with raw and calibrated interval for the test part."""
    rows, model = bundle(spark, sf)
    scored = model.score(split_part(rows, "test"))
    return scored.select("series_id", "ts", "y", "predicted", "y_lower", "y_upper", "lower_bound", "upper_bound")


@query()
def boosted_validation(spark, sf):
    rows, model = bundle(spark, sf)
    return bundle_metrics(model, rows.where(F.col("split") == "val"), "y", by=["series_id"])


@query()
def boosted_cross_validation(spark, sf):
    return cross_validate(split_part(matrix(spark, sf), "train"), HOURLY, NAMES, TRAIN)


@query()
def boosted_importance(spark, sf):
    _, model = bundle(spark, sf, intervals=False)
    return importance(model.point, NAMES, spark)


@query()
def boosted_attributions(spark, sf):
    """Additive attributions of every validation row."""
    rows, model = bundle(spark, sf, intervals=False)
    return attributions(model.point, rows.where(F.col("split") == "val"), NAMES, ["series_id", "ts"])


@query()
def structural_forecast(spark, sf):
    rows = cut(assign_split(filled(spark, sf).where(F.col("y").isNotNull()), "ts", SPLIT))
    model = fit_structural(split_part(rows, "train"), HOURLY, TRAIN)
    return rounded(model.predict(split_part(rows, "val")), "predicted")


@query()
def structural_validation(spark, sf):
    rows = cut(assign_split(filled(spark, sf).where(F.col("y").isNotNull()), "ts", SPLIT))
    model = fit_structural(split_part(rows, "train"), HOURLY, TRAIN)
    return forecast_metrics(model.predict(split_part(rows, "val")), ["series_id"], "y", "predicted", "val_")


@query()
def scored_requests(spark, sf):
    """Forecasts for every valid request, features from the history known at its start."""
    panel = cut(filled(spark, sf))
    _, model = bundle(spark, sf)
    history = history_features(panel, HOURLY, "y", FEATURES.lags, FEATURES.windows).drop("y")
    anchors = panel.groupBy("series_id").agg(
        (F.unix_seconds(F.min("ts").cast("timestamp")) / 3600).cast("bigint").alias("start_idx")
    )
    requests = valid_requests(check_requests(_requests(spark, sf)))
    return forecast_requests(model, requests, HOURLY, FEATURES, history, anchors)
