"""Stored forecasters of every kind, loaded by path or by stage; each has ``score``, which adds ``predicted``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridcast.operators.boosted import ForecastBundle
from gridcast.operators.model_meta import stored_kind
from gridcast.operators.naive import NaiveModel
from gridcast.operators.registry import production_path
from gridcast.operators.structural import StructuralModel

KINDS = {"seasonal_naive": NaiveModel, "boosted_trees": ForecastBundle, "structural": StructuralModel}
Forecaster = NaiveModel | ForecastBundle | StructuralModel


def load_model(spark: SparkSession, path: str) -> Forecaster:
    """The model stored under ``path``, of whatever kind; an unknown kind raises."""
    kind = stored_kind(spark, path)
    if kind not in KINDS:
        raise ValueError(f"{path} holds a model of unknown kind {kind!r}")
    return KINDS[kind].load(spark, path)


def production_model(spark: SparkSession, log: DataFrame) -> Forecaster:
    """The model that the version log has in production."""
    return load_model(spark, production_path(log))
