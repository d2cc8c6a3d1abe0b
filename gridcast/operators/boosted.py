"""Boosted-tree point forecaster with leaf-quantile interval heads, one model for all series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.conformal import conformal_offset, widen
from gridcast.operators.metrics import coverage, forecast_metrics, point_metrics, width
from gridcast.operators.model_meta import load_meta, save_meta
from gridcast.operators.quantiles import exact_quantiles
from gridcast.operators.split import walk_forward_folds
from gridcast.params import Axis, BoostParams, TrainParams
from gridcast.sources.tables import cut

VECTOR = "_features"


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature vector in the given column order; a missing column raises."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"feature columns missing: {missing}")
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error").transform(df)


def fit_point(
    df: DataFrame, features: Sequence[str], target: str, params: BoostParams = BoostParams(), validation: Column | None = None
) -> GBTRegressionModel:
    """Squared-loss boosting; with ``validation`` (true on held-out rows) training stops when their error stops falling."""
    rows = df
    trainer = GBTRegressor(
        featuresCol=VECTOR, labelCol=target, maxIter=params.trees, stepSize=params.learning_rate,
        maxDepth=params.max_depth, minInstancesPerNode=params.min_leaf, subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.column_share), validationTol=params.tolerance, seed=params.seed,
    )
    if validation is not None:
        rows = rows.withColumn("_held_out", validation)
        trainer = trainer.setValidationIndicatorCol("_held_out")
    return trainer.fit(assemble(rows, features))


def predict_point(model: GBTRegressionModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    return model.setPredictionCol("predicted").transform(assemble(df, features)).drop(VECTOR)


def importance(model: GBTRegressionModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Gain-based importance per feature, largest first."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


@dataclass(frozen=True)
class QuantileHeads:
    """A forest whose leaves hold target quantiles, as one row with an array (per tree) of maps from leaf to bounds."""

    forest: RandomForestRegressionModel
    leaves: DataFrame


def fit_quantile_heads(
    df: DataFrame, features: Sequence[str], target: str, lower: float, upper: float, params: BoostParams = BoostParams(),
    trees: int = 20,
) -> QuantileHeads:
    """Quantile forest: the target's quantiles among the training rows of each leaf.

    The leaf groups are bounded in number (trees x 2^depth); rows reach the quantile step as per-leaf sketches and
    counts, so the row x tree expansion isn't shuffled.
    """
    forest = RandomForestRegressor(
        featuresCol=VECTOR, labelCol=target, numTrees=trees, maxDepth=params.max_depth,
        minInstancesPerNode=params.min_leaf, seed=params.seed, leafCol="_leaf",
    ).fit(assemble(df, features))
    placed = forest.transform(assemble(df, features)).select(
        F.col(target).alias("_y"), F.posexplode(vector_to_array("_leaf")).alias("_tree", "_node")
    )
    bounds = exact_quantiles(placed, ["_tree", "_node"], "_y", {"lo": lower, "hi": upper})
    per_tree = bounds.groupBy("_tree").agg(
        F.map_from_entries(F.collect_list(F.struct("_node", F.struct("lo", "hi")))).alias("_leaves")
    )
    ordered = F.array_sort(F.collect_list(F.struct("_tree", F.map_entries("_leaves").alias("_leaves"))))
    packed = per_tree.agg(F.transform(ordered, lambda t: t["_leaves"]).alias("_table"))
    return QuantileHeads(forest, cut(packed))


def predict_quantiles(heads: QuantileHeads, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean of the leaf quantiles over the trees, as ``y_lower`` and ``y_upper``; no shuffle.

    The model's bounds, trees x 2^depth, are a constant of the plan, an array per tree that is read at the leaf's number;
    as a column they'd be copied with every row.
    """
    rows = df if VECTOR in df.columns else assemble(df, features)
    placed = heads.forest.transform(rows).withColumn("_leaf", vector_to_array("_leaf"))
    trees = [{int(e["key"]): e["value"] for e in tree} for tree in heads.leaves.first()["_table"]]

    def mean_of(side: str) -> Column:
        bounds = [[F.lit(t[n][side] if n in t else None) for n in range(max(t) + 1)] for t in trees]
        table = F.array(*[F.array(*b) for b in bounds])
        hits = F.zip_with(table, "_leaf", lambda leaves, node: F.get(leaves, node.cast("int")))
        return F.aggregate(hits, F.lit(0.0), lambda a, x: a + x) / F.size("_leaf")

    return placed.withColumn("y_lower", mean_of("lo")).withColumn("y_upper", mean_of("hi")).drop(
        "_leaf", VECTOR, "prediction"
    )


@dataclass(frozen=True)
class ForecastBundle:
    """Point model, interval heads (optional) and conformal offset, with the feature order they were trained on."""

    point: GBTRegressionModel
    heads: QuantileHeads | None
    features: tuple[str, ...]
    q: float = 0.0

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``predicted`` and, with heads, raw ``y_lower, y_upper`` and calibrated ``lower_bound, upper_bound``."""
        if self.heads is None:
            return predict_point(self.point, df, self.features)
        out = self.point.setPredictionCol("predicted").transform(assemble(df, self.features))  # one vector for both models
        out = predict_quantiles(self.heads, out, self.features)
        bounded = out.withColumn("lower_bound", F.col("y_lower")).withColumn("upper_bound", F.col("y_upper"))
        return widen(bounded, "lower_bound", "upper_bound", F.lit(self.q))

    def save(self, path: str) -> None:
        self.point.write().overwrite().save(f"{path}/point")
        if self.heads is not None:
            self.heads.forest.write().overwrite().save(f"{path}/forest")
            self.heads.leaves.write.mode("overwrite").parquet(f"{path}/leaves")
        save_meta(path, "boosted_trees", features=list(self.features), q=self.q, has_heads=self.heads is not None)

    @staticmethod
    def load(spark: SparkSession, path: str) -> ForecastBundle:
        meta, _ = load_meta(spark, path, "boosted_trees")
        heads = None
        if meta["has_heads"]:
            forest = RandomForestRegressionModel.load(f"{path}/forest")
            heads = QuantileHeads(forest, spark.read.parquet(f"{path}/leaves"))
        return ForecastBundle(GBTRegressionModel.load(f"{path}/point"), heads, tuple(meta["features"]), meta["q"])


def fit_bundle(
    df: DataFrame, features: Sequence[str], params: TrainParams = TrainParams(), intervals: bool = True, forest_trees: int = 20
) -> ForecastBundle:
    """Train on ``split = train``, stop early and calibrate on ``split = val``."""
    target = params.target
    used = df.where(F.col("split").isin("train", "val"))
    point = fit_point(used, features, target, params.boost, F.col("split") == "val")
    if not intervals:
        return ForecastBundle(point, None, tuple(features))
    train = used.where(F.col("split") == "train")
    heads = fit_quantile_heads(
        train, features, target, params.lower_alpha, params.upper_alpha, params.boost, forest_trees
    )
    val = predict_quantiles(heads, used.where(F.col("split") == "val"), features)
    alpha = 1.0 - (params.upper_alpha - params.lower_alpha)
    q = conformal_offset(val, [], alpha, target, "y_lower", "y_upper").first()["q"]
    return ForecastBundle(point, heads, tuple(features), float(q))


def bundle_metrics(bundle: ForecastBundle, df: DataFrame, target: str, prefix: str = "val_", by: Sequence[str] = ()) -> DataFrame:
    """Point metrics, and raw and calibrated interval coverage and width."""
    scored = bundle.score(df)
    columns = point_metrics(F.col(target), F.col("predicted"), prefix)
    if bundle.heads is not None:
        for lower, upper, tag in (("y_lower", "y_upper", "_raw"), ("lower_bound", "upper_bound", "")):
            columns.append(coverage(target, lower, upper).alias(f"{prefix}pi_coverage{tag}"))
            columns.append(width(lower, upper).alias(f"{prefix}pi_width{tag}"))
    return scored.groupBy(*by).agg(*columns)


def cross_validate(
    df: DataFrame, axis: Axis, features: Sequence[str], params: TrainParams = TrainParams()
) -> DataFrame:
    """Walk-forward validation of the point model: one row of metrics per fold.

    ``df`` is the training part. Folds are few and fixed in number; each fit is one distributed job.
    """
    folds = cut(walk_forward_folds(df, axis, params.folds))
    results = None
    for i in range(1, params.folds + 1):
        rows = folds.where(F.col("fold") == i)
        model = fit_point(rows, features, params.target, replace(params.boost), F.col("role") == "val")
        scored = predict_point(model, rows.where(F.col("role") == "val"), features)
        part = forecast_metrics(scored, ["fold"], params.target, "predicted", prefix="fold_")
        results = part if results is None else results.unionByName(part)
    return results
