"""Model history: two trainings recorded in appended tables, models stored by version and loaded by stage; importances."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcast.operators import registry
from gridcast.operators.metrics import forecast_metrics
from gridcast.operators.model_store import production_model
from gridcast.operators.naive import fit_naive
from gridcast.operators.permutation import METRICS, permutation_importance
from gridcast.plans.catalog.base import HOURLY, filled, query, rounded, sql_filled, sql_r4, table, with_
from gridcast.sources.tables import TableLayout, cut, shared_folder

# Ends of the training and validation part of each training.
ROUNDS = (("2024-01-12 23:00:00", "2024-01-17 23:00:00"), ("2024-01-20 23:00:00", "2024-01-25 23:00:00"))
SEASONS = (24, 48, 168)


def _train_twice(spark, sf):
    """Every round fits a seasonal profile of each length on the panel, records its run and version, and promotes the best."""
    layout = TableLayout(f"{shared_folder(spark)}/gridcast/history-{uuid.uuid4().hex}")
    panel = cut(filled(spark, sf))
    for number, (train_end, val_end) in enumerate(ROUNDS, 1):
        at = F.col("ts")
        train, val = panel.where(at <= train_end), panel.where((at > train_end) & (at <= val_end))
        runs, paths = None, {}
        for season in SEASONS:
            run_id = f"round{number}-{season}"
            model = fit_naive(train, HOURLY, "y", season)
            paths[run_id] = f"{layout.root}/06_models/{run_id}"
            model.save(paths[run_id])
            metrics = forecast_metrics(model.score(val), [], "y", "predicted", "val_").first().asDict()
            rows = registry.run_rows(spark, run_id, run_id, f"naive_{season}", {m: v for m, v in metrics.items() if v is not None and m != "n"})
            runs = rows if runs is None else runs.unionByName(rows)
        layout.append(runs, "runs")
        log = layout.read_or_empty(spark, "model_versions", registry.VERSION_LOG_SCHEMA)
        recorded = layout.read(spark, "runs", registry.RUN_SCHEMA)
        _, changes = registry.record_training(recorded, paths, log)
        layout.append(cut(changes), "model_versions")
    return layout, panel


def _sql_round(number: int) -> str:
    train_end, val_end = ROUNDS[number - 1]
    steps = f"(epoch(f.ts - TIMESTAMP '{train_end}') / 3600)::BIGINT"
    return ",\n".join([
        f"s{number} AS (SELECT s.season, f.series_id, f.ts, f.y, p.y AS predicted FROM filled f CROSS JOIN (VALUES {', '.join(f'({s})' for s in SEASONS)}) s(season) "
        f"LEFT JOIN filled p ON p.series_id = f.series_id AND p.ts = f.ts - to_hours(s.season * (({steps} + s.season - 1) // s.season)) WHERE f.ts > TIMESTAMP '{train_end}')",
        f"m{number} AS (SELECT {number} AS round, season, avg(CASE WHEN y <> 0 THEN abs((y - predicted) / y) END) * 100 AS val_mape, sqrt(avg((y - predicted) * (y - predicted))) AS val_rmse, "
        f"avg(abs(y - predicted)) AS val_mae FROM s{number} WHERE ts <= TIMESTAMP '{val_end}' AND y IS NOT NULL AND predicted IS NOT NULL GROUP BY season)",
    ])


_HISTORY = with_(
    sql_filled(), _sql_round(1), _sql_round(2),
    "m AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2)",
    "v AS (SELECT *, CAST(row_number() OVER (ORDER BY round, season) AS INTEGER) AS version, "
    "row_number() OVER (PARTITION BY round ORDER BY val_mape, val_rmse, 'naive_' || season) = 1 AS won FROM m)",
)


@query(
    _HISTORY
    + "SELECT version, 'round' || round || '-' || season AS run_id, 'naive_' || season AS model_type, "
    "CASE WHEN won AND round = 2 THEN 'Production' WHEN won THEN 'Archived' ELSE 'None' END AS stage, "
    f"{sql_r4('val_mape')} AS val_mape, {sql_r4('val_rmse')} AS val_rmse, {sql_r4('val_mae')} AS val_mae FROM v"
)
def model_history(spark, sf):
    """Versions of two trainings with their present stage and their run's metrics: one in production, the earlier winner archived."""
    layout, _ = _train_twice(spark, sf)
    versions = registry.current_versions(layout.read(spark, "model_versions", registry.VERSION_LOG_SCHEMA))
    runs = registry.candidates(layout.read(spark, "runs", registry.RUN_SCHEMA))
    return rounded(versions.drop("path").join(runs, "run_id"), "val_mape", "val_rmse", "val_mae")


@query(
    _HISTORY
    + "SELECT version, run_id, stage, change FROM (SELECT version, 'round' || round || '-' || season AS run_id, "
    "CASE WHEN won THEN 'Production' ELSE 'None' END AS stage, CAST(round AS INTEGER) AS change FROM v "
    "UNION ALL SELECT version, 'round' || round || '-' || season, 'Archived', 2 FROM v WHERE won AND round = 1)"
)
def version_log(spark, sf):
    """Every appended row of the version table: what was registered and what changed, by training."""
    layout, _ = _train_twice(spark, sf)
    return layout.read(spark, "model_versions", registry.VERSION_LOG_SCHEMA).select("version", "run_id", "stage", "change")


@query(
    _HISTORY
    + f"SELECT series_id, ts, y, predicted FROM s2 WHERE ts > TIMESTAMP '{ROUNDS[1][1]}' AND season = (SELECT season FROM v WHERE won AND round = 2)"
)
def production_forecast(spark, sf):
    """The later time scored with the model that is in production, loaded from its stored version."""
    layout, panel = _train_twice(spark, sf)
    model = production_model(spark, layout.read(spark, "model_versions", registry.VERSION_LOG_SCHEMA))
    return model.score(panel.where(F.col("ts") > ROUNDS[1][1])).select("series_id", "ts", "y", "predicted")


# ---- permutation importance of a fixed linear model -------------------------------------------------------------------

LINEAR = {"hour": 40.0, "day": 3.0, "user_id": 0.5}


def _sql_linear(values: dict[str, str]) -> str:
    return " + ".join(f"{w} * {values[c]}" for c, w in LINEAR.items()) + " + 1000"


_ROWS = """rows_ AS (SELECT event_id, CAST(round(value * 100) AS BIGINT)::DOUBLE AS y, hour(ts) AS hour, day(ts) AS day, user_id,
  row_number() OVER (ORDER BY md5(concat_ws('|', '42', 'rows', event_id)), event_id) AS pos FROM events)"""
_PARTS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, r.y, {_sql_linear({c: f'd.{c}' if c == f else f'r.{c}' for c in LINEAR})} AS p FROM rows_ r JOIN "
    f"(SELECT {f}, row_number() OVER (ORDER BY md5(concat_ws('|', '42', '{f}', '0', event_id)), event_id) AS pos FROM rows_) d USING (pos)"
    for f in LINEAR
)
_ERRORS = "avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 AS mape, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae"


@query(
    with_(_ROWS, f"base AS (SELECT {_ERRORS} FROM (SELECT y, {_sql_linear({c: c for c in LINEAR})} AS p FROM rows_))", f"shuffled AS (SELECT feature, {_ERRORS} FROM ({_PARTS}) GROUP BY 1)")
    + f"SELECT feature, {', '.join(sql_r4(f's.{m} - b.{m}') + f' AS {m}_growth' for m in METRICS)} FROM shuffled s, base b"
)
def permutation_importances(spark, sf):
    """Error growth of a fixed linear forecast of event values when its hour, day or user is permuted."""
    y = F.round(F.col("value") * 100).cast("bigint").cast("double").alias("y")
    rows = table(spark, sf, "events").select("event_id", y, F.hour("ts").alias("hour"), F.dayofmonth("ts").alias("day"), "user_id")
    linear = lambda df: df.withColumn("predicted", sum((F.col(c) * w for c, w in LINEAR.items()), F.lit(1000.0)))
    out = permutation_importance(rows, ["event_id"], list(LINEAR), linear, "y")
    return rounded(out, *[f"{m}_growth" for m in METRICS])
