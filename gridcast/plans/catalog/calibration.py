"""Forecast metrics, interval calibration and drift."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from gridcast.functions.timegrid import month_text
from gridcast.operators.conformal import adaptive_conformal, adaptive_summary, conformal_offset, widen
from gridcast.operators.drift import drift_pivot, drift_statistics, drift_summary, feature_drift, window_rows
from gridcast.operators.grid import make_grid
from gridcast.operators.metrics import concept_drift, error_columns, fold_summary, forecast_metrics, forecast_metrics_rollup, interval_metrics
from gridcast.operators.naive import naive_run, seasonal_naive
from gridcast.operators.skew import join_groups
from gridcast.operators.split import assign_split, split_part, walk_forward_folds
from gridcast.params import AdaptiveParams, DriftParams, DriftWindow
from gridcast.plans.catalog.base import (
    DAILY, HOURLY, SPLIT, SQL_DAILY, daily, filled, grid, hourly, query, rounded, sql_filled, sql_grid, sql_hourly, sql_r4,
    sql_split, with_,
)
from gridcast.sources.tables import cut

_METRICS = (
    f"count(*) AS n, {sql_r4('avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100')} AS mape, "
    f"{sql_r4('sqrt(avg((y - p) * (y - p)))')} AS rmse, {sql_r4('avg(abs(y - p))')} AS mae"
)


def scored(spark, sf, series: str = "event_type", season: int = 24):
    """Daily-naive forecast of the filled panel with fixed raw bounds around it; rows with a known forecast."""
    out = seasonal_naive(filled(spark, sf, series), HOURLY, "y", season)
    out = out.where(F.col("predicted").isNotNull() & F.col("y").isNotNull())
    return out.withColumn("y_lower", F.col("predicted") * 0.8).withColumn("y_upper", F.col("predicted") * 1.2)


def sql_scored(series: str = "event_type", season: int = 24) -> str:
    return (
        sql_filled(series)
        + f""",
scored AS (SELECT *, p * 0.8 AS y_lower, p * 1.2 AS y_upper FROM (
  SELECT series_id, ts, y, lag(y, {season}) OVER (PARTITION BY series_id ORDER BY ts) AS p FROM filled)
  WHERE p IS NOT NULL AND y IS NOT NULL)"""
    )


@query(
    with_(sql_scored("user_id"))
    + f"SELECT series_id, {_METRICS}, {sql_r4('avg(CASE WHEN abs(y) + abs(p) <> 0 THEN 2 * abs(y - p) / (abs(y) + abs(p)) END) * 100')} AS smape "
    "FROM scored GROUP BY 1"
)
def forecast_errors_by_user(spark, sf):
    out = forecast_metrics(scored(spark, sf, "user_id"), ["series_id"], "y", "predicted", with_smape=True)
    return rounded(out, "mape", "rmse", "mae", "smape")


@query(
    with_(sql_scored("user_id"))
    + f"SELECT series_id, month, CAST(bit_count(GROUPING_ID(series_id, month)) AS INTEGER) AS level, {_METRICS} FROM (SELECT *, strftime(ts, '%Y-%m') AS month FROM scored) "
    "GROUP BY ROLLUP (series_id, month)"
)
def forecast_errors_rollup(spark, sf):
    """Errors per series and month, per series, and in all."""
    rows = scored(spark, sf, "user_id").withColumn("month", month_text(F.col("ts")))
    return rounded(forecast_metrics_rollup(rows, ["series_id", "month"], "y", "predicted"), "mape", "rmse", "mae")


@query(
    with_(sql_filled(), f"s AS (SELECT *, lag(y, 168) OVER (PARTITION BY series_id ORDER BY ts) AS p, {sql_split()} AS split FROM filled)")
    + f"SELECT series_id, {_METRICS.replace('AS mape', 'AS val_mape').replace('AS rmse', 'AS val_rmse').replace('AS mae', 'AS val_mae')} "
    "FROM s WHERE split = 'val' AND p IS NOT NULL AND y IS NOT NULL GROUP BY 1"
)
def naive_validation(spark, sf):
    """Seasonal naive judged on the validation part; its first week reads the training part."""
    out = naive_run(assign_split(filled(spark, sf), "ts", SPLIT), HOURLY, "y", 168, ["series_id"])
    return rounded(out, "val_mape", "val_rmse", "val_mae")


@query(
    with_(sql_scored())
    + f"SELECT series_id, ts, {sql_r4('abs(y - p)')} AS abs_error, "
    f"{sql_r4('CASE WHEN y <> 0 THEN abs(y - p) / abs(y) * 100 END')} AS mape_contribution FROM scored"
)
def error_rows(spark, sf):
    out = error_columns(scored(spark, sf), "y", "predicted").select("series_id", "ts", "abs_error", "mape_contribution")
    return rounded(out, "abs_error", "mape_contribution")


_COVERAGE = f"{sql_r4('avg(CASE WHEN y BETWEEN y_lower AND y_upper THEN 1 ELSE 0 END)')} AS coverage, {sql_r4('avg(y_upper - y_lower)')} AS width"


@query(with_(sql_scored("user_id")) + f"SELECT series_id, count(*) AS n, {_COVERAGE} FROM scored GROUP BY 1")
def interval_coverage(spark, sf):
    out = interval_metrics(scored(spark, sf, "user_id"), ["series_id"], "y", "y_lower", "y_upper")
    return rounded(out, "coverage", "width")


_FOLD_METRICS = f"""train AS (
  SELECT series_id, ts, y, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos,
    count(*) OVER (PARTITION BY series_id) // 5 AS size, lag(y, 24) OVER (PARTITION BY series_id ORDER BY ts) AS p
  FROM filled WHERE {sql_split()} = 'train'),
fold_mape AS (
  SELECT series_id, fold, avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 AS mape
  FROM train, (SELECT unnest([1, 2, 3, 4]) AS fold) WHERE pos >= size * fold AND pos < size * (fold + 1)
    AND p IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2)"""


@query(
    with_(sql_filled(), _FOLD_METRICS)
    + f"SELECT series_id, {sql_r4('avg(mape)')} AS cv_mape_mean, {sql_r4('stddev_pop(mape)')} AS cv_mape_std FROM fold_mape GROUP BY 1"
)
def naive_cross_validation(spark, sf):
    """Walk-forward error of the daily naive: mean and population deviation over four folds."""
    train = split_part(assign_split(filled(spark, sf), "ts", SPLIT), "train")
    folds = walk_forward_folds(seasonal_naive(train, HOURLY, "y", 24), HOURLY, 4).where(F.col("role") == "val")
    per_fold = forecast_metrics(folds, ["series_id", "fold"], "y", "predicted")
    return rounded(fold_summary(per_fold, ["series_id"], "mape"), "cv_mape_mean", "cv_mape_std")


def sql_offset(source: str, by: str, alpha: float) -> str:
    """The k-th smallest score; k counts from 1 here."""
    return f"""ranked AS (
  SELECT {by} AS g, greatest(y_lower - y, y - y_upper) AS s, row_number() OVER (PARTITION BY {by} ORDER BY greatest(y_lower - y, y - y_upper)) AS k,
    count(*) OVER (PARTITION BY {by}) AS n FROM {source}),
offsets AS (SELECT g, any_value(n) AS n, max(s) FILTER (k = 1 + ceil(least(ceil((n + 1) * {1 - alpha!r}) / n, 1.0) * (n - 1))) AS q FROM ranked GROUP BY g)"""


@query(with_(sql_scored("user_id"), sql_offset("scored", "series_id", 0.2)) + f"SELECT g AS series_id, n, {sql_r4('q')} AS q FROM offsets")
def split_conformal_offsets(spark, sf):
    return rounded(conformal_offset(cut(scored(spark, sf, "user_id")), ["series_id"], 0.2, "y"), "q")


@query(with_(sql_scored(), sql_offset("scored", "1", 0.1)) + f"SELECT n, {sql_r4('q')} AS q FROM offsets")
def pooled_conformal_offset(spark, sf):
    return rounded(conformal_offset(cut(scored(spark, sf)), [], 0.1, "y"), "q")


@query(
    with_(sql_scored(), sql_offset("scored", "series_id", 0.2),
          "wide AS (SELECT s.series_id, s.y, s.y_lower - q AS y_lower, s.y_upper + q AS y_upper FROM scored s JOIN offsets o ON o.g = s.series_id)")
    + f"SELECT series_id, count(*) AS n, {_COVERAGE} FROM wide GROUP BY 1"
)
def calibrated_coverage(spark, sf):
    """Coverage after widening by the split-conformal offset: at least nominal on the calibration rows."""
    rows = cut(scored(spark, sf))
    offsets = conformal_offset(rows, ["series_id"], 0.2, "y").drop("n")
    out = interval_metrics(widen(join_groups(rows, offsets, ["series_id"]), "y_lower", "y_upper", "q"), ["series_id"], "y", "y_lower", "y_upper")
    return rounded(out, "coverage", "width")


def sql_adaptive(params: AdaptiveParams = AdaptiveParams()) -> str:
    """The adaptive recursion over table ``scored``: one step of every series in each round, the offset for the next step
    being an order statistic of the scores so far."""
    target, gamma = repr(1.0 - params.target_coverage), repr(params.gamma)
    hit = "CASE WHEN a.lo[w.i] - w.q <= a.ys[w.i] AND a.ys[w.i] <= a.hi[w.i] + w.q THEN 1 ELSE 0 END"
    return f"""arrays AS (
  SELECT series_id, count(*) AS n, list(ts ORDER BY ts) AS tss, list(y ORDER BY ts) AS ys, list(p ORDER BY ts) AS ps, list(y_lower ORDER BY ts) AS lo,
    list(y_upper ORDER BY ts) AS hi, list(greatest(y_lower - y, y - y_upper) ORDER BY ts) AS scores FROM scored GROUP BY 1),
walk AS (
  SELECT series_id, 1 AS i, CAST('{target}' AS DOUBLE) AS level, CAST(0 AS DOUBLE) AS q FROM arrays
  UNION ALL
  SELECT series_id, i + 1, level, CASE WHEN i >= 2 THEN list_sort(scores[1:i])[CAST(ceil((i - 1) * (CAST(1 AS DOUBLE) - level)) AS BIGINT) + 1] ELSE q END
  FROM (
    SELECT w.series_id, w.i, w.q, a.scores, least(greatest(w.level + CAST('{gamma}' AS DOUBLE) * (CAST('{target}' AS DOUBLE) - (1 - {hit})),
      CAST('0.0001' AS DOUBLE)), CAST(1 AS DOUBLE) - CAST('0.0001' AS DOUBLE)) AS level
    FROM walk w JOIN arrays a ON a.series_id = w.series_id AND w.i < a.n)),
adapted AS (
  SELECT w.series_id, a.tss[w.i] AS ts, a.ys[w.i] AS y, a.ps[w.i] AS predicted, a.lo[w.i] AS y_lower, a.hi[w.i] AS y_upper, w.q, {hit} AS hit,
    a.lo[w.i] - w.q AS lower_aci, a.hi[w.i] + w.q AS upper_aci
  FROM walk w JOIN arrays a ON a.series_id = w.series_id)"""


def _recursive(*ctes: str) -> str:
    return with_(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    _recursive(sql_scored("user_id"), sql_adaptive())
    + f"SELECT series_id, ts, y, predicted, y_lower, y_upper, {sql_r4('q')} AS q, hit, {sql_r4('lower_aci')} AS lower_aci, {sql_r4('upper_aci')} AS upper_aci FROM adapted"
)
def adaptive_conformal_by_user(spark, sf):
    return rounded(
        adaptive_conformal(scored(spark, sf, "user_id"), ["series_id"], "ts", AdaptiveParams(), "y"), "q", "lower_aci", "upper_aci"
    )


@query(
    _recursive(sql_scored(), sql_adaptive())
    + f"SELECT series_id, {sql_r4('avg(hit)')} AS coverage, {sql_r4('avg(upper_aci - lower_aci)')} AS width, {sql_r4('arg_min(q, ts)')} AS q_initial, "
    f"{sql_r4('arg_max(q, ts)')} AS q_final, {sql_r4('max(q)')} AS q_max FROM adapted GROUP BY 1"
)
def adaptive_conformal_summary(spark, sf):
    adapted = adaptive_conformal(scored(spark, sf), ["series_id"], "ts", AdaptiveParams(), "y")
    return rounded(adaptive_summary(adapted, ["series_id"], "ts"), "coverage", "width", "q_initial", "q_final", "q_max")


@query(
    with_(
        SQL_DAILY, sql_grid("1 DAY"),
        "errors AS (SELECT series_id, ts, y, abs(y - p) AS e FROM (SELECT *, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ts) AS p FROM grid))",
        "monthly AS (SELECT series_id, strftime(ts, '%Y-%m') AS month, avg(CASE WHEN y <> 0 THEN e / abs(y) END) * 100 AS mape FROM errors GROUP BY 1, 2)",
        "base AS (SELECT series_id, quantile_cont(mape, 0.5) FILTER (month NOT BETWEEN '1998-03' AND '1998-09') AS b FROM monthly GROUP BY 1)",
    )
    + f"SELECT series_id, month, {sql_r4('mape')} AS mape, {sql_r4('b')} AS baseline_mape, coalesce(mape > b * 1.5, FALSE) AS drift_flag FROM monthly JOIN base USING (series_id)"
)
def monthly_concept_drift(spark, sf):
    """Monthly error of a weekly naive on daily order totals against the median month."""
    rows = seasonal_naive(make_grid(daily(spark, sf), DAILY, ["y"]), DAILY, "y", 7)
    rows = error_columns(rows, "y", "predicted")
    out = concept_drift(rows, ["series_id"], "ts", "y", "1998-03-05", "1998-09-20")
    return rounded(out, "mape", "baseline_mape")


DRIFT = DriftParams(
    DriftWindow("reference", "2024-01-01", "2024-01-10 23:00:00"),
    (DriftWindow("control", "2024-01-11", "2024-01-20 23:00:00", "No drift expected."),
     DriftWindow("perturbed", "2024-01-21", "2024-01-30 23:00:00", "Values raised by half.")),
    "2024-01-21", "2024-01-30",
)
FEATURES = ("lag_1h", "hour", "is_working")


def drift_rows(spark, sf):
    """Hourly values of all event types with an injected shift in the last ten days."""
    raised = F.when(F.col("ts") >= F.lit("2024-01-21").cast("timestamp_ntz"), F.col("y") * 1.5).otherwise(F.col("y"))
    return hourly(spark, sf).select(
        "series_id", "ts", raised.alias("lag_1h"), F.hour("ts").alias("hour"), (F.weekday("ts") < 5).cast("int").alias("is_working")
    )


_DRIFT_ROWS = """rows_ AS (
  SELECT series_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN y * 1.5 ELSE y END AS lag_1h, CAST(hour(ts) AS DOUBLE) AS hour,
    CASE WHEN isodow(ts) < 6 THEN 1.0 ELSE 0.0 END AS is_working FROM panel),
long AS (
  SELECT series_id, feature, value, CASE WHEN ts <= TIMESTAMP '2024-01-10 23:00:00' THEN 'reference'
    WHEN ts <= TIMESTAMP '2024-01-20 23:00:00' THEN 'control' ELSE 'perturbed' END AS win
  FROM rows_ UNPIVOT (value FOR feature IN (lag_1h, hour, is_working)))"""


def sql_distances(by: str = "feature") -> str:
    return f"""{_DRIFT_ROWS},
pairs AS (SELECT DISTINCT {by}, w.win FROM long, (SELECT unnest(['control', 'perturbed']) AS win) w),
counts AS (
  SELECT {by}, p.win, value, count(*) FILTER (l.win = 'reference') AS c0, count(*) FILTER (l.win = p.win) AS c1
  FROM long l JOIN pairs p USING ({by}) WHERE l.win IN ('reference', p.win) GROUP BY ALL),
ecdf AS (
  SELECT *, sum(c0) OVER g AS n0, sum(c1) OVER g AS n1, sum(c0) OVER u / sum(c0) OVER g AS f0, sum(c1) OVER u / sum(c1) OVER g AS f1,
    lead(value) OVER (PARTITION BY {by}, win ORDER BY value) AS nxt
  FROM counts WINDOW g AS (PARTITION BY {by}, win), u AS (PARTITION BY {by}, win ORDER BY value ROWS UNBOUNDED PRECEDING)),
dist AS (
  SELECT {by}, win, any_value(n0) AS n0, any_value(n1) AS n1, sum(abs(f0 - f1) * coalesce(nxt - value, 0)) AS w1, max(abs(f0 - f1)) AS ks,
    sqrt(greatest(sum(CASE WHEN c0 > 0 THEN c0 / n0 * ln(c0 / n0 / ((c0 / n0 + c1 / n1) / 2)) ELSE 0 END
      + CASE WHEN c1 > 0 THEN c1 / n1 * ln(c1 / n1 / ((c0 / n0 + c1 / n1) / 2)) ELSE 0 END) / 2, 0)) AS js,
    count(*) AS distinct_values
  FROM ecdf GROUP BY ALL),
spread AS (SELECT {by}, stddev_pop(value) AS sd FROM long WHERE win = 'reference' GROUP BY ALL)"""


@query(
    with_(sql_hourly(), sql_distances())
    + f'SELECT feature, win AS "window", CAST(n0 AS BIGINT) AS n_reference, CAST(n1 AS BIGINT) AS n_window, {sql_r4("w1")} AS wasserstein, '
    f"{sql_r4('ks')} AS ks, {sql_r4('js')} AS jensen_shannon, distinct_values FROM dist"
)
def drift_distances(spark, sf):
    out = drift_statistics(drift_rows(spark, sf), "ts", DRIFT, FEATURES)
    out = out.select("feature", "window", "n_reference", "n_window", "wasserstein", "ks", "jensen_shannon", "distinct_values")
    return rounded(out, "wasserstein", "ks", "jensen_shannon")


@query(
    with_(sql_hourly(), sql_distances("series_id, feature"))
    + f'SELECT series_id, feature, win AS "window", {sql_r4("w1 / greatest(sd, 0.001)")} AS score, {sql_r4("ks")} AS ks '
    "FROM dist JOIN spread USING (series_id, feature)"
)
def drift_distances_by_series(spark, sf):
    out = drift_statistics(drift_rows(spark, sf), "ts", DRIFT, FEATURES, ["series_id"])
    score = F.col("wasserstein") / F.greatest("reference_std", F.lit(0.001))
    return rounded(out.select("series_id", "feature", "window", score.alias("score"), "ks"), "score", "ks")


_VERDICT = """verdict AS (
  SELECT feature, win AS "window", CASE WHEN distinct_values > 5 THEN 'Wasserstein distance (normed)' ELSE 'Jensen-Shannon distance' END AS stattest,
    CASE WHEN distinct_values > 5 THEN w1 / greatest(sd, 0.001) ELSE js END AS score FROM dist JOIN spread USING (feature))"""


def verdicts(spark, sf):
    return feature_drift(drift_rows(spark, sf), "ts", DRIFT, FEATURES)


@query(
    with_(sql_hourly(), sql_distances(), _VERDICT)
    + f'SELECT feature, "window", score >= 0.1 AS drift_detected, stattest, {sql_r4("score")} AS drift_score, 0.1 AS threshold FROM verdict'
)
def drift_verdicts(spark, sf):
    return rounded(verdicts(spark, sf), "drift_score")


@query(
    with_(sql_hourly(), sql_distances(),
          "scaled AS (SELECT *, (sqrt(n0 * n1 / (n0 + n1)) + 0.12 + 0.11 / sqrt(n0 * n1 / (n0 + n1))) * ks AS x FROM dist WHERE feature <> 'is_working')",
          "tested AS (SELECT feature, win, CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101), "
          "lambda j: pow(-1, j - 1) * exp(-2 * j * j * x * x))), 0.0), 1.0) END AS p FROM scaled)")  # fmt: skip
    + f'SELECT feature, win AS "window", p < 0.05 AS drift_detected, \'K-S p_value\' AS stattest, {sql_r4("p")} AS drift_score, 0.05 AS threshold FROM tested'
)
def drift_p_values(spark, sf):
    """The same windows under the p-value tests, for the two features of many values."""
    out = feature_drift(drift_rows(spark, sf), "ts", replace(DRIFT, test="p_value"), FEATURES[:2])
    return rounded(out, "drift_score")


@query(
    with_(sql_hourly(), sql_distances(), _VERDICT,
          "sizes AS (SELECT win AS \"window\", count(*) AS n_rows FROM long WHERE feature = 'hour' GROUP BY 1)")
    + """SELECT "window", count(*) AS n_features, count(*) FILTER (score >= 0.1) AS n_drifted_features,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (score >= 0.1), '') AS drifted, count(*) FILTER (score >= 0.1) > 0 AS drift_detected,
  CASE "window" WHEN 'control' THEN '2024-01-11 → 2024-01-20 23:00:00' ELSE '2024-01-21 → 2024-01-30 23:00:00' END AS period,
  CASE "window" WHEN 'control' THEN 'No drift expected.' ELSE 'Values raised by half.' END AS note, any_value(n_rows) AS n_rows
FROM verdict JOIN sizes USING ("window") GROUP BY 1"""
)
def drift_report(spark, sf):
    """One row per window with the names of its drifted features."""
    rows = drift_rows(spark, sf)
    out = drift_summary(feature_drift(rows, "ts", DRIFT, FEATURES), DRIFT.windows, window_rows(rows, "ts", DRIFT))
    return out.withColumn("drifted", F.concat_ws(",", "drifted_features")).drop("drifted_features")


@query(
    with_(sql_hourly(), sql_distances(), _VERDICT)
    + f"""SELECT feature, {sql_r4("max(score) FILTER (verdict.window = 'control')")} AS control,
  {sql_r4("max(score) FILTER (verdict.window = 'perturbed')")} AS perturbed FROM verdict GROUP BY 1"""
)
def drift_scores_by_window(spark, sf):
    """Features by window, sorted by the perturbed score."""
    out = drift_pivot(cut(verdicts(spark, sf)), ["control", "perturbed"], "perturbed")
    return rounded(out, "control", "perturbed")


@query(
    with_(sql_hourly(), sql_distances(), _VERDICT)
    + f'SELECT feature, "window", {sql_r4("score")} AS drift_score FROM verdict WHERE score >= 0.1'
)
def drifted_features(spark, sf):
    out = verdicts(spark, sf).where("drift_detected").select("feature", "window", "drift_score")
    return rounded(out, "drift_score")


@query(
    with_(sql_hourly(), sql_grid(),
          "p AS (SELECT series_id, ts, lag(y, 24) OVER (PARTITION BY series_id ORDER BY ts) AS predicted FROM grid)")
    + "SELECT a.series_id, a.ts, a.y, p.predicted FROM panel a LEFT JOIN p USING (series_id, ts)"
)
def align_actuals_with_forecasts(spark, sf):
    """Actuals and forecasts brought together by key and time, not by position."""
    forecasts = seasonal_naive(grid(spark, sf), HOURLY, "y", 24).drop("y")
    return hourly(spark, sf).join(forecasts, ["series_id", "ts"], "left")
