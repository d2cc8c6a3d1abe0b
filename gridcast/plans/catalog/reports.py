"""Exploratory aggregates, rankings, and the run and version tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcast.operators import registry
from gridcast.operators.buckets import last_rows
from gridcast.operators.explain import mean_attribution, row_attribution, stable_sample
from gridcast.operators.grid import make_grid
from gridcast.operators.metrics import forecast_metrics
from gridcast.operators.naive import hour_profile_baseline, seasonal_naive
from gridcast.operators.outliers import fence_report
from gridcast.operators.profile import autocorrelation, describe, profile_by_year, seasonal_profile
from gridcast.operators.quantiles import approx_quantiles, exact_quantiles
from gridcast.operators.split import assign_split, split_part, walk_forward_folds
from gridcast.plans.catalog.base import (
    HOURLY, SPLIT, filled, grid, hourly, query, rounded, sql_filled, sql_grid, sql_hourly, sql_r4, sql_split, table, with_,
)
from gridcast.plans.catalog.calibration import _FOLD_METRICS
from gridcast.sources.panels import cents
from gridcast.sources.tables import cut


def _in_cents(spark, sf):
    return table(spark, sf, "events").withColumn("value", cents(F.col("value")))


@query(f"SELECT CAST(hour(ts) AS INTEGER) AS hour, {sql_r4('avg(CAST(round(value * 100) AS BIGINT))')} AS mean FROM events GROUP BY 1")
def mean_by_hour(spark, sf):
    return rounded(seasonal_profile(_in_cents(spark, sf), "ts", "value", ["hour"]), "mean")


@query(f"SELECT event_type, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, {sql_r4('avg(CAST(round(value * 100) AS BIGINT))')} AS mean FROM events GROUP BY 1, 2")
def mean_by_weekday(spark, sf):
    return rounded(seasonal_profile(_in_cents(spark, sf), "ts", "value", ["weekday"], ["event_type"]), "mean")


@query(
    "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, "
    f"{sql_r4('avg(l_quantity)')} AS mean FROM lineitem GROUP BY 1, 2"
)
def mean_by_year_and_month(spark, sf):
    return rounded(seasonal_profile(table(spark, sf, "lineitem"), "l_shipdate", "l_quantity", ["year", "month"]), "mean")


_YEARS = tuple(range(1995, 2002))


@query(
    "SELECT CAST(month(l_shipdate) AS INTEGER) AS month, "
    + ", ".join(f"{sql_r4(f'avg(l_quantity) FILTER (year(l_shipdate) = {y})')} AS y{y}" for y in _YEARS)
    + " FROM lineitem GROUP BY 1"
)
def months_by_year_pivot(spark, sf):
    out = profile_by_year(table(spark, sf, "lineitem"), "l_shipdate", "l_quantity", _YEARS)
    return rounded(out, *[f"y{y}" for y in _YEARS])


_DESCRIBE = (
    "count({c}) AS count, " + sql_r4("avg({c})") + " AS mean, " + sql_r4("stddev_samp({c})") + " AS std, min({c}) AS min, "
    + ", ".join(sql_r4(f"quantile_cont({{c}}, {p / 100})") + f" AS p{p}" for p in (25, 50, 75)) + ", max({c}) AS max"
)


@query("SELECT l_returnflag, " + _DESCRIBE.format(c="l_extendedprice") + " FROM lineitem GROUP BY 1")
def describe_prices(spark, sf):
    out = describe(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return rounded(out, "mean", "std", "p25", "p50", "p75")


@query("SELECT " + _DESCRIBE.format(c="o_totalprice") + " FROM orders")
def describe_orders(spark, sf):
    return rounded(describe(table(spark, sf, "orders"), [], "o_totalprice"), "mean", "std", "p25", "p50", "p75")


@query(
    "SELECT l_suppkey, count(*) AS n, "
    + ", ".join(f"{sql_r4(f'quantile_cont(l_extendedprice, {p})')} AS {n}" for n, p in (("low", 0.1), ("mid", 0.5), ("high", 0.9)))
    + " FROM lineitem GROUP BY 1"
)
def exact_price_quantiles(spark, sf):
    out = exact_quantiles(table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice", {"low": 0.1, "mid": 0.5, "high": 0.9})
    return rounded(out, "low", "mid", "high")


@query("SELECT count(*) AS n, " + sql_r4("quantile_cont(l_extendedprice, 0.25)") + " AS q1, " + sql_r4("quantile_cont(l_extendedprice, 0.75)")
       + " AS q3 FROM lineitem")
def exact_quartiles_overall(spark, sf):
    out = exact_quantiles(table(spark, sf, "lineitem"), [], "l_extendedprice", {"q1": 0.25, "q3": 0.75})
    return rounded(out, "q1", "q3")


@query()
def approximate_price_quantiles(spark, sf):
    return approx_quantiles(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", {"q1": 0.25, "q3": 0.75})


_ACF_LAGS = (1, 2, 3, 6, 12, 24, 48, 168, 336, 720)  # 720 steps reach past a 720-step series: NULL


@query(
    with_(sql_filled(), "l AS (SELECT series_id, y, " + ", ".join(f"lag(y, {h}) OVER w AS l{h}" for h in _ACF_LAGS)
          + " FROM filled WINDOW w AS (PARTITION BY series_id ORDER BY ts))")
    + " UNION ALL ".join(f"SELECT series_id, {h} AS lag, {sql_r4(f'corr(y, l{h})')} AS acf FROM l GROUP BY 1" for h in _ACF_LAGS)
)
def lag_autocorrelation(spark, sf):
    return rounded(autocorrelation(filled(spark, sf), HOURLY, "y", _ACF_LAGS), "acf")


@query(
    with_(sql_hourly(), "l AS (SELECT series_id, y, " + ", ".join(f"lag(y, {h}) OVER w AS l{h}" for h in _ACF_LAGS)
          + " FROM panel WINDOW w AS (PARTITION BY series_id ORDER BY ts))")
    + " UNION ALL ".join(f"SELECT series_id, {h} AS lag, {sql_r4(f'corr(y, l{h})')} AS acf FROM l GROUP BY 1" for h in _ACF_LAGS)
)
def lag_autocorrelation_of_known_rows(spark, sf):
    """Lags count known rows: gaps are closed up first."""
    return rounded(autocorrelation(grid(spark, sf), HOURLY, "y", _ACF_LAGS, compact=True), "acf")


@query(f"SELECT {sql_r4('q1')} AS q1, {sql_r4('q3')} AS q3, {sql_r4('q3 - q1')} AS iqr, {sql_r4('q1 - 3 * (q3 - q1)')} AS lo, "
       f"{sql_r4('q3 + 3 * (q3 - q1)')} AS hi, count(*) AS n, count(*) FILTER (value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1)) AS n_outside, "
       f"{sql_r4('avg(CASE WHEN value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1) THEN 1 ELSE 0 END)')} AS share_outside "
       "FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) GROUP BY q1, q3")  # fmt: skip
def fences_over_all_events(spark, sf):
    out = fence_report(table(spark, sf, "events"), [], "value")
    return rounded(out, "q1", "q3", "iqr", "lo", "hi", "share_outside")


@query(with_(sql_hourly()) + "SELECT * FROM panel ORDER BY series_id, ts")
def panel_in_time_order(spark, sf):
    return hourly(spark, sf).orderBy("series_id", "ts")


@query(
    with_(sql_filled(), "r AS (SELECT *, max(ts) OVER (PARTITION BY series_id) AS b FROM filled)")
    + f"SELECT series_id, ts, {sql_r4('y')} AS y FROM r WHERE ts > b - INTERVAL 336 HOUR"
)
def last_two_weeks(spark, sf):
    return rounded(last_rows(filled(spark, sf), HOURLY, 336), "y")


# ---- runs: one candidate per baseline and series -------------------------------------------------------------------

_CANDIDATES = f"""s AS (
  SELECT series_id, ts, y, {sql_split()} AS split, hour(ts) AS h, lag(y, 24) OVER w AS p24, lag(y, 168) OVER w AS p168
  FROM filled WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
hm AS (SELECT series_id, h, avg(y) AS ph FROM s WHERE split = 'train' GROUP BY 1, 2),
p AS (SELECT series_id, y, unnest(['naive_24', 'naive_168', 'hour_mean']) AS model_type, unnest([p24, p168, ph]) AS p
  FROM s LEFT JOIN hm USING (series_id, h) WHERE split = 'val'),
c AS (SELECT series_id || '/' || model_type AS run_id, model_type, avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 AS val_mape,
  sqrt(avg((y - p) * (y - p))) AS val_rmse, avg(abs(y - p)) AS val_mae FROM p WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY series_id, model_type)"""
_RUNS = with_(sql_filled(), _CANDIDATES)
_VERSIONS = """,
v AS (SELECT CAST(row_number() OVER (ORDER BY run_id) AS INTEGER) AS version, run_id,
  CASE WHEN row_number() OVER (ORDER BY run_id) = 1 THEN 'Production' WHEN row_number() OVER (ORDER BY run_id) = 2 THEN 'Staging' ELSE 'None' END AS stage FROM c),
best AS (SELECT run_id AS b FROM c ORDER BY val_mape, val_rmse, model_type LIMIT 1),
bv AS (SELECT max(version) AS bv FROM v, best WHERE run_id = b)"""


def runs(spark, sf):
    """Long run table of three baselines on every series: the metrics of each on the validation part."""
    labelled = cut(assign_split(filled(spark, sf), "ts", SPLIT))
    parts = {
        "naive_24": seasonal_naive(labelled, HOURLY, "y", 24).where(F.col("split") == "val"),
        "naive_168": seasonal_naive(labelled, HOURLY, "y", 168).where(F.col("split") == "val"),
        "hour_mean": hour_profile_baseline(labelled, HOURLY, "y").where(F.col("split") == "val"),
    }
    out = None
    for name, rows in parts.items():
        m = forecast_metrics(rows, ["series_id"], "y", "predicted", "val_").withColumn("model_type", F.lit(name))
        out = m if out is None else out.unionByName(m)
    long = out.unpivot(["series_id", "model_type"], ["val_mape", "val_rmse", "val_mae"], "metric", "value")
    return long.select(
        F.concat_ws("/", "series_id", "model_type").alias("run_id"), F.col("model_type").alias("run_name"), "model_type",
        F.lit(None).cast("string").alias("parent_run_id"), F.lit(None).cast("int").alias("fold_index"), "metric", "value",
        F.lit(None).cast("string").alias("data_hash"),
    )


def versions(spark, sf):
    """One version per run, numbered in order of the run's name (one row per baseline and series)."""
    events = table(spark, sf, "events").select(F.col("event_type").alias("s")).distinct()
    models = F.explode(F.array(F.lit("hour_mean"), F.lit("naive_168"), F.lit("naive_24"))).alias("m")
    named = events.select("s", models).select(F.concat_ws("/", "s", "m").alias("run_id"))
    numbered = named.withColumn("version", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("run_id")))
    stage = F.when(F.col("version") == 1, "Production").when(F.col("version") == 2, "Staging").otherwise("None")
    return numbered.select("version", "run_id", F.col("run_id").alias("path"), stage.alias("stage"))


_SHOWN = f"run_id, model_type, {sql_r4('val_mape')} AS val_mape, {sql_r4('val_rmse')} AS val_rmse, {sql_r4('val_mae')} AS val_mae"


@query(_RUNS + f"SELECT {_SHOWN} FROM c")
def run_candidates(spark, sf):
    return rounded(registry.candidates(runs(spark, sf)), "val_mape", "val_rmse", "val_mae")


@query(_RUNS + f"SELECT {_SHOWN} FROM c ORDER BY c.val_mape, c.val_rmse, model_type LIMIT 20")
def ranked_runs(spark, sf):
    """Best 20 runs by validation error."""
    return rounded(registry.ranked_runs(runs(spark, sf)), "val_mape", "val_rmse", "val_mae")


@query(
    _RUNS.rstrip() + _VERSIONS + f" SELECT {_SHOWN}, run_id = b AND bv IS NOT NULL AS promoted FROM c, best, bv"
)
def model_selection(spark, sf):
    out = registry.select_model(cut(registry.candidates(runs(spark, sf))), cut(versions(spark, sf)))
    return rounded(out, "val_mape", "val_rmse", "val_mae")


@query(
    _RUNS.rstrip() + _VERSIONS
    + " SELECT version, run_id, CASE WHEN version = bv THEN 'Production' WHEN stage IN ('Production', 'Staging') THEN 'Archived' ELSE stage END AS stage FROM v, bv"
)
def model_promotion(spark, sf):
    out = registry.promote(cut(registry.candidates(runs(spark, sf))), cut(versions(spark, sf)))
    return out.select("version", "run_id", "stage")


@query(_RUNS.rstrip() + _VERSIONS + " SELECT CAST(max(version) + 1 AS INTEGER) AS version, 'new' AS run_id, 'p' AS path, 'None' AS stage FROM v")
def version_registration(spark, sf):
    return registry.register_version(versions(spark, sf), "new", "p")


@query(
    with_(sql_filled(), _FOLD_METRICS)
    + f"SELECT series_id AS parent_run_id, CAST(fold AS INTEGER) AS fold, {sql_r4('mape')} AS fold_mape, {sql_r4('avg(mape) OVER (PARTITION BY series_id)')} AS mean FROM fold_mape"
)
def fold_metrics(spark, sf):
    """Fold errors of the daily naive recorded as runs named after their fold, read back by number with their mean."""
    train = split_part(assign_split(filled(spark, sf), "ts", SPLIT), "train")
    folds = walk_forward_folds(seasonal_naive(train, HOURLY, "y", 24), HOURLY, 4).where(F.col("role") == "val")
    errors = forecast_metrics(folds, ["series_id", "fold"], "y", "predicted", "fold_")
    rows = errors.select(
        F.col("series_id").alias("parent_run_id"), F.concat(F.lit("fold_"), "fold").alias("run_name"), F.lit("fold_mape").alias("metric"),
        F.col("fold_mape").alias("value"),
    )
    return rounded(registry.fold_rows(rows), "fold_mape", "mean")


# ---- attributions: reports over stored values -----------------------------------------------------------------------

_VALUES = ("l_quantity", "l_discount", "l_tax", "l_extendedprice")


@query(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, {sql_r4(f'avg(abs({c} - 20))')} AS mean_abs FROM lineitem" for c in _VALUES)
)
def mean_absolute_attribution(spark, sf):
    """Mean absolute value per column of a stored attribution table, the 20 largest."""
    values = table(spark, sf, "lineitem").select(*[(F.col(c) - 20).alias(c) for c in _VALUES])
    return rounded(mean_attribution(values, _VALUES), "mean_abs")


@query(
    "SELECT l_orderkey, l_linenumber, feature, value, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY row "
    "ORDER BY abs(value) DESC, feature) AS INTEGER) AS rank FROM (SELECT l_orderkey, l_linenumber, row, "
    "unnest(['l_quantity', 'l_discount', 'l_tax', 'l_extendedprice']) AS feature, "
    "unnest([l_quantity - 20, l_discount - 20, l_tax - 20, l_extendedprice - 20]) AS value FROM (SELECT *, row_number() OVER () AS row FROM lineitem))) WHERE rank <= 2"
)
def top_attributions_per_row(spark, sf):
    """The two largest values of each row by absolute size."""
    values = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[(F.col(c) - 20).alias(c) for c in _VALUES])
    return row_attribution(values, ["l_orderkey", "l_linenumber"], _VALUES, top=2)


@query(
    with_(sql_hourly())
    + "SELECT series_id, ts, y FROM panel ORDER BY md5(concat_ws('|', '42', series_id, CAST(ts AS VARCHAR))), series_id, ts LIMIT 300"
)
def seeded_sample(spark, sf):
    """At most 300 rows, chosen by key hash: a sampling operator."""
    return stable_sample(hourly(spark, sf), ["series_id", "ts"], 300)


@query(
    with_(sql_hourly(), sql_grid())
    + "SELECT series_id, concat_ws(' → ', CAST(min(ts) AS VARCHAR), CAST(max(ts) AS VARCHAR)) AS period, substr(CAST(max(ts) AS VARCHAR), 1, 7) AS month FROM grid GROUP BY 1"
)
def period_text(spark, sf):
    low, high = F.min("ts").cast("string"), F.max("ts").cast("string")
    panel = make_grid(hourly(spark, sf), HOURLY, ["y"])
    return panel.groupBy("series_id").agg(F.concat_ws(" → ", low, high).alias("period"), F.substring(high, 1, 7).alias("month"))


