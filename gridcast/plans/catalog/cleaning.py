"""Grid, gaps, outliers and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcast.operators.cleaning import cleaning_stats, normalise_columns
from gridcast.operators.features import lag_features
from gridcast.operators.gaps import fill_gaps, fill_limited, label_null_runs
from gridcast.operators.outliers import fence_report, fences, null_isolated, null_outside_fences, remove_outliers
from gridcast.operators.profile import missing_rows
from gridcast.operators.quality import Check, check_statistics, checks_on_write, gate, quality_report, run_checks
from gridcast.params import Axis, CleanParams
from gridcast.plans.catalog.base import (
    DAILY, HOURLY, SQL_DAILY, daily, filled, grid, hourly, query, rounded, sql_fill, sql_filled, sql_grid, sql_hourly,
    sql_r4, sql_runs, table, with_,
)
from gridcast.plans.catalog.scans import RAW_WIDE, raw_wide
from gridcast.plans.jobs import clean
from gridcast.operators.grid import make_grid
from gridcast.sources.tables import cut


@query(with_(sql_hourly(), sql_grid()) + "SELECT series_id, ts, y FROM grid")
def complete_grid(spark, sf):
    return grid(spark, sf)


@query(with_(sql_hourly("user_id"), sql_grid()) + "SELECT series_id, ts, y FROM grid")
def complete_grid_by_user(spark, sf):
    """Sparse series with long gaps."""
    return grid(spark, sf, "user_id")


@query(with_(SQL_DAILY, sql_grid("1 DAY")) + "SELECT series_id, ts, y FROM grid")
def complete_daily_grid(spark, sf):
    return make_grid(daily(spark, sf), DAILY, ["y"])


@query(
    with_(sql_hourly("user_id"), sql_grid())
    + "SELECT series_id, count(*) AS n_rows, count(*) FILTER (y IS NULL) AS n_missing FROM grid GROUP BY 1"
)
def missing_steps(spark, sf):
    return missing_rows(grid(spark, sf, "user_id"), ["y"], ["series_id"])


@query(
    with_(sql_hourly("user_id"), sql_grid(), sql_runs("grid", "runs"))
    + "SELECT series_id, ts, CAST(run_length AS BIGINT) AS run_length, CAST(run_position AS BIGINT) AS run_position "
    "FROM runs WHERE y IS NULL"
)
def null_run_labels(spark, sf):
    """Gaps and islands: length of each null run, and each row's place in it."""
    return label_null_runs(grid(spark, sf, "user_id"), HOURLY, "y").drop("run_id")


def _filled_sql(series: str, mode: str) -> str:
    return with_(sql_filled(series, mode)) + f"SELECT series_id, ts, {sql_r4('y')} AS y FROM filled"


@query(_filled_sql("event_type", "strict"))
def fill_short_gaps(spark, sf):
    return rounded(filled(spark, sf), "y")


@query(_filled_sql("user_id", "strict"))
def fill_short_gaps_by_user(spark, sf):
    return rounded(filled(spark, sf, "user_id"), "y")


@query(_filled_sql("user_id", "reference"))
def fill_gap_starts_by_user(spark, sf):
    """The default policy: the first six steps of every gap, for series that have a short gap."""
    return rounded(filled(spark, sf, "user_id", "reference"), "y")


@query(
    with_(sql_filled("user_id", "reference"), sql_fill("filled", "refilled", "limited", 24))
    + f"SELECT series_id, ts, {sql_r4('y')} AS y FROM refilled"
)
def refill_limited_by_user(spark, sf):
    """Second pass: up to 24 steps of what is still open."""
    once = fill_gaps(grid(spark, sf, "user_id", True), HOURLY, ["y"], 6, keep_helpers=True)
    return rounded(fill_limited(once, HOURLY, ["y"], 24), "y")


@query(
    with_(sql_hourly("user_id"), sql_grid(), sql_runs("grid", "runs"))
    + "SELECT series_id, ts, CASE WHEN y IS NOT NULL THEN y WHEN i - i0 <= 24 THEN v0 END AS y FROM runs"
)
def carry_last_value(spark, sf):
    """Causal filling: the last known value for up to 24 steps."""
    return fill_limited(grid(spark, sf, "user_id", True), HOURLY, ["y"], 24, causal=True)


def _fence_sql(source: str) -> str:
    return f"""q AS (
  SELECT series_id, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM {source} GROUP BY 1),
fence AS (SELECT series_id, q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""


@query(
    with_(sql_hourly("user_id"), _fence_sql("panel"))
    + f"SELECT series_id, {sql_r4('q1')} AS y_q1, {sql_r4('q3')} AS y_q3, {sql_r4('lo')} AS y_lo, {sql_r4('hi')} AS y_hi FROM fence"
)
def quartile_fences(spark, sf):
    return rounded(fences(hourly(spark, sf, "user_id"), ["series_id"], ["y"], 1.5), "y_q1", "y_q3", "y_lo", "y_hi")


@query(
    with_(sql_hourly(), _fence_sql("panel"))
    + f"SELECT series_id, {sql_r4('any_value(q1)')} AS q1, {sql_r4('any_value(q3)')} AS q3, "
    f"{sql_r4('any_value(q3 - q1)')} AS iqr, {sql_r4('any_value(lo)')} AS lo, {sql_r4('any_value(hi)')} AS hi, count(*) AS n, "
    f"count(*) FILTER (y < lo OR y > hi) AS n_outside, {sql_r4('avg(CASE WHEN y < lo OR y > hi THEN 1 ELSE 0 END)')} AS share_outside "
    "FROM panel JOIN fence USING (series_id) GROUP BY 1"
)
def outlier_report(spark, sf):
    out = fence_report(hourly(spark, sf), ["series_id"], "y", 1.5)
    return rounded(out, "q1", "q3", "iqr", "lo", "hi", "share_outside")


@query(
    with_(sql_hourly("user_id"), _fence_sql("panel"))
    + "SELECT series_id, ts, CASE WHEN y < lo OR y > hi THEN NULL ELSE y END AS y FROM panel JOIN fence USING (series_id)"
)
def outliers_to_null(spark, sf):
    return null_outside_fences(hourly(spark, sf, "user_id"), HOURLY, ["y"], 1.5)


@query(
    with_(sql_hourly(), _fence_sql("(SELECT * FROM panel WHERE ts <= TIMESTAMP '2024-01-10')"))
    + "SELECT series_id, ts, CASE WHEN y < lo OR y > hi THEN NULL ELSE y END AS y FROM panel JOIN fence USING (series_id)"
)
def outliers_by_early_fences(spark, sf):
    """Fences from the first days only, so that later data can't influence the cleaning of earlier data."""
    return null_outside_fences(hourly(spark, sf), HOURLY, ["y"], 1.5, until="2024-01-10 00:00:00")


_NULLED = "nulled AS (SELECT series_id, ts, i, CASE WHEN y < lo OR y > hi THEN NULL ELSE y END AS y FROM filled JOIN fence USING (series_id))"


@query(
    with_(sql_filled("user_id", "reference"), _fence_sql("filled"), _NULLED, sql_fill("nulled", "done", "limited", 24))
    + f"SELECT series_id, ts, {sql_r4('y')} AS y FROM done"
)
def remove_outliers_by_fences(spark, sf):
    """Fill, fence, null and refill on sparse series."""
    panel = cut(filled(spark, sf, "user_id", "reference"))
    return rounded(remove_outliers(panel, HOURLY, ["y"], multiplier=1.5), "y")


@query()
def remove_outliers_by_isolation(spark, sf):
    """A joint isolation forest of 100 trees on the value, its one-hour and its daily change; all three are nulled together."""
    lagged = lag_features(filled(spark, sf), HOURLY, "y", (1, 24))
    panel = lagged.select("series_id", "ts", "y", (F.col("y") - F.col("lag_1h")).alias("change_1h"), (F.col("y") - F.col("lag_24h")).alias("change_24h"))
    return null_isolated(panel, HOURLY, ["y", "change_1h", "change_24h"], contamination=0.02)


def _clean_column(c: str) -> str:
    return ",\n".join(
        [
            f"{c}_p AS (SELECT 'DE' AS series_id, ts, {c} AS y FROM wide)",
            sql_grid(source=f"{c}_p", name=f"{c}_g"),
            sql_fill(f"{c}_g", f"{c}_f", "reference", 6),
            f"{c}_q AS (SELECT quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM {c}_f)",
            f"{c}_n AS (SELECT series_id, ts, i, CASE WHEN y < q1 - 3 * (q3 - q1) OR y > q3 + 3 * (q3 - q1) THEN NULL ELSE y END AS y FROM {c}_f, {c}_q)",
            sql_fill(f"{c}_n", f"{c}_d", "limited", 24),
        ]
    )


@query(
    with_(RAW_WIDE, *[_clean_column(c) for c in ("load_mw", "wind_mw", "solar_mw")])
    + f"SELECT l.series_id, l.ts, {sql_r4('l.y')} AS load_mw, {sql_r4('CASE WHEN w.y < 0 THEN 0 ELSE w.y END')} AS wind_mw, "
    f"{sql_r4('CASE WHEN s.y < 0 THEN 0 ELSE s.y END')} AS solar_mw FROM load_mw_d l JOIN wind_mw_d w USING (ts) JOIN solar_mw_d s USING (ts)"
)
def clean_readings(spark, sf):
    """The whole cleaning chain on three columns of one series."""
    raw = normalise_columns(raw_wide(spark, sf)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = clean(raw.withColumn("series_id", F.lit("DE")), HOURLY, CleanParams())
    return rounded(out, "load_mw", "wind_mw", "solar_mw")


@query(
    with_(sql_hourly(), sql_grid(), sql_fill("grid", "filled", "strict", 6))
    + "SELECT series_id, count(p.ts) AS rows_raw, count(p.y) AS known_raw_y, count(*) FILTER (p.y < 0) AS negative_y, "
    "count(*) AS rows_clean, count(*) FILTER (f.y IS NULL) AS null_clean_y "
    "FROM filled f LEFT JOIN panel p USING (series_id, ts) GROUP BY 1"
)
def cleaning_counters(spark, sf):
    params = CleanParams(columns=("y",), non_negative=("y",))
    return cleaning_stats(hourly(spark, sf), filled(spark, sf), HOURLY, params)


CHECKS = [
    Check("exists", "ts"), Check("exists", "value"), Check("exists", "amount"), Check("not_null", "value", 0.02),
    Check("not_null", "big_value", 0.5), Check("between", "value", 0.99, 0.0, 200.0), Check("between", "value", 0.8, 5.0, 40.0),
    Check("unique", "event_id"), Check("unique", "user_id"), Check("row_count", limit=8760),
]


def _check_row(kind: str, column: str, severity: str, observed: str, threshold: str, success: str) -> str:
    return (
        f'SELECT \'{kind}\' AS "check", \'{column}\' AS "column", \'{severity}\' AS severity, '
        f"{sql_r4(f'CAST({observed} AS DOUBLE)')} AS observed, CAST({threshold} AS DOUBLE) AS threshold, {success} AS success FROM a"
    )


_CHECK_SQL = """WITH a AS (
  SELECT count(*) AS n, count(value) AS v, count(CASE WHEN value > 20 THEN value END) AS big,
    count(*) FILTER (value BETWEEN 0 AND 200) AS b1, count(*) FILTER (value BETWEEN 5 AND 40) AS b2,
    (SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM events GROUP BY event_id HAVING count(*) > 1)) AS d1,
    (SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM events GROUP BY user_id HAVING count(*) > 1)) AS d2
  FROM events)
""" + " UNION ALL ".join(
    [
        _check_row("exists", "ts", "hard", "1", "1", "TRUE"),
        _check_row("exists", "value", "hard", "1", "1", "TRUE"),
        _check_row("exists", "amount", "hard", "0", "1", "FALSE"),
        _check_row("not_null", "value", "soft", "(n - v) / n", "0.02", "(n - v) / n <= 0.02"),
        _check_row("not_null", "big_value", "soft", "(n - big) / n", "0.5", "(n - big) / n <= 0.5"),
        _check_row("between", "value", "soft", "b1 / v", "0.99", "b1 / v >= 0.99"),
        _check_row("between", "value", "soft", "b2 / v", "0.8", "b2 / v >= 0.8"),
        _check_row("unique", "event_id", "hard", "d1", "0", "d1 = 0"),
        _check_row("unique", "user_id", "hard", "d2", "0", "d2 = 0"),
        _check_row("row_count", "", "hard", "n", "8760", "n >= 8760"),
    ]
)


def _checked(spark, sf):
    events = table(spark, sf, "events")
    return run_checks(events.withColumn("big_value", F.when(F.col("value") > 20, F.col("value"))), CHECKS)


@query(_CHECK_SQL)
def quality_checks(spark, sf):
    return rounded(_checked(spark, sf), "observed")


@query(_CHECK_SQL)
def quality_checks_on_write(spark, sf):
    """The same checks observed while the table is written, so that it's read once."""
    events = table(spark, sf, "events").withColumn("big_value", F.when(F.col("value") > 20, F.col("value")))
    return rounded(checks_on_write(events, CHECKS, cut)[1], "observed")


@query(
    f"SELECT count(*) AS evaluated, count(*) FILTER (success) AS passed, count(*) FILTER (NOT success) AS failed FROM ({_CHECK_SQL})"
)
def quality_statistics(spark, sf):
    return check_statistics(_checked(spark, sf))


# The report's values aren't rounded, so the twin takes the check's own figures.
_RAW_CHECKS = _CHECK_SQL.replace("round(CAST(", "(CAST(").replace(" AS DOUBLE), 4) + 0.0 AS observed", " AS DOUBLE)) AS observed")


@query(
    'SELECT to_json({\'suite\': \'events\', \'success\': bool_and(success), \'results\': list({\'check\': "check", \'column\': "column", \'severity\': severity, '
    "'observed': observed, 'threshold': threshold, 'success': success} ORDER BY \"check\", \"column\", severity, observed)})::VARCHAR AS report "
    f"FROM ({_RAW_CHECKS})"
)
def quality_json_report(spark, sf):
    """The whole result as one JSON text."""
    return quality_report(_checked(spark, sf), "events")


@query("SELECT event_id, value FROM events")
def gated_scan(spark, sf):
    """Rows read through a gate whose hard checks hold."""
    events = table(spark, sf, "events")
    results = run_checks(events, [Check("exists", "ts"), Check("unique", "event_id"), Check("between", "value", 0.99, 5, 9)])
    return gate(events, results).select("event_id", "value")
