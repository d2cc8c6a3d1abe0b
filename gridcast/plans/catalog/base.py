"""Registration of queries, panels derived from the driver's tables, and the SQL fragments that mirror them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.timegrid import type_of
from gridcast.operators.gaps import fill_gaps
from gridcast.operators.grid import event_bounds, make_grid
from gridcast.params import Axis, SplitParams
from gridcast.sources.panels import aggregate_to_steps, cents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

HOURLY = Axis()
DAILY = Axis(step=86_400)
SPLIT = SplitParams("2024-01-20 23:00:00", "2024-01-25 23:00:00")


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL it must agree with."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r4(c: Column | str) -> Column:
    """Four decimals, without negative zero."""
    return F.round(c, 4) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r4_double(c) if type_of(df, c) == "double" else r4(c) for c in columns})


def r4_double(c: str) -> Column:
    """The same as `r4` for a double; only near a tie, and for large or missing values, is its decimal text needed."""
    scaled = F.col(c) * 1e4
    whole = F.rint(scaled)
    plain = (F.abs(scaled) < 1e9) & (F.abs(scaled - whole) < 0.4999)
    return F.when(plain, whole / F.lit(1e4) + F.lit(0.0)).otherwise(r4(c))


# ---- panels -------------------------------------------------------------------------------------------------------


def hourly(spark: SparkSession, sf: str, series: str = "event_type") -> DataFrame:
    """Events as hourly sums in cents per ``event_type`` or ``user_id``; hours without events have no row."""
    events = table(spark, sf, "events")
    return aggregate_to_steps(
        events, HOURLY, F.col(series).cast("string"), "ts", {"y": F.sum(cents(F.col("value"))).cast("double")}
    )


def grid(spark: SparkSession, sf: str, series: str = "event_type", keep_helpers: bool = False) -> DataFrame:
    bounds = event_bounds(table(spark, sf, "events"), HOURLY, F.col(series).cast("string"), "ts")
    return make_grid(hourly(spark, sf, series), HOURLY, ["y"], keep_helpers, bounds)


def filled(spark: SparkSession, sf: str, series: str = "event_type", mode: str = "strict") -> DataFrame:
    return fill_gaps(grid(spark, sf, series, True), HOURLY, ["y"], 6, mode)


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as daily sums in cents per order status."""
    orders = table(spark, sf, "orders")
    total = F.sum(cents(F.col("o_totalprice"))).cast("double")
    return aggregate_to_steps(orders, DAILY, F.col("o_orderstatus"), "o_orderdate", {"y": total})


# ---- the same in SQL ----------------------------------------------------------------------------------------------


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sql_hourly(series: str = "event_type") -> str:
    return f"""panel AS (
  SELECT CAST({series} AS VARCHAR) AS series_id, date_trunc('hour', ts) AS ts,
         CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS y
  FROM events GROUP BY 1, 2)"""


SQL_DAILY = """panel AS (
  SELECT o_orderstatus AS series_id, date_trunc('day', o_orderdate)::TIMESTAMP AS ts,
         CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS y
  FROM orders GROUP BY 1, 2)"""


def sql_grid(step: str = "1 HOUR", source: str = "panel", name: str = "grid") -> str:
    return f"""{name}_spine AS (
  SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL {step})) AS ts FROM {source} GROUP BY series_id),
{name} AS (
  SELECT s.series_id, s.ts, p.y, row_number() OVER (PARTITION BY s.series_id ORDER BY s.ts) - 1 AS i
  FROM {name}_spine s LEFT JOIN {source} p ON p.series_id = s.series_id AND p.ts = s.ts)"""


def sql_runs(source: str, name: str) -> str:
    """Neighbours and run length of every row of a grid with index ``i``."""
    return f"""{name} AS (
  SELECT series_id, ts, y, i, i0, i1, v0, v1, coalesce(i1, n) - coalesce(i0, -1) - 1 AS run_length,
         i - coalesce(i0, -1) AS run_position, coalesce(i0 + 1, 0) AS run_start
  FROM (
    SELECT *, count(*) OVER (PARTITION BY series_id) AS n,
      last_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS i0,
      last_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
      first_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS i1,
      first_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
    FROM {source}))"""


LINE = "CASE WHEN i1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * ((i - i0) / (i1 - i0)) END"


def sql_fill(source: str, name: str, mode: str, limit: int) -> str:
    """``strict`` fills runs up to the limit, ``reference`` the first steps of all runs if one is short, ``limited`` the
    first steps of all runs."""
    runs = f"{name}_runs"
    may = {
        "strict": f"run_length <= {limit}",
        "reference": f"bool_or(y IS NULL AND run_length <= {limit}) OVER (PARTITION BY series_id)",
        "limited": "TRUE",
    }[mode]
    return f"""{sql_runs(source, runs)},
{name} AS (
  SELECT series_id, ts, i, CASE WHEN y IS NOT NULL THEN y
         WHEN may AND i0 IS NOT NULL AND i - i0 <= {limit} THEN {LINE} END AS y
  FROM (SELECT *, {may} AS may FROM {runs}))"""


def sql_filled(series: str = "event_type", mode: str = "strict") -> str:
    return ",\n".join([sql_hourly(series), sql_grid(), sql_fill("grid", "filled", mode, 6)])


def sql_split(column: str = "ts") -> str:
    return (
        f"CASE WHEN {column} <= TIMESTAMP '{SPLIT.train_end}' THEN 'train' "
        f"WHEN {column} <= TIMESTAMP '{SPLIT.val_end}' THEN 'val' ELSE 'test' END"
    )


def sql_r4(expression: str) -> str:
    return f"round({expression}, 4) + 0.0"
