"""The description stored beside a fitted model: its kind, its axis and its numbers, as one row of JSON."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import SparkSession

from gridcast.params import Axis


def save_meta(path: str, kind: str, axis: Axis | None = None, **values) -> None:
    text = json.dumps({"kind": kind, "axis": None if axis is None else asdict(axis), **values})
    SparkSession.active().createDataFrame([(kind, text)], "kind string, meta string").write.mode("overwrite").parquet(f"{path}/meta")


def stored_kind(spark: SparkSession, path: str) -> str:
    return spark.read.parquet(f"{path}/meta").first()["kind"]


def load_meta(spark: SparkSession, path: str, kind: str) -> tuple[dict, Axis | None]:
    """The stored values and axis; a model of another kind raises."""
    row = spark.read.parquet(f"{path}/meta").first()
    if row["kind"] != kind:
        raise ValueError(f"{path} holds a model of kind {row['kind']!r}, not {kind!r}")
    meta = json.loads(row["meta"])
    axis = meta.pop("axis")
    return meta, None if axis is None else Axis(**{**axis, "keys": tuple(axis["keys"])})
