import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

from gridcast.operators.cleaning import RAW_COLUMNS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def hourly(start: str, n: int) -> pd.DatetimeIndex:
    return pd.date_range(start, periods=n, freq="h")


def spread(n: int, step: float) -> np.ndarray:
    """Evenly spread values in [0, 1) without a generator: multiples of an irrational step."""
    return (np.arange(1, n + 1) * step) % 1


@pytest.fixture(scope="session")
def raw_readings() -> pd.DataFrame:
    """55 days of readings in raw column names: a load that ramps up to noon and rests on Sundays, noon sun, steady wind."""
    frame = pd.DataFrame({"at": hourly("2019-01-01", 55 * 24)})
    noon = 1 - frame["at"].dt.hour.sub(12).abs() / 12
    sunday = frame["at"].dt.dayofweek.eq(6)
    load = 40_000 + 12_000 * noon - 6_000 * sunday + 2_500 * spread(len(frame), 2**0.5)
    text = frame["at"].dt.strftime("%Y-%m-%dT%H:%M:%SZ")
    sun = (noon - 0.5).clip(lower=0) * 20_000 * (0.5 + spread(len(frame), 3**0.5))
    columns = (text, load, 9_000 + 4_000 * spread(len(frame), 5**0.5), sun)
    return pd.DataFrame(dict(zip(RAW_COLUMNS, columns, strict=True)))
