"""Finite streams to their end, tables rewritten where touched, keys unique across batches, adaptive state in blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators.conformal import SortedScores, adaptive_conformal
from gridcast.operators.quality import Check
from gridcast.params import AdaptiveParams
from gridcast.sources.tables import cut, release
from gridcast.streaming.jobs import (
    _StoredScores, adaptive_conformal_stream, hourly_series_stream, latest_table_stream, quality_gate_stream, read_latest_table, run_to_end,
)

from conftest import hourly
from test_models import drain, stream_of


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts string, k string, v double").withColumn("ts", F.to_timestamp("ts"))


def test_run_to_end_emits_the_last_windows(spark, tmp_path):
    batches = [events(spark, [(1, "2020-01-01 00:10", "a", 1.0), (2, "2020-01-01 00:50", "b", 2.0)]), events(spark, [(3, "2020-01-01 08:00", "a", 5.0), (3, "2020-01-01 08:00", "a", 5.0)])]
    stream = stream_of(spark, tmp_path, "ends", batches)
    make = lambda rows: hourly_series_stream(rows, "ts", "k", "v", "event_id")
    run_to_end(stream, "ts", make, str(tmp_path / "out"), str(tmp_path / "ck"), str(tmp_path / "closing"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("series_id", F.col("ts").cast("string"), "y", "n_events").collect())
    assert got == [("a", "2020-01-01 00:00:00", 1.0, 1), ("a", "2020-01-01 08:00:00", 5.0, 1), ("b", "2020-01-01 00:00:00", 2.0, 1)]


def test_run_to_end_of_no_rows(spark, tmp_path):
    stream = stream_of(spark, tmp_path, "none", [events(spark, [])])
    make = lambda rows: hourly_series_stream(rows, "ts", "k", "v", "event_id")
    run_to_end(stream, "ts", make, str(tmp_path / "out"), str(tmp_path / "ck"), str(tmp_path / "closing"))
    assert spark.read.schema("y double").parquet(str(tmp_path / "out")).count() == 0


def test_latest_table_rewrites_only_touched_parts(spark, tmp_path):
    def batch(rows):
        return spark.createDataFrame(rows, "k string, ts string, v double").withColumn("ts", F.to_timestamp("ts"))

    path = tmp_path / "table"
    files = lambda: {str(f.relative_to(path)) for f in path.glob("key_part=*/part-*")}
    many = batch([(f"k{i}", "2020-01-01", float(i)) for i in range(200)] + [(None, "2020-01-01", -1.0)])
    latest_table_stream(stream_of(spark, tmp_path, "one", [many]), str(path), str(tmp_path / "c1"), ["k"], "ts").awaitTermination()
    before = files()
    late = batch([("k7", "2020-01-05", 70.0), ("k8", "2019-01-01", 0.0), (None, "2020-01-03", -3.0)])
    latest_table_stream(stream_of(spark, tmp_path, "two", [late]), str(path), str(tmp_path / "c2"), ["k"], "ts").awaitTermination()
    parts = lambda names: {n.split("/")[0] for n in names}
    gone = parts(before - files())
    assert 1 <= len(gone) <= 3 and len(parts(before)) > 40 and parts(files()) == parts(before)
    got = {r["k"]: r["v"] for r in read_latest_table(spark, str(path)).collect()}
    assert got == {**{f"k{i}": float(i) for i in range(200)}, "k7": 70.0, None: -3.0}
    assert read_latest_table(spark, str(path)).columns == ["k", "ts", "v"]


def test_keys_repeated_in_a_later_batch(spark, tmp_path):
    batches = [spark.createDataFrame(rows, "id long, y double") for rows in (
        [(1, 0.0), (2, 0.0)], [(3, 0.0)], [(4, 0.0), (1, 0.0)], [(4, 1.0), (5, 0.0)], [(5, 9.0)], [(None, 1.0)], [(None, 2.0)])]
    good, bad, results, keys = (str(tmp_path / d) for d in ("good", "bad", "results", "keys"))
    for attempt in range(2):  # the second attempt replays all batches
        stream = stream_of(spark, tmp_path, f"gate{attempt}", batches)
        quality_gate_stream(stream, [Check("unique", "id")], good, bad, results, str(tmp_path / f"ck{attempt}"), ["id"], keys).awaitTermination()
        assert sorted((r["batch"], r["id"]) for r in spark.read.parquet(good).where("id IS NOT NULL").collect()) == [(0, 1), (0, 2), (1, 3), (3, 4), (3, 5)]
        assert sorted((r["batch"], r["id"]) for r in spark.read.parquet(bad).where("id IS NOT NULL").collect()) == [(2, 1), (2, 4), (4, 5)]
        assert spark.read.parquet(bad).where("id IS NULL").count() == 1
    checks = spark.read.parquet(results).where("check = 'unique_across_batches'").orderBy("batch").collect()
    assert [r["observed"] for r in checks] == [0, 0, 1, 0, 1, 0, 1]
    with pytest.raises(ValueError, match="keys_path"):
        quality_gate_stream(stream, [], good, bad, results, "x", ["id"])


def test_release_deletes_only_cut_tables(spark):
    kept, gone = spark.range(3), cut(spark.range(4))
    path = gone._cut_path
    release(kept, gone)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert kept.count() == 3


class Store(dict):
    """A map state that counts what is read and written."""

    def __init__(self):
        super().__init__()
        self.reads, self.writes = [], []

    def getValue(self, key):
        self.reads.append(key[0])
        return self[key]

    def updateValue(self, key, value):
        self.writes.append(key[0])
        self[key] = ([*value[0]],)


def test_stored_scores_touch_few_blocks():
    rng = np.random.default_rng(1)
    store, kept, plain = Store(), (0, 0, (), (), ()), SortedScores()
    for step in range(40):
        scores = _StoredScores(store, *kept)
        store.reads, store.writes = [], []
        for v in rng.normal(size=500) if step < 39 else [0.01]:
            scores.add(float(v))
            plain.add(float(v))
        assert scores.higher(0.9) == plain.higher(0.9)
        scores.flush()
        kept = (scores.size, scores.next_id, scores.order, scores.tops, scores.counts)
    assert len(store) > 10 and set(store.reads) <= {*store.writes, *store.reads} and len(store.reads) <= 2 and len(store.writes) <= 2
    assert _StoredScores(store, *kept).values() == plain.values()


@pytest.fixture(scope="module")
def intervals(spark):
    rng = np.random.default_rng(3)
    n = 150
    pdf = pd.concat(pd.DataFrame({"series_id": s, "ts": hourly("2020-01-01", n), "y": rng.normal(0, 10, n), "y_lower": -4.0, "y_upper": 4.0}) for s in "ab")
    pdf.loc[pdf.index[20], "y"] = np.nan
    return spark.createDataFrame(pdf).withColumn("y", F.nanvl("y", F.lit(None))), pdf


def test_small_blocks_give_the_same_stream(spark, tmp_path, intervals):
    df, pdf = intervals
    params = AdaptiveParams(0.8, 0.05)
    edges = pd.date_range("2020-01-01", periods=5, freq="37h")
    batches = [df.where((F.col("ts") >= F.lit(a)) & (F.col("ts") < F.lit(a + pd.Timedelta("37h")))) for a in edges]
    out = drain(adaptive_conformal_stream(stream_of(spark, tmp_path, "blocks", batches), ["series_id"], "ts", params), spark, tmp_path, "blocks").toPandas()
    batch = adaptive_conformal(df, ["series_id"], "ts", params).toPandas()
    both = out.merge(batch, on=["series_id", "ts"], suffixes=("", "_b"))
    assert len(both) == 300 and both["q"].equals(both["q_b"]) and both["hit"].equals(both["hit_b"]) and not both["late"].any()


def test_rows_out_of_order_wait_for_the_watermark(spark, tmp_path, intervals):
    """Rows dealt anew within 30 hours come out as if they had come in order; a closing row empties the buffer."""
    df, pdf = intervals
    params = AdaptiveParams(0.8, 0.05)
    jumbled = df.withColumn("slot", F.floor((F.unix_seconds("ts") / 3600 + F.pmod(F.xxhash64("series_id", "ts"), F.lit(30))) / 40))
    slots = sorted(r[0] for r in jumbled.select("slot").distinct().collect())
    batches = [jumbled.where(F.col("slot") == s).drop("slot") for s in slots]
    stream = stream_of(spark, tmp_path, "jumbled", batches)
    make = lambda rows: adaptive_conformal_stream(rows, ["series_id"], "ts", params, delay="72 hours").where("series_id IS NOT NULL")
    run_to_end(stream, "ts", make, str(tmp_path / "out"), str(tmp_path / "ck"), str(tmp_path / "closing"))
    out = spark.read.parquet(str(tmp_path / "out")).toPandas()
    batch = adaptive_conformal(df, ["series_id"], "ts", params).toPandas()
    both = out.merge(batch, on=["series_id", "ts"], suffixes=("", "_b"))
    assert len(out) == len(both) == 300 and both["q"].equals(both["q_b"]) and not out["late"].any()
