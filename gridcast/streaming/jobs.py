"""Structured Streaming forms of the operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from gridcast.operators.asof import materialize_latest
from gridcast.operators.conformal import AdaptiveState, SortedScores
from gridcast.operators.quality import Check, run_checks
from gridcast.params import AdaptiveParams
from gridcast.sources.tables import cut, release


def hourly_series_stream(
    events: DataFrame, ts: str, series: str, value: str, event_id: str, delay: str = "2 hours", step: str = "1 hour"
) -> DataFrame:
    """Event stream to one row per (series, step). Repeated event ids within the delay count once; a step is emitted when
    the watermark has passed it, and events later than that are dropped."""
    fresh = events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([event_id])
    grouped = fresh.groupBy(F.window(ts, step), F.col(series).alias("series_id"))
    totals = grouped.agg(F.sum(value).alias("y"), F.count(F.lit(1)).alias("n_events"))
    return totals.select("series_id", F.col("window.start").alias("ts"), "y", "n_events")


class _StoredScores(SortedScores):
    """Sorted scores whose blocks stay in the state store until one is looked into; only changed blocks are written back."""

    def __init__(self, blocks, size: int, next_id: int, order: Sequence[int], tops: Sequence[float], counts: Sequence[int]):
        super().__init__()
        self.stored = blocks
        if size:
            self.size, self.next_id, self.order, self.tops, self.counts = size, next_id, list(order), list(tops), list(counts)
            self.blocks, self.changed = {}, set()

    def fetch(self, block_id: int) -> list[float]:
        return list(self.stored.getValue((block_id,))[0])

    def flush(self) -> None:
        for block_id in sorted(self.changed):
            self.stored.updateValue((block_id,), (self.blocks[block_id],))
        self.changed.clear()


class _AdaptiveProcessor(StatefulProcessor):
    """Adaptive conformal recursion per series, its state kept between micro-batches.

    The scores seen so far are blocks of a sorted list in a map state; level, offset, last time and the blocks' tops and
    counts are one value. A micro-batch reads the blocks that its new scores and the offset's rank fall into. With
    ``ordered``, rows wait in a second map state, by time, until the watermark has passed them.
    """

    NOW = "level double, q double, last long, size long, next_id long, ids array<long>, tops array<double>, counts array<long>"

    def __init__(self, params: AdaptiveParams, columns: tuple[str, str, str, str], initial_q: float, out: Sequence[str], ordered: bool):
        self.params, self.columns, self.initial_q, self.out, self.ordered = params, columns, initial_q, list(out), ordered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", self.NOW)
        self.blocks = handle.getMapState("blocks", "block long", "scores array<double>")
        if self.ordered:
            self.waiting = handle.getMapState("waiting", "ms long", "rows binary")

    def _step_all(self, batch: pd.DataFrame) -> pd.DataFrame:
        """Walk rows in time order; what isn't newer than the last one walked is late."""
        ts, actual, lower, upper = self.columns
        if self.now.exists():
            level, q, last, *stored = self.now.get()
            scores = _StoredScores(self.blocks, *stored)
        else:
            level, q, last, scores = None, self.initial_q, None, _StoredScores(self.blocks, 0, 0, (), (), ())
        state = AdaptiveState(self.params, q, level=level)
        state.scores = scores
        results, learnt = [], False
        times = batch[ts].astype("datetime64[us]").astype("int64")
        for t, y, lo, hi in zip(times, batch[actual], batch[lower], batch[upper], strict=True):
            if last is not None and t <= last:
                results.append((None, None, True))
            elif pd.isna(y) or pd.isna(lo) or pd.isna(hi):  # nothing to learn from, as in the batch form
                results.append((None, None, False))
            else:
                results.append((*state.step(y, lo, hi), False))
                last, learnt = int(t), True
        if learnt:
            scores.flush()
            self.now.update((float(state.level), float(state.q), last, scores.size, scores.next_id, scores.order, scores.tops, scores.counts))
        out = batch.assign(q=[r[0] for r in results], hit=pd.array([r[1] for r in results], dtype="Int32"), late=[r[2] for r in results])
        return out[self.out]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(self.columns[0])  # one series' rows of one micro-batch
        if not self.ordered:
            yield self._step_all(batch)
            return
        moments = batch[self.columns[0]].astype("datetime64[us]").astype("int64") // 1000
        for ms, part in batch.groupby(moments):
            ms = int(ms)
            held = [pickle.loads(self.waiting.getValue((ms,))[0])] if self.waiting.containsKey((ms,)) else []
            self.waiting.updateValue((ms,), (pickle.dumps(pd.concat([*held, part])),))
            self.handle.registerTimer(ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Timers expire in the order of their times, so rows are walked in time order whatever order they came in."""
        ms = expiredTimerInfo.getExpiryTimeInMs()
        batch = pickle.loads(self.waiting.getValue((ms,))[0])
        self.waiting.removeKey((ms,))
        yield self._step_all(batch.sort_values(self.columns[0]))

    def close(self) -> None:
        pass


def adaptive_conformal_stream(
    scored: DataFrame,
    keys: Sequence[str],
    ts: str,
    params: AdaptiveParams = AdaptiveParams(),
    actual: str = "y",
    lower: str = "y_lower",
    upper: str = "y_upper",
    initial_q: float = 0.0,
    delay: str | None = None,
) -> DataFrame:
    """Streaming form of `adaptive_conformal`, with the same offsets and hits.

    Without ``delay``, input must be ordered by time across micro-batches; a row not newer than the series' last one is
    passed on with ``late`` set and no offset. With ``delay``, rows wait until the watermark, that much behind the latest
    time, has passed them, so rows that come out of order by less are walked in order; those later still are dropped. Needs
    the RocksDB state store provider.
    """
    schema = T.StructType(
        [*scored.schema.fields, T.StructField("q", T.DoubleType()), T.StructField("hit", T.IntegerType()),
         T.StructField("late", T.BooleanType())]
    )
    processor = _AdaptiveProcessor(params, (ts, actual, lower, upper), initial_q, schema.fieldNames(), delay is not None)
    rows = scored if delay is None else scored.withWatermark(ts, delay)
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None" if delay is None else "EventTime"
    )


# No folder yet, or one in which no write was finished.
NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
KEY_PARTS = 64


def _key_part(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table under ``path``, or None if nothing was stored yet; anything else that can't be read raises."""
    try:
        return spark.read.parquet(path).where(F.col("key_part").isNotNull())
    except AnalysisException as error:
        if error.getCondition() not in NO_TABLE:
            raise
        return None


def _touched(rows: DataFrame) -> list[int]:
    return [r["key_part"] for r in rows.select("key_part").distinct().collect()]  # at most the number of parts


def latest_table_stream(
    features: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str, parts: int = KEY_PARTS
) -> StreamingQuery:
    """Keep a latest-row-per-entity table, partitioned by a hash of the entity.

    A micro-batch reads and rewrites only the partitions its entities fall into, so its cost follows the batch and not the
    table. Merging is by the latest time, so a replayed batch leaves the table as it is. ``parts`` must stay the same
    for one table; with more, fewer rows are rewritten.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = cut(materialize_latest(batch, keys, ts).withColumn("key_part", _key_part(keys, parts)))
        old, rows = _stored(spark, path), fresh
        if old is not None:
            rows = old.where(F.col("key_part").isin(_touched(fresh))).select(*fresh.columns).unionByName(fresh)
        merged = cut(materialize_latest(rows, [*keys, "key_part"], ts))  # the table isn't overwritten while it's read
        writer = merged.repartition("key_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("key_part").parquet(path)
        release(fresh, merged)

    return (
        features.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_latest_table(spark: SparkSession, path: str) -> DataFrame | None:
    stored = _stored(spark, path)
    return None if stored is None else stored.drop("key_part")


def run_to_end(
    source: DataFrame, ts: str, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, closing: str, past: str = "7 days"
) -> None:
    """Run an append-mode query over a finite stream until every window is emitted, not only those the watermark passed.

    After the data is used up, one row with nothing but a time, ``past`` after the latest one seen, is put into the folder
    ``closing``, and the query goes on from its checkpoint: this last micro-batch moves the watermark past all data. Its
    own window stays open, so nothing of it is emitted. ``past`` must exceed the query's delay and window together.
    """
    spark = source.sparkSession
    empty = spark.createDataFrame([], source.schema)
    empty.write.mode("append").parquet(closing)
    both = source.unionByName(spark.readStream.schema(source.schema).parquet(closing))

    def drain() -> StreamingQuery:
        out = transform(both).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        query = out.trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    seen = [p["eventTime"]["max"] for p in drain().recentProgress if "max" in (p["eventTime"] or {})]
    if not seen:
        return  # no rows
    late = F.to_timestamp(F.lit(max(seen))) + F.expr(f"INTERVAL {past}")
    row = spark.range(1).select(*[(late if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in source.schema.fields])
    row.write.mode("append").parquet(closing)
    drain()


def error_monitor_stream(
    scored: DataFrame, baseline: DataFrame, keys: Sequence[str], ts: str, actual: str, predicted: str,
    ratio: float = 1.5, delay: str = "2 hours", span: str = "1 day",
) -> DataFrame:
    """MAPE per tumbling span, flagged when above ``ratio`` times the series' ``baseline_mape`` (a static table)."""
    error = F.when(F.col(actual) != 0, F.abs((F.col(actual) - F.col(predicted)) / F.col(actual)))
    spans = (
        scored.withWatermark(ts, delay).groupBy(F.window(ts, span), *keys).agg((F.avg(error) * 100).alias("mape"))
    )
    joined = spans.join(baseline, list(keys), "left")
    flag = F.coalesce(F.col("mape") > F.col("baseline_mape") * ratio, F.lit(False))
    return joined.select(*keys, F.col("window.start").alias("span_start"), "mape", "baseline_mape", flag.alias("drift_flag"))


def quality_gate_stream(
    raw: DataFrame, checks: Sequence[Check], good_path: str, quarantine_path: str, results_path: str, checkpoint: str,
    unique: Sequence[str] = (), keys_path: str | None = None, parts: int = KEY_PARTS,
) -> StreamingQuery:
    """Check each micro-batch; write it to the good table, or to quarantine if a hard check failed.

    With ``unique``, no key may occur in two good batches either: the hashes of the keys of good batches are kept under
    ``keys_path``, by batch and part of the hash, and a batch is looked up in the parts its own keys fall into. A key that
    was only ever in quarantine isn't taken. A replayed batch sees the batches before it and so gets the same verdict.
    """
    if unique and keys_path is None:
        raise ValueError("unique keys across batches need keys_path")
    spark = raw.sparkSession
    across = "check string, column string, severity string, observed double, threshold double, success boolean"

    def repeated(keys: DataFrame, batch_id: int) -> int:
        old = _stored(spark, keys_path)
        if old is None:
            return 0
        old = old.where((F.col("batch") < batch_id) & F.col("key_part").isin(_touched(keys)))
        return keys.join(old.select("key_part", "h1", "h2"), ["key_part", "h1", "h2"], "left_semi").count()

    def route(batch: DataFrame, batch_id: int) -> None:
        batch = cut(batch)
        results = run_checks(batch, checks)
        if unique:
            hashes = batch.select(_key_part(unique, parts).alias("key_part"), F.xxhash64(*unique).alias("h1"), F.xxhash64(F.lit(1), *unique).alias("h2"))
            keys = cut(hashes.distinct())
            n = repeated(keys, batch_id)
            row = batch.sparkSession.createDataFrame([("unique_across_batches", ",".join(unique), "hard", float(n), 0.0, n == 0)], across)
            results = results.unionByName(row)
        results = cut(results)
        failed = results.where((F.col("severity") == "hard") & ~F.col("success")).count()
        if unique and not failed:
            keys.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("key_part").parquet(f"{keys_path}/batch={batch_id}")
        target = quarantine_path if failed else good_path
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        results.write.mode("overwrite").parquet(f"{results_path}/batch={batch_id}")
        release(batch, results, *([keys] if unique else []))

    return raw.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
