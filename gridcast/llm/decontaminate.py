"""Benchmark passages in documents: SimHash of item-sized word windows, multi-index Hamming search, exact verification.

Similarity of an item and a window of as many words is the weighted Jaccard similarity of their word shingles: a
shingle counts as often as it occurs, divided by the number of items of the whole benchmark that have it. A document with
fewer words than the item is one window. A window that shares no shingle with any item has similarity 0, so only windows
around shared shingles are fingerprinted.

A fingerprint is 128 bits: the signs of sums over the shingles, each as large as the root of its weight times its count.
Then the cosine of two such vectors is at least 2J / (1 + J) at weighted similarity J, whatever the weights, and a bit
differs with probability arccos(2J / (1 + J)) / pi at most. `radius` is five standard deviations above the mean of that:
19.4 + 5 * 4.1 = 40 bits at 80 percent. A fingerprint is cut into 16 blocks; if two differ in at most R bits, some block
differs in at most R // 16, so probing each block's neighbours of that many bits finds every item within the radius.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.text import blocks, bounded_batches, flat, mix, only, span_hashes, window_hashes, word_spans

BITS, BLOCKS, DEVIATIONS = 128, 16, 5
INDEX_BYTES = 16 << 20
FILTER_BITS = 20
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def radius(percent: int) -> int:
    """The number of bits by which fingerprints of sets with at least that similarity may differ."""
    share = min(1.0, max(0.0, percent / 100))
    p = math.acos(2 * share / (1 + share)) / math.pi
    return min(BITS, math.ceil(BITS * p + DEVIATIONS * math.sqrt(BITS * p * (1 - p))))


def fingerprints(shingles: np.ndarray, weights: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The fingerprint, as bytes, of the ``n`` shingles from each position in ``first``; ``weights`` are the shingles'."""
    both = np.stack([mix(shingles), mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))], 1)
    signs = np.unpackbits(both.view(np.uint8).reshape(len(shingles), BITS // 8), axis=1).astype(float) * 2 - 1
    size = np.sqrt(weights)
    if len(np.unique(shingles)) == len(shingles):
        total = np.zeros((len(shingles) + 1, BITS))
        np.cumsum(signs * size[:, None], axis=0, out=total[1:])
        sums = total[first + n] - total[first]
    else:  # a shingle that occurs c times counts as the root of c, which no running sum gives
        sums = np.empty((len(first), BITS))
        for i, at in enumerate(first.tolist()):
            _, one, count = np.unique(shingles[at : at + n], return_index=True, return_counts=True)
            sums[i] = (size[at + one] * np.sqrt(count)) @ signs[at + one]
    return np.packbits(sums > 1e-9, axis=1)


class Index:
    """The items of one share of the benchmark, at most ``INDEX_BYTES`` of text or one longer item."""

    def __init__(self, ids: list, texts: list, size: int, percent: int, shared: dict):
        """``shared`` has the number of items of the whole benchmark for each shingle of several items."""
        self.size, self.percent, self.shared, self.radius = size, percent, shared, radius(percent)
        self.common = np.array(sorted(shared), np.uint64)
        self.common_weights = np.array([1 / shared[s] for s in self.common.tolist()])
        self.ids, self.words, self.counts, self.marks = [], [], [], []
        owners: dict[int, set] = defaultdict(set)
        for key, text in zip(ids, texts, strict=True):
            data, offsets = flat(pa.array([text], pa.string()))
            starts, ends, before = word_spans(data, offsets)
            if not len(starts):
                continue
            shingles = _shingles(span_hashes(data, starts, ends), before, size)
            for s in shingles.tolist():
                owners[s].add(len(self.ids))
            self.ids.append(key)
            self.words.append(len(starts))
            self.counts.append(Counter(shingles.tolist()))
            self.marks.append(fingerprints(shingles, self.weights(shingles), np.zeros(1, np.int64), len(shingles))[0])
        self.owners = {s: sorted(o) for s, o in owners.items()}
        self.known = np.array(sorted(self.owners), np.uint64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.known >> np.uint64(64 - FILTER_BITS)] = True
        self.lengths = {m: [i for i, n in enumerate(self.words) if n == m] for m in set(self.words)}
        near = ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= self.radius // BLOCKS
        self.probe = {}  # for each item length: block, value of the block -> items whose block is near
        for m, items in self.lengths.items():
            marks = np.array([self.marks[i] for i in items])
            self.probe[m] = np.stack([near[:, marks[:, b]] for b in range(BLOCKS)])

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        """One divided by the number of items that have the shingle; 1 for a shingle of one item or none."""
        out = np.ones(len(shingles))
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, shingles), len(self.common) - 1)
            same = self.common[at] == shingles
            out[same] = self.common_weights[at[same]]
        return out

    def similarity(self, item: int, window: Counter) -> float:
        own, both, all_ = self.counts[item], 0.0, 0.0
        for s in own.keys() | window.keys():
            weight = 1 / self.shared.get(s, 1)
            both += weight * min(own[s], window[s])
            all_ += weight * max(own[s], window[s])
        return both / all_

    def matches(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(row, item, similarity, first word, words, differing bits) of the best window for each row and item found."""
        data, offsets = flat(batch.column("text"))
        starts, ends, before = word_spans(data, offsets)
        words = span_hashes(data, starts, ends)
        for k in {min(self.size, m) for m in self.lengths}:
            shingles, first, _ = window_hashes(words, before, k)
            seen = np.flatnonzero(self.filter[shingles >> np.uint64(64 - FILTER_BITS)])
            seen = seen[np.isin(shingles[seen], self.known)]
            rows = np.searchsorted(before, first[seen], "right") - 1
            todo: dict[tuple[int, int], list[int]] = defaultdict(list)
            for row, at, s in zip(rows.tolist(), first[seen].tolist(), shingles[seen].tolist(), strict=True):
                for m in {self.words[i] for i in self.owners[s] if min(self.size, self.words[i]) == k}:
                    todo[row, m].append(at)
            best: dict[tuple[int, int], tuple] = {}
            for (row, m), hits in todo.items():
                length = min(m, int(before[row + 1] - before[row]))
                low, high = int(before[row]), int(before[row + 1]) - length  # of a window's first word
                spots = np.unique(np.concatenate([np.arange(max(low, h + k - length), min(high, h) + 1) for h in hits]))
                at = np.searchsorted(first, spots)
                own = shingles[at[0] : at[-1] + length - k + 1]
                marks = fingerprints(own, self.weights(own), at - at[0], length - k + 1)
                items = self.lengths[m]
                close = np.zeros((len(spots), len(items)), bool)
                for b in range(BLOCKS):
                    close |= self.probe[m][b][marks[:, b]]
                for w, j in zip(*np.nonzero(close), strict=True):
                    bits = int(ONES[marks[w] ^ self.marks[items[j]]].sum())
                    if bits > self.radius:
                        continue
                    window = Counter(own[at[w] - at[0] : at[w] - at[0] + length - k + 1].tolist())
                    score = self.similarity(items[j], window)
                    if 100 * score >= self.percent - 1e-9:
                        found = (-score, int(spots[w]) - int(before[row]), length, bits)
                        best[row, items[j]] = min(best.get((row, items[j]), found), found)
            for (row, item), (score, at, length, bits) in sorted(best.items()):
                yield row, item, -score, at, length, bits


def _shingles(words: np.ndarray, before: np.ndarray, size: int) -> np.ndarray:
    """The shingles of one text; fewer words than ``size`` are one."""
    return window_hashes(words, before, min(size, len(words)))[0]


def _shared_shingles(items: DataFrame, size: int) -> dict[int, int]:
    """The number of items that have it, for each shingle of several items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            found = []
            for text in b.column("text").to_pylist():
                data, offsets = flat(pa.array([text], pa.string()))
                starts, ends, before = word_spans(data, offsets)
                if len(starts):
                    found.append(np.unique(_shingles(span_hashes(data, starts, ends), before, size)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["shingle"])

    counts = items.select("text").mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    got = counts.filter("n > 1").toArrow()
    return dict(zip(got.column("shingle").to_numpy().view(np.uint64).tolist(), got.column("n").to_pylist(), strict=True))


def _indexes(spark: SparkSession, items: DataFrame, key: str, text: str, size: int, percent: int) -> Iterator[Index]:
    """The benchmark in shares of a checked size, each small enough to go to every task with the shared shingles' counts."""
    items = only(items, key, text).toDF("key", "text").filter("text is not null and key is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = -(-total // INDEX_BYTES)
    shared = _shared_shingles(items, size) if shares else {}
    for share in range(shares):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(shares)) == share).orderBy("key", "text").toArrow()
        index = Index(rows.column(0).to_pylist(), rows.column(1).to_pylist(), size, percent, shared)
        index.kind = rows.column(0).type
        yield index


def find_benchmark(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                   item_text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Best match of every document and item: key, item key, similarity, first_word, n_words, bits (fingerprints' distance).

    Windows have the item's number of words, or are a whole shorter document. An item with fewer words than ``size`` is one shingle. Null and blank
    texts and items match nothing; repeated items each match; a repeated document key has rows for each of its rows.
    Ties take the earliest window. Only the named columns are read. No items or no documents give no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = only(docs, key, text).toDF("key", "text")
    kind, item_kind = docs.schema["key"].dataType, items.schema[item_key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField(item_key, item_kind), T.StructField("similarity", T.DoubleType()),
                           T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("bits", T.IntegerType())])
    out = spark.createDataFrame([], schema)
    for index in _indexes(spark, items, item_key, item_text, size, percent):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, arrow = shared.value, None
            for b in blocks(batches):
                found = [(b.column("key")[row], index.ids[i], score, at, length, bits)
                         for row, i, score, at, length, bits in index.matches(b)]
                if found:
                    columns = list(zip(*found, strict=True))
                    arrow = [pa.array([x.as_py() for x in columns[0]], b.schema.field("key").type), pa.array(columns[1], index.kind),
                             pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int64()),
                             pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.int32())]
                    yield pa.RecordBatch.from_arrays(arrow, [key, item_key, "similarity", "first_word", "n_words", "bits"])

        out = out.unionByName(docs.mapInArrow(run, schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
                      size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no passage like an item; see ``find_benchmark``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    place = docs.columns.index(text)
    for index in _indexes(spark, items, item_key, item_text, size, percent):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, b in _with_texts(batch, place):
                    hit = {row for row, *_ in shared.value.matches(b)}
                    yield rows.filter(pa.array([i not in hit for i in range(rows.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def _with_texts(batch: pa.RecordBatch, place: int) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch]]:
    """Blocks of whole rows, each with its texts alone."""
    texts = pa.RecordBatch.from_arrays([batch.column(place)], ["text"])
    at = 0
    for b in blocks(iter([texts])):
        yield batch.slice(at, b.num_rows), b
        at += b.num_rows
