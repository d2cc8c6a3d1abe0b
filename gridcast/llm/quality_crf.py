"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's features describe its shape and that of the lines before and after it;
neighbouring labels are tied by transition weights. Training lines take their document's label. A document's quality is
the mean of its lines' probabilities of being good (forward-backward marginals), weighted by line length, mapped to a
calibrated score by a logistic curve fitted on the same training documents.

The field is fitted on at most ``sample`` labelled documents, chosen by a hash of their key; everything is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.text import SPACE, batch_of, blocks, bounded_batches, flat, only, span_hashes, word_spans

SAMPLE = 4000
STEPS = 200
SYMBOLS = b"#*$%&|<>{}[]\\^~_=@"
SHAPES = 15


def _among(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


UPPER, DIGIT = _among(bytes(range(65, 91))), _among(b"0123456789")
LETTER = UPPER | _among(bytes(range(97, 123)))
SIGN, LOUD, STOP = _among(SYMBOLS), _among(b"!?"), _among(b".!?:;\"'")
WIDE = np.arange(256) >= 0xC2  # first bytes of characters beyond ASCII


def line_shapes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shape features of every line of the block, lines' lengths, and the number of lines before each text."""
    data, offsets = flat(batch.column("text"))
    breaks = np.flatnonzero(data == 10)
    # A text's first line starts where the text does, so an empty text is one empty line.
    first = np.concatenate([offsets[:-1], breaks + 1])
    whose = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((first, whose))
    begin, owner = first[order], whose[order]
    end = np.concatenate([begin[1:], [len(data)]])
    end = np.where(np.concatenate([owner[1:] != owner[:-1], [True]]), offsets[owner + 1], end - 1)
    size = end - begin

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[end] - sums[begin]).astype(np.float64)

    starts, ends, _ = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    line = np.searchsorted(begin, starts, "right") - 1  # the last of lines that begin here is the one with bytes
    n = len(begin)
    words = np.bincount(line, minlength=n).astype(float)
    pairs = np.lexsort((hashes, line))
    new = np.ones(len(pairs), bool)
    new[1:] = (line[pairs][1:] != line[pairs][:-1]) | (hashes[pairs][1:] != hashes[pairs][:-1])
    distinct = np.bincount(line[pairs][new], minlength=n)
    marked = np.bincount(line, SIGN[data[ends - 1]] | LOUD[data[ends - 1]], minlength=n) if len(ends) else np.zeros(n)
    longest = np.zeros(n)
    np.maximum.at(longest, line, (ends - starts).astype(float))
    letters, wide = total(LETTER[data]), total(WIDE[data])
    whole = span_hashes(data, begin[size > 0], end[size > 0], fold=False)
    names = np.zeros(n, np.uint64)
    names[size > 0] = whole
    key = np.lexsort((np.arange(n), names, owner))
    again = np.zeros(n)
    same = (owner[key][1:] == owner[key][:-1]) & (names[key][1:] == names[key][:-1]) & (size[key][1:] > 0)
    again[key[1:]] = same
    low = np.maximum(size, 1)
    last = np.zeros(n)
    some = size > 0
    last[some] = STOP[data[end[some] - 1]]
    head = np.zeros(n)
    head[some] = UPPER[data[begin[some]]] | WIDE[data[begin[some]]]
    shapes = np.stack(
        [
            np.log1p(size) / 5, np.log1p(words) / 4, total(UPPER[data]) / np.maximum(letters, 1), total(DIGIT[data]) / low,
            5 * total(SIGN[data]) / low, 5 * total(LOUD[data]) / low, wide / low, total(~SPACE[data]) / np.maximum(words, 1) / 10,
            distinct / np.maximum(words, 1), marked / np.maximum(words, 1), np.log1p(longest) / 4, again, last, head,
            (size == 0).astype(float),
        ], axis=1,
    )
    return shapes, size, np.concatenate([np.searchsorted(owner, np.arange(len(offsets) - 1)), [n]])


def with_neighbours(shapes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Each line's features: its shape, the previous and the next line's shape (zeros at the ends), two end marks, one."""
    n = len(shapes)
    prev, next_ = np.zeros_like(shapes), np.zeros_like(shapes)
    prev[1:], next_[:-1] = shapes[:-1], shapes[1:]
    firsts, lasts = before[:-1], before[1:] - 1
    prev[firsts], next_[lasts] = 0, 0
    ends = np.zeros((n, 3))
    ends[firsts, 0], ends[lasts, 1], ends[:, 2] = 1, 1, 1
    return np.concatenate([shapes, prev, next_, ends], 1)


WIDTH = 3 * SHAPES + 3


def marginals(emit: np.ndarray, turn: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once: P(good) per line, expected transitions per chain step summed, log Z.

    ``emit`` is the good label's score of each line, ``turn[i, j]`` that of label j after label i.
    """
    length = np.diff(before)
    order = np.argsort(-length, kind="stable")
    start, length = before[:-1][order], length[order]
    n, top = len(emit), int(length.max(initial=0))
    score = np.stack([np.zeros(n), emit], 1)
    forward, backward = np.empty((n, 2)), np.zeros((n, 2))
    live = np.searchsorted(-length, -np.arange(top), "left") if top else np.zeros(0, int)  # chains longer than t
    forward[start] = score[start]
    for t in range(1, top):
        at = start[: live[t]] + t
        forward[at] = score[at] + _log_sum(forward[at - 1][:, :, None] + turn[None], 1)
    for t in range(top - 2, -1, -1):
        at = start[: live[t + 1]] + t
        backward[at] = _log_sum(turn[None] + (score[at + 1] + backward[at + 1])[:, None, :], 2)
    ends = before[1:] - 1
    log_z = _log_sum(forward[ends], 1)
    z = np.repeat(log_z, np.diff(before))
    good = np.exp(np.minimum(0, forward[:, 1] + backward[:, 1] - z))
    inner = np.ones(n, bool)
    inner[before[:-1]] = False
    at = np.flatnonzero(inner)
    steps = forward[at - 1][:, :, None] + turn[None] + (score[at] + backward[at])[:, None, :] - z[at][:, None, None]
    return good, np.exp(np.minimum(0, steps)), log_z


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass(frozen=True)
class Field:
    """Fitted weights: line features, transitions, and the two numbers of the calibration curve."""

    weights: np.ndarray
    turn: np.ndarray
    slope: float
    shift: float

    def quality(self, shapes: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
        good, _, _ = marginals(with_neighbours(shapes, before) @ self.weights, self.turn, before)
        weight = np.maximum(size, 1).astype(float)
        return np.add.reduceat(good * weight, before[:-1]) / np.add.reduceat(weight, before[:-1])

    def scores(self, batch: pa.RecordBatch) -> np.ndarray:
        shapes, size, before = line_shapes(batch)
        return 1 / (1 + np.exp(-(self.slope * _logit(self.quality(shapes, size, before)) + self.shift)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_field(shapes: np.ndarray, size: np.ndarray, before: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> Field:
    """Conditional likelihood of the training chains, each chain weighted alike, by full-batch Adam with weight decay."""
    x, y = with_neighbours(shapes, before), np.repeat(labels, np.diff(before)).astype(int)
    each = np.repeat(1 / np.diff(before), np.diff(before)) / len(labels)
    inner = np.ones(len(x), bool)
    inner[before[:-1]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((len(at), 2, 2))
    seen[np.arange(len(at)), y[at - 1], y[at]] = 1
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        good, moves, _ = marginals(x @ theta[:-4], theta[-4:].reshape(2, 2), before)
        slope = np.concatenate([x.T @ ((y - good) * each), ((seen - moves) * each[at][:, None, None]).sum(0).ravel()]) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    field = Field(theta[:-4], theta[-4:].reshape(2, 2), 1.0, 0.0)
    q, a, b = _logit(field.quality(shapes, size, before)), 1.0, 0.0
    for _ in range(50):  # Newton steps for the calibration, kept tame by a small penalty
        p = 1 / (1 + np.exp(-(a * q + b)))
        w = p * (1 - p)
        g = np.array([((labels - p) * q).sum() - 0.1 * (a - 1), (labels - p).sum() - 0.1 * b])
        h = np.array([[(w * q * q).sum() + 0.1, (w * q).sum()], [(w * q).sum(), w.sum() + 0.1]])
        a, b = np.array([a, b]) + np.clip(np.linalg.solve(h, g), -1, 1)
    return Field(field.weights, field.turn, float(max(a, 0.05)), float(b))


def train_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                  sample: int = SAMPLE) -> Field:
    """Fit on the labelled documents with the ``sample`` smallest key hashes.

    Null, contradicting or unknown labels are left out. Without labelled documents, or with one kind of label, every
    text scores the share of label 1 (0.5 without any).
    """
    bounded_batches(docs.sparkSession)
    known = only(labels, key, label).toDF("key", "label").filter("key is not null and label in (0, 1)")
    known = known.groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other")
    docs = only(docs, key, text).toDF("key", "text")
    # The sample is drawn before texts are read, so only its keys, a stated number, are sent out.
    chosen = known.join(docs.select("key"), "key", "left_semi").select("key", "label")
    chosen = chosen.orderBy(F.xxhash64(F.col("key").cast("string")), "key").limit(sample)
    schema = pa.schema([("label", pa.int32()), ("shapes", pa.binary()), ("size", pa.binary()), ("key", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            shapes, size, before = line_shapes(b)
            rows = [(shapes[i:j].astype(np.float32).tobytes(), size[i:j].tobytes()) for i, j in zip(before, before[1:], strict=False)]
            yield batch_of(schema, b.column("label").cast(pa.int32()), *zip(*rows, strict=True), b.column("key").cast(pa.string()))

    got = docs.join(F.broadcast(chosen), "key").select("key", "label", "text")
    rows = got.mapInArrow(run, "label int, shapes binary, size binary, key string").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["key"], r["shapes"]))
    y = np.array([r["label"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return Field(np.zeros(WIDTH), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    shapes = np.concatenate([np.frombuffer(r["shapes"], np.float32).reshape(-1, SHAPES) for r in rows]).astype(float)
    size = np.concatenate([np.frombuffer(r["size"], np.int64) for r in rows])
    before = np.cumsum([0, *(len(r["size"]) // 8 for r in rows)])
    return fit_field(shapes, size, before, y)


def add_quality(docs: DataFrame, field: Field, text: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns, with the score of the whole text as a further column.

    A null text counts as empty, which is one blank line; rows are scored one by one, so repeated rows get one score. An
    existing column called ``name`` is replaced. An empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop(name) if name in docs.columns else docs
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = pa.RecordBatch.from_arrays([batch.column(place)], ["text"]), 0
            for b in blocks(iter([texts])):
                rows = batch.slice(at, b.num_rows)
                at += b.num_rows
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(field.scores(b))], [*rows.schema.names, name])

    return docs.mapInArrow(run, schema)
