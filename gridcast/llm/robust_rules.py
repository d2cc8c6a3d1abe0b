"""Quality rules from whole-text counts, and robust multivariate outliers within each language and source.

Texts that fail the plain rules are rejected first. For the others, a vector of transformed counts is compared with its
group's minimum-covariance-determinant estimate: the centre and covariance of the ``share`` of the group whose distances
are smallest, found by concentration steps from medians and absolute deviations. Every step is a pair of aggregations
over the table of vectors: a histogram of distances per group gives the limit below which the share lies, then sums and
products below it give the next estimate. Groups under ``MIN_GROUP`` rows use their language's estimate, and languages
under it the whole table's.

Distances are scaled so that a group's median distance is that of a normal vector; a squared distance beyond ``limit``
rejects. Variances have a floor, so a statistic that is the same in most texts rejects no one for a small difference.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.text import blocks, bounded_batches, flat, only, span_hashes, window_hashes, word_spans
from gridcast.operators.skew import join_groups
from gridcast.sources.tables import cut

SHARE, STEPS, MIN_GROUP = 0.75, 4, 200
LIMIT = 120.0
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
MARKS = np.zeros(256, bool)
MARKS[list(b"!?{}[]\\^~_=@")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_marks", "n_distinct")
NAMES = ("words", "word_length", "symbols", "repeats", "upper", "marks", "distinct")
# Standard deviations that a statistic has at least, in the units of its transform.
FLOOR = (0.5, 0.08, 0.08, 0.08, 0.08, 0.06, 0.06)
P = len(NAMES)
BANDS = 48  # of the distance histogram, for each doubling


def text_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the counts of column ``text``; a null text has zeros."""
    schema = docs.select(*keep).schema
    for name in (*COUNTS, *EXTRA):
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            columns = [pa.array(c, pa.int64()) for c in count_block(b)]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), *columns], schema.names)

    return docs.select(*keep, "text").mapInArrow(run, schema)


def count_block(batch: pa.RecordBatch) -> list[np.ndarray]:
    data, offsets = flat(batch.column("text"))
    starts, ends, before = word_spans(data, offsets)
    words, n = np.diff(before), len(offsets) - 1
    within = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])
    space = np.isin(data, np.array([32, *range(9, 14)], np.uint8))
    chars = within(~space & ((data & 0xC0) != 0x80))
    hashes = span_hashes(data, starts, ends, fold=False)
    # Words of 3-word windows that the text holds twice or more.
    windows, first, _ = window_hashes(hashes, before, 3)
    owner = np.searchsorted(before, first, "right") - 1
    twice = first[_repeated(owner, windows, every=True)]
    covered = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + 3, -1)
    sums = np.concatenate([[0], np.cumsum(np.cumsum(covered)[:-1] > 0)])
    # Lines with a word that equal an earlier line.
    breaks = np.flatnonzero(data == 10)
    begin = np.concatenate([offsets[:-1], breaks + 1])
    whose = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((begin, whose))
    begin, whose = begin[order], whose[order]
    last = np.concatenate([whose[1:] != whose[:-1], [True]]) if n else np.zeros(0, bool)
    end = np.where(last, offsets[whose + 1], np.concatenate([begin[1:], [0]])[: len(begin)] - 1)
    filled = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, whose = begin[filled], end[filled], whose[filled]
    lines = np.bincount(whose[_repeated(whose, span_hashes(data, begin, end, fold=False), every=False)], minlength=n)
    owner = np.repeat(np.arange(n), words)
    distinct = words - np.bincount(owner[_repeated(owner, hashes, every=False)], minlength=n)
    return [words, chars, within(SYMBOLS[data]), lines, np.diff(sums[before]), within(UPPER[data]), within(MARKS[data]), distinct]


def _repeated(group: np.ndarray, value: np.ndarray, every: bool) -> np.ndarray:
    """Indexes whose value occurs before in its group, or, with ``every``, at all elsewhere in it."""
    order = np.lexsort((np.arange(len(value)), value, group))
    same = (group[order][1:] == group[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.concatenate([[False], same]) if len(order) else np.zeros(0, bool)
    if every and len(order):
        out |= np.concatenate([same, [False]])
    return order[out]


def statistics() -> dict[str, Column]:
    """The transformed statistics of a text with words."""
    n = F.col("n_words")
    root = lambda c: F.sqrt(F.col(c) / n)
    return {
        "words": F.log(n), "word_length": F.log(F.col("word_chars") / n), "symbols": root("n_symbols"), "repeats": root("n_repeat_words"),
        "upper": F.sqrt(F.col("n_upper") / F.col("word_chars")), "marks": root("n_marks"),
        "distinct": F.log(F.col("n_distinct") / n) / F.log(n + 1),
    }


def _distance(center: str = "center", inverse: str = "inverse") -> Column:
    d = [F.col(c) - F.col(center)[i] for i, c in enumerate(NAMES)]
    total = F.lit(0.0)
    for i in range(P):
        for j in range(i, P):
            total = total + F.col(inverse)[i * P + j] * d[i] * d[j] * (1 if i == j else 2)
    return F.greatest(total, F.lit(0.0))


def _quantile_band(bands: DataFrame, share: float) -> DataFrame:
    """(g, band): the first band at which ``share`` of the group is reached."""
    w = Window.partitionBy("g").orderBy("band")
    run = bands.withColumn("upto", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy("g")))
    return run.filter(F.col("upto") >= F.col("all") * share).groupBy("g").agg(F.min("band").alias("band"))


def _band(distance: Column) -> Column:
    return F.floor(F.log2(distance + 1e-9) * BANDS).cast("int")


def _estimates(sums: DataFrame) -> DataFrame:
    """(g, center, inverse) from counts, sums and products."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples():
                mean = np.array(r.sums) / r.n
                cov = np.zeros((P, P))
                cov[np.triu_indices(P)] = np.array(r.products) / r.n
                cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(mean, mean)
                scale = np.sqrt(np.maximum(np.diag(cov), 0)) + 1e-12
                grown = np.maximum(scale, FLOOR) / scale  # keeps correlations and lifts small variances
                cov = cov * np.outer(grown, grown) * 0.9
                cov[np.diag_indices(P)] = np.maximum(scale, FLOOR) ** 2
                rows.append((r.g, mean.tolist(), np.linalg.inv(cov).ravel().tolist()))
            yield pd.DataFrame(rows, columns=["g", "center", "inverse"])

    return sums.mapInPandas(run, "g string, center array<double>, inverse array<double>")


def _start(vectors: DataFrame) -> DataFrame:
    """Medians and, as a diagonal, inverse squares of the half widths of the middle half."""
    bands = [F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(c) for c in NAMES]
    found = vectors.groupBy("g").agg(*bands)
    width = [F.greatest((F.col(c)[2] - F.col(c)[0]) / 1.349, F.lit(f)) for c, f in zip(NAMES, FLOOR, strict=True)]
    zero = F.lit(0.0)
    cells = [1 / (width[i] * width[i]) if i == j else zero for i in range(P) for j in range(P)]
    return found.select("g", F.array(*[F.col(c)[1] for c in NAMES]).alias("center"), F.array(*cells).alias("inverse"))


def estimate_groups(vectors: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """(g, center, inverse, scale) of every group ``g`` of the vectors."""
    now = _start(vectors)
    for step in range(steps + 1):
        measured = cut(join_groups(vectors, now, ["g"]).withColumn("band", _band(_distance())))
        bands = measured.groupBy("g", "band").agg(F.count("*").alias("n"))
        if step == steps:
            half = _quantile_band(bands, 0.5)
            # The median of a chi-squared variable with P degrees of freedom, nearly.
            usual = P * (1 - 2 / (9 * P)) ** 3
            scale = half.select("g", (F.lit(usual) / F.greatest(F.pow(F.lit(2.0), (F.col("band") + 0.5) / BANDS), F.lit(usual / 4))).alias("scale"))
            return cut(measured.groupBy("g").agg(F.first("center").alias("center"), F.first("inverse").alias("inverse")).join(scale, "g"))
        inside = join_groups(measured.drop("center", "inverse"), _quantile_band(bands, share).withColumnRenamed("band", "top"), ["g"])
        products = [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])) for i in range(P) for j in range(i, P)]
        now = _estimates(
            inside.filter("band <= top").groupBy("g").agg(
                F.count("*").alias("n"), F.array(*[F.sum(c) for c in NAMES]).alias("sums"), F.array(*products).alias("products")
            )
        )


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
                  limit: float = LIMIT) -> DataFrame:
    """One row per row: key, the counts, base_failed, distance (null where the base rules failed) and kept.

    A null or blank text fails the base rules. A null language or source is a group of its own. Rows are judged one by
    one, so repeated rows get equal verdicts. Other columns aren't read; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    docs = only(docs, key, text, lang, source).toDF("key", "text", "lang", "source")
    counts = text_counts(docs, "key", "lang", "source")
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    counts = counts.withColumn("base_failed", (n < 50) | (100 * repeats > 50 * n))
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    counts = cut(counts.withColumn("l", part("lang")).withColumn("s", part("source")))
    sizes = counts.filter("not base_failed").groupBy("l", "s").agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy("l")
    pair = F.concat_ws("/", "l", "s")
    named = F.when(F.col("n") >= MIN_GROUP, pair).when(F.sum("n").over(by_lang) >= MIN_GROUP, F.concat(F.lit("*/"), "l")).otherwise(F.lit("*"))
    groups = cut(sizes.select("l", "s", named.alias("g")))
    vectors = counts.filter("not base_failed").withColumns(statistics()).select("l", "s", *NAMES)
    own = join_groups(vectors, groups, ["l", "s"])
    pooled = groups.filter(F.col("g").startswith("*")).select("g").distinct()
    # A pooled estimate is learnt from the whole language or table, not from its small groups alone.
    langs = vectors.withColumn("g", F.concat(F.lit("*/"), "l")).join(F.broadcast(_few(pooled.filter("g != '*'"))), "g", "left_semi")
    every = vectors.withColumn("g", F.lit("*")).join(F.broadcast(_few(pooled.filter("g = '*'"))), "g", "left_semi")
    train = own.filter(~F.col("g").startswith("*")).select("g", *NAMES).unionByName(langs.select("g", *NAMES)).unionByName(every.select("g", *NAMES))
    found = estimate_groups(cut(train))
    models = groups.join(found, "g").select("l", "s", "center", "inverse", "scale")
    judged = join_groups(counts.filter("not base_failed").withColumns(statistics()), models, ["l", "s"])
    distance = F.round(_distance() * F.col("scale"), 6)
    names = ["key", *COUNTS, "base_failed"]
    good = judged.select(*names, distance.alias("distance"), (distance <= limit).alias("kept"))
    bad = counts.filter("base_failed").select(*names, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return good.unionByName(bad).withColumnRenamed("key", key)


def _few(names: DataFrame) -> DataFrame:
    """Group names of languages: as many rows as there are languages, checked before they're sent out."""
    stored = cut(names)
    if (n := stored.count()) > 100_000:
        raise ValueError(f"{n} languages with small sources; map them to fewer first")
    return stored
