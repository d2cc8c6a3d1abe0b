"""Personal data in texts, in DataFrame expressions only: exact patterns, and boosted trees over wider candidates.

* Base spans: e-mail addresses, IP addresses, card numbers and phone numbers by their patterns and checks.
* Candidates: two generators with high recall (things around an at sign, runs of digits and separators), whose spans may
  overlap. Gradient-boosted trees score each by its form and its surroundings; they learn from candidates of a sample of
  at most ``sample`` documents, positive where a candidate meets a base span. For each generator, the score from which
  ``precision`` of all other documents' candidates are positive is the threshold; of overlapping candidates the best stays.

The trees become one SQL expression over an array of candidates, so finding, scoring and redacting read each row once,
without a shuffle. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.text import only
from gridcast.sources.tables import cut

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
# The base patterns, written so that each run of characters is entered once: a start inside a run that has failed would
# fail as well, unless the last match ended there.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "around_at": r"[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}+)*+",
    "digits": r"(?<![0-9])[+(]{0,2}+[0-9](?:[ ().\-/]{0,2}+[0-9]){3,40}+",
}
NEEDS = {"email": "@", "ip": None, "card": None, "phone": "+", "around_at": None, "digits": None}
MARKS = {"around_at": r"@|[(\[]at[)\]]", "digits": "[0-9]", "ip": "[0-9][.][0-9]", "card": "[0-9][0-9 -]{12}"}
CONTEXT = 24
WORDS = r"(?i)(mail|contact|write|send|call|phone|tel|fax|mobile|card|visa|pay|account|number|ip|host|server|address)"
SAMPLE, PRECISION, TREES, DEPTH, FIT = 4000, 0.98, 16, 4, 0.7


def _spans(text: Column, name: str, pattern: str) -> Column:
    """Array of (start, end, value) of all matches, leftmost first and non-overlapping."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    step = F.aggregate(
        F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g")),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["g"]) + F.length(x["m"])).alias("at"),
            F.array_append(
                acc["out"],
                F.struct(
                    (acc["at"] + F.length(x["g"])).alias("start"),
                    (acc["at"] + F.length(x["g"]) + F.length(x["m"])).alias("end"),
                    x["m"].alias("value"),
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    here = text.contains(NEEDS[name]) if NEEDS[name] else text.rlike(MARKS[name])
    return F.when(here, step).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def add_base_spans(df: DataFrame, text: str) -> DataFrame:
    """Columns ``_email``, ``_ip``, ``_card``, ``_phone`` (arrays of start, end, value) for the string column ``text``."""
    df = df.withColumns({f"_{k}": _spans(F.col(text), k, p) for k, p in PATTERNS.items()})
    valid = lambda kind: lambda x: _valid(kind, x["value"])
    return df.withColumns({f"_{k}": F.filter(f"_{k}", valid(k)) for k in KINDS if k != "email"})


def _all_base() -> Column:
    named = lambda i: lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("kind"), x["end"].alias("end"))
    return F.array_sort(F.concat(*[F.transform(f"_{k}", named(i)) for i, k in enumerate(KINDS)]))


def _count(value: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{chars}]", "")).cast("double")


def _features(text: Column, x: Column) -> Column:
    """Form of the candidate, then of what stands around it."""
    v, start, end = x["value"], x["start"], x["end"]
    before = F.when(start > 0, F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT)))).otherwise("")
    after = F.substring(text, end + 1, F.lit(CONTEXT))
    yes = lambda c: c.cast("double")
    return F.array(
        F.length(v).cast("double"), _count(v, "0-9"), _count(v, "A-Za-z"), _count(v, "."), _count(v, r"\-"), _count(v, " "),
        _count(v, "()"), yes(v.startswith("+")), yes(v.contains("@")), F.size(F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))).cast("double"),
        F.coalesce(F.array_max(F.transform(F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0)), F.length)), F.lit(0)).cast("double"),
        yes(F.call_function("luhn_check", F.when(_digits(v) != "", _digits(v)).otherwise("1"))), yes(v.rlike(r"\.[A-Za-z]{2,}$")),
        yes(before.rlike(r"[A-Za-z0-9_]$")), yes(after.rlike(r"^[A-Za-z0-9_]")), yes(before.rlike(WORDS)), yes(after.rlike(WORDS)),
        _count(before, "0-9"), _count(after, "0-9"), yes(before.rlike(r"(^|\n)$")), yes(before.rlike(r"[=:]\s?\S{0,3}$")),
    )


def add_candidates(df: DataFrame, text: str) -> DataFrame:
    """Column ``_candidates``: start, end, value, generator number and features; needs the base spans' columns."""
    df = df.withColumns({f"_{g}": _spans(F.col(text), g, p) for g, p in GENERATORS.items()})
    named = lambda i: lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), F.lit(i).alias("generator"),
        _features(F.col(text), x).alias("f"),
    )
    parts = [F.transform(f"_{g}", named(i)) for i, g in enumerate(GENERATORS)]
    return df.withColumn("_base", _all_base()).withColumn("_candidates", F.concat(*parts)).drop(*[f"_{g}" for g in GENERATORS])


def _meets(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


@dataclass(frozen=True)
class Trees:
    """Fitted trees as nested tuples (feature, threshold, left, right) or leaf values, and a threshold per generator."""

    trees: tuple = ()
    weights: tuple = ()
    thresholds: dict = field(default_factory=dict)

    def margin(self, f: Column) -> Column:
        def walk(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            at, cut_, left, right = node
            return F.when(f[at] <= cut_, walk(left)).otherwise(walk(right))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights, strict=True):
            total = total + walk(tree) * F.lit(float(weight))
        return total


def _tuple(node) -> tuple | float:
    if node.numDescendants() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tuple(node.leftChild()), _tuple(node.rightChild())


def train_trees(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, precision: float = PRECISION,
                trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Trees fitted on the candidates of at most ``sample`` documents, thresholds from those of all others.

    The sample has the documents with the smallest key hashes: first of those with a positive candidate, up to half of
    it, then of those with negative ones alone; at most ``FIT`` of each. Rows without a key are never in it. Without
    both positive and negative candidates there are no trees and nothing is added to the base spans.
    """
    rows = only(docs, key, text).toDF("key", "text").withColumn("text", F.coalesce("text", F.lit("")))
    rows = add_candidates(add_base_spans(rows, "text"), "text").select("key", "_base", F.explode("_candidates").alias("c"))
    rows = cut(rows.select(
        "key", F.col("c.generator").alias("generator"), F.col("c.f").alias("f"),
        F.exists("_base", lambda b: _meets(F.col("c"), b)).cast("double").alias("label"),
    ))
    having = cut(rows.filter("key is not null").groupBy("key").agg(F.max("label").alias("yes")))
    size = {r["yes"]: math.ceil(r["n"] * FIT) for r in having.groupBy("yes").agg(F.count("*").alias("n")).collect()}
    some = min(size.get(1.0, 0), max(1, sample // 2))
    first = lambda yes, n: having.filter(F.col("yes") == yes).orderBy(F.xxhash64(F.col("key").cast("string")), "key").limit(n).select("key")
    chosen = cut(first(1.0, some).unionByName(first(0.0, min(size.get(0.0, 0), sample - some))))
    fit = rows.join(F.broadcast(chosen), "key").select(array_to_vector("f").alias("features"), "label").persist()
    try:
        if {r["label"] for r in fit.select("label").distinct().collect()} != {0.0, 1.0}:
            return Trees()
        model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7, maxBins=64, maxMemoryInMB=64).fit(fit.coalesce(1))
    finally:
        fit.unpersist()
    nodes = tuple(_tuple(t._call_java("rootNode")) for t in model.trees)
    plain = Trees(nodes, tuple(model.treeWeights))
    others = rows.join(F.broadcast(chosen), "key", "left_anti")
    scored = others.select("generator", "label", F.round(plain.margin(F.col("f")), 3).alias("margin"))
    bands = scored.groupBy("generator", "margin").agg(F.sum("label").alias("yes"), F.count("*").alias("n"))
    held = bands.orderBy("generator", F.desc("margin")).collect()
    thresholds, so_far = {}, {}
    for r in held:
        yes, n = so_far.get(r["generator"], (0, 0))
        so_far[r["generator"]] = yes, n = yes + r["yes"], n + r["n"]
        if yes >= precision * n:
            thresholds[r["generator"]] = r["margin"]
    return Trees(nodes, plain.weights, thresholds)


def add_spans(docs: DataFrame, trees: Trees, text: str = "text", name: str = "pii") -> DataFrame:
    """All rows and columns, with ``name``: an array of (start, kind, end, score), by start, kind and end.

    ``kind`` is the place in ``KINDS``; a base span's score is null. A null or blank text has no spans. Each row is
    treated alone, so repeated rows get equal spans; an existing column of that name is replaced; existing columns that
    begin like this function's own (``_email`` and so on) are kept. An empty table stays empty.
    """
    bare = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != name]).alias("row"), bare.alias("text"))
    df = add_base_spans(held, "text")
    if trees.thresholds:
        df = add_candidates(df, "text")
        free = F.filter("_candidates", lambda c: ~F.exists("_base", lambda b: _meets(c, b)))
        df = df.withColumn("_free", free)
        scored = F.transform("_free", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value"),
                                                         c["generator"].alias("generator"), trees.margin(c["f"]).alias("margin")))
        df = df.withColumn("_scored", scored)
        limit = F.lit(float("inf"))
        good = F.filter("_scored", lambda c: c["margin"] >= _threshold(trees, c["generator"], limit))
        df = df.withColumn("_good", good)
        better = lambda o, c: (o["margin"] > c["margin"]) | ((o["margin"] == c["margin"]) & (
            (o["start"] < c["start"]) | ((o["start"] == c["start"]) & (o["generator"] < c["generator"]))))
        best = F.filter("_good", lambda c: ~F.exists("_good", lambda o: _meets(c, o) & better(o, c)))
        added = F.transform(best, lambda c: F.struct(c["start"].alias("start"), _kind(c).alias("kind"), c["end"].alias("end"),
                                                     (1 / (1 + F.exp(-2 * c["margin"]))).alias("score")))
    else:
        df = df.withColumn("_base", _all_base())
        added = F.array().cast("array<struct<start:int,kind:int,end:int,score:double>>")
    plain = F.transform("_base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end"),
                                                    F.lit(None).cast("double").alias("score")))
    return df.withColumn(name, F.array_sort(F.concat(plain, added))).select("row.*", F.col(name))


def _threshold(trees: Trees, generator: Column, limit: Column) -> Column:
    out = limit
    for g, t in trees.thresholds.items():
        out = F.when(generator == g, F.lit(float(t))).otherwise(out)
    return out


def _kind(c: Column) -> Column:
    digits, parts = F.length(_digits(c["value"])), F.size(F.split(c["value"], r"\."))
    numeric = F.when((parts == 4) & (digits <= 12), 1).when(digits.between(13, 19) & ~c["value"].startswith("+"), 2).otherwise(3)
    return F.when(c["generator"] == 0, 0).otherwise(numeric)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])))


def redact(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """The same rows and columns with every span replaced by its kind in brackets; a null text stays null.

    Overlapping spans are replaced together, named after the first.
    """
    spans = "_pii_spans"
    df = add_spans(docs, trees, text, spans)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    body = F.col(f"`{text}`")
    done = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(body, acc["at"] + 1, s["start"] - acc["at"]), names[s["kind"]]).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))),
    )
    new = F.when(F.size(spans) > 0, done).otherwise(body)
    return df.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
