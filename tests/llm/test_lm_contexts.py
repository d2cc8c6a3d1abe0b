"""Scores of the suffix tree against a plain one by dictionaries, with frequent contexts split over several parts."""

import math
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.llm import lm_score
from gridcast.sources.tables import cut
from tests.llm.conftest import words

SCHEMA = "doc_id long, text string, learn boolean"


def plain(rows):
    """rows: (text, learnt from); for each the number of known tokens, the root's score and the tree's."""
    bodies = [([*words(t), None], bool(learn)) for t, learn in rows]
    count = [Counter(tuple(ws[i : i + k]) for ws, learn in bodies if learn for i in range(len(ws) - k + 1)) for k in range(1, 5)]
    n, v = sum(count[0].values()), len(count[0])
    root = lambda w: (count[0][(w,)] + 1) / (n + v + 1)
    prob, rest = {}, {}
    lower = lambda run: prob.get(run[1:], root(run[-1]))
    for k in range(1, 4):
        after = defaultdict(list)
        for run, c in count[k].items():
            if c >= 2:
                after[run[:-1]].append((run, c))
        for state, some in after.items():
            total = count[k - 1][state]
            own = {run: (c + lower(run)) / (total + 1) for run, c in some}
            left = max(1 - sum(own.values()), 1e-12) / max(1 - sum(lower(run) for run, _ in some), 1e-12)
            gain = sum(c * math.log(own[run] / lower(run)) for run, c in some) + (total - sum(c for _, c in some)) * math.log(left)
            keep = gain > 4 * (1 + len(some))
            prob |= own if keep else {run: lower(run) for run, _ in some}
            if keep:
                rest[state] = left
    listed = {run for run in prob if run[:-1] in rest}

    def score(ws, i):
        out = 0.0
        for k in range(min(3, i), 0, -1):
            state = tuple(ws[i - k : i])
            if state in rest:
                if (*state, ws[i]) in listed:
                    return out + math.log10(prob[(*state, ws[i])])
                out += math.log10(rest[state])
        return out + math.log10(root(ws[i]))

    return [(sum(count[0][(w,)] > 0 for w in ws), sum(math.log10(root(w)) for w in ws), sum(score(ws, i) for i in range(len(ws)))) for ws, _ in bodies]


@pytest.fixture(scope="module")
def chains():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        at, text = int(rng.integers(0, 30)), []
        for _ in range(int(rng.integers(0, 150))):
            at = (at * 7 + int(rng.integers(0, 4)) ** 2) % 30
            text += ["The", "of the"][at % 2 :][:1] * (rng.random() < 0.5) + [f"w{at}"] + ["end of the line now"] * (rng.random() < 0.1)
        rows.append((" ".join(text), bool(i % 5)))
    rows += [("x " * 400, True), ("x " * 300, False), ("x x y " * 50, True), ("", True), (None, False), ("once only", True), (rows[1][0], True), ("z " * 200, None)]
    return rows


@pytest.mark.parametrize("common, hot", [(1e-6, 50_000), (0.002, 50_000), (1e-6, 40), (0.002, 40), (1.0, 15), (1e-6, 0)])
def test_scores_equal_plain_tree(spark, chains, monkeypatch, common, hot):
    """Whether words are frequent or rare, and however many contexts are split over parts at one, two or three words."""
    monkeypatch.setattr(lm_score, "HOT_SHARE", common)
    monkeypatch.setattr(lm_score, "HOT_RUNS", max(hot, 5))
    monkeypatch.setattr(lm_score, "HOT_PARTS", 0)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(chains)], SCHEMA)
    got = {r.doc_id: r for r in lm_score.score_texts(docs.repartition(3, "doc_id"), F.col("learn")).collect()}
    assert len(got) == len(chains)
    for i, (known, base, score) in enumerate(plain(chains)):
        assert got[i].n_known == known and got[i].base_score == pytest.approx(base, rel=1e-9) and got[i].score == pytest.approx(score, rel=1e-9)


def test_an_exchange_holds_a_share_of_the_positions(spark, monkeypatch):
    """The files of each stored table's exchanges; before, one exchange had a hash for nearly every run."""
    folders = [Path(x) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{x}" for x in (rng.random(500) ** 2 * 2000).astype(int)), True) for i in range(400)]
    files, sizes = set(), []

    def kept(df):
        out = cut(df)
        new = {f for top in folders for f in top.rglob("shuffle_*.data")} - files
        files.update(new)
        sizes.append(sum(f.stat().st_size for f in new))
        return out

    monkeypatch.setattr(lm_score, "stored", kept)
    got = lm_score.score_texts(spark.createDataFrame(rows, SCHEMA), F.col("learn"))
    assert got.count() == 400 and 0 < max(sizes) < 0.9 * sum(len(t) for _, t, _ in rows)
