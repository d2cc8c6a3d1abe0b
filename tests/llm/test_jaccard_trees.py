"""The search of the n-gram join's trees against all pairs, and rows without a key or with a repeated one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.llm import shingle_join
from tests.llm.conftest import words


def shingles(text, size=5):
    w = words(text)
    return set(zip(*[w[i:] for i in range(size)], strict=False))


@pytest.fixture(scope="module")
def forest(spark):
    """Near and far variants of a few bodies, as points of one root with all and of many with some of them."""
    rng = np.random.default_rng(11)
    bodies = [[f"b{k}w{i}" for i in range(80 + 25 * k)] for k in range(4)]
    rows = []
    for i in range(90):
        body = list(bodies[i % 4])
        for at in rng.integers(0, len(body), int(rng.integers(0, 6))):
            body[at] = f"x{i}y{at}"
        rows.append((" ".join(body),))
    docs = spark.createDataFrame(sorted(set(rows)), "text string")
    named = shingle_join._named_texts(docs, 5).cache()
    table = shingle_join._own_texts(named, 5).cache()
    sets = {r.name: shingles(r.text) for r in named.collect()}
    names = sorted(sets)
    label = {name: names[i - i % 3] for i, name in enumerate(names)}
    roots = {1: names} | {r: [names[i] for i in rng.choice(len(names), 2 + r % 9, replace=False)] for r in range(-20, 20) if r != 1}
    points = spark.createDataFrame([(r, n, label[n]) for r, ns in roots.items() for n in ns], "root long, name long, label long")
    return table, points, sets, label


@pytest.mark.parametrize(("leaf", "fan"), [(64, 32), (2, 2), (3, 1), (1, 4)])
def test_trees_find_every_close_pair(forest, leaf, fan):
    """With leaves and branches of any size, no pair that is close enough is left out, and none is of one label."""
    table, points, sets, label = forest
    got = {(r.a, r.b) for r in shingle_join.search_trees(table, points, 80, leaf, fan).collect()}
    close = set()
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and label[a] != label[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                close.add((a, b))
    assert close <= got and len(close) > 50
    assert all(a < b and label[a] != label[b] for a, b in got)
    assert len(got) < 4 * len(close)


def test_vectors_keep_every_close_pair(spark, forest):
    table, _, sets, _ = forest
    pairs = spark.createDataFrame([(a, b) for a in sets for b in sets if a != b], "a long, b long")
    kept = {(r.a, r.b) for r in shingle_join.sift(table, pairs, 80).collect()}
    linked = {(r.a, r.b) for r in shingle_join.verify(table, pairs, 5, 80).collect()}
    both = {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a != b}
    assert linked == {(a, b) for (a, b), n in both.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)}
    assert linked <= kept and len(kept) < len(both)


def test_rows_without_keys_and_with_repeated_ones(spark):
    body = [f"w{i}" for i in range(60)]
    near = [*body[:59], "other"]
    far = [f"v{i}" for i in range(40)]
    lone = [f"u{i}" for i in range(40)]
    rows = [(None, body), (7, near), (5, body), (5, far), (9, far), (None, lone), (None, [*lone[:39], "end"]), (None, None), (None, lone)]
    docs = spark.createDataFrame([(k, t and " ".join(t), "x") for k, t in rows], "doc_id long, text string, component_id string")
    out = shingle_join.jaccard_components(docs)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str)
    want = [(None, 56, 5), (7, 56, 5), (5, 56, 5), (5, 36, 5), (9, 36, 5), (None, 36, None), (None, 36, None), (None, 0, None), (None, 36, None)]
    assert got == sorted(want, key=str)
    assert out.filter(F.col("doc_id").isNull()).count() == 5
