"""Recall of benchmark matches against brute force where weights, repeats and the threshold matter."""

import random
from collections import Counter, defaultdict

import pytest

from gridcast.llm import decontaminate
from tests.llm.conftest import words


def shingles_of(text, size=5):
    w = words(text)
    k = min(size, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def plain(docs, items, percent):
    """(doc, item) -> best similarity over all windows of the item's length."""
    grams = {i: shingles_of(t) for i, t in items}
    owners = defaultdict(set)
    for i, g in grams.items():
        for s in g:
            owners[s].add(i)
    out = {}
    for d, text in docs:
        w = words(text)
        for i, t in items:
            m = min(len(words(t)), len(w))
            for p in range(len(w) - m + 1):
                g = shingles_of(" ".join(w[p : p + m]))
                both = sum(min(g[s], grams[i][s]) / max(1, len(owners[s])) for s in g.keys() & grams[i].keys())
                all_ = sum(max(g[s], grams[i][s]) / max(1, len(owners[s])) for s in g.keys() | grams[i].keys())
                if all_ and 100 * both / all_ >= percent - 1e-9:
                    out[d, i] = max(out.get((d, i), 0), both / all_)
    return out


def found(spark, docs, items, percent, kind="long"):
    d, i = spark.createDataFrame(docs, f"doc_id {kind}, text string"), spark.createDataFrame(items, f"item_id {kind}, text string")
    return {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_benchmark(d, i, percent=percent).collect()}


def test_shared_boilerplate(spark):
    """400 items of own words and one of two long boilerplates; documents have an item's own words and the other boilerplate."""
    plates = [" ".join(f"{x}{j}" for j in range(150)) for x in ("alpha", "beta")]
    own = [" ".join(f"own{i}x{j}" for j in range(60)) for i in range(400)]
    items = [(i, f"{own[i]} {plates[i % 2]}") for i in range(400)]
    docs = [(i, f"{own[i]} {plates[1 - i % 2]}") for i in range(20)] + [(100, plates[0]), (101, plates[1])]
    want = plain(docs, [x for x in items if x[0] < 20], 80)  # weights over 20 items; the full benchmark weighs the plates less
    got = found(spark, docs, items, 80)
    assert {k for k in got} == {(i, i) for i in range(20)} and all(v > 0.8 for v in got.values()) and set(want) <= set(got)


@pytest.mark.parametrize("percent", [40, 60, 80, 95])
def test_all_thresholds(spark, percent):
    """Items changed by degrees, with repeated shingles and shared parts: what brute force finds is found."""
    rng = random.Random(percent)
    vocabulary = [f"v{i}" for i in range(500)]
    common = " ".join(rng.choices(vocabulary, k=15))
    items = []
    for i in range(40):
        body = rng.choices(vocabulary, k=30)
        body += (["again and again and"] * rng.randrange(0, 6)) if i % 3 == 0 else []
        items.append((i, " ".join(body) + (f" {common}" if i % 2 else "")))
    docs = []
    for n in range(120):
        i, text = items[n % 40]
        w = text.split()
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        docs.append((n, " ".join(rng.choices(vocabulary, k=20) + w + rng.choices(vocabulary, k=10))))
    want = plain(docs, items, percent)
    assert len(want) >= 20
    assert found(spark, docs, items, percent) == pytest.approx(want)


def test_radius_follows_the_threshold():
    assert decontaminate.radius(80) == 40 and decontaminate.radius(100) == 0 and decontaminate.radius(60) > 50 and decontaminate.radius(0) <= 128


def test_keys_of_other_types(spark):
    items = [(1, " ".join(f"q{i}" for i in range(30))), (1, "zz yy xx"), (None, "aa bb cc")]
    docs = [(7, items[0][1]), (7, items[0][1] + " more"), (None, f"zz {items[1][1]}"), (8, None)]
    assert found(spark, docs, items, 80, "int") == {(7, 1): 1.0, (None, 1): 1.0}
    text = [(None if k is None else str(k), t) for k, t in items]
    assert found(spark, [(None if k is None else str(k), t) for k, t in docs], text, 80, "string") == {("7", "1"): 1.0, (None, "1"): 1.0}
