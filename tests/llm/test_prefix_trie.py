"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from gridcast.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, ids long, digest string, spine double"


def turns_of(rows):
    """conv_id -> its (role, text) turns: null turns first, equal turns by the digest of role and text."""
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            out[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: [t for _, t in sorted(ts)] for c, ts in out.items()}


def plain_nodes(convs):
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) + (not kids[p])
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p)).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p], ends(p)) for p, m in members.items()
    )


def nodes(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*names).collect())


@pytest.fixture(scope="module")
def odd_turns():
    """Shared openings, copies, a conversation that is the start of another, null turns, ties, repeated rows, odd texts."""
    rng = random.Random(5)
    rows = []
    for c in range(120):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "bot", None]), rng.choice(["hi", "", None, "é" * 9, "𝒳y"])))
    rows += [(200, t, "user", f"only {t}") for t in range(300)] + [(201, t, "user", f"only {t}") for t in range(150)]
    rows += [(i, t, "system", "same start") for i in range(300, 340) for t in range(3)]
    rows += [(400, None, "user", "first"), (400, 0, "user", "b"), (400, 0, "user", "a"), (400, 0, "user", "a"), (400, None, None, None)]
    rows += [(None, 0, "user", "nobody"), (-7, 0, "user", "hi"), (-7, 1, "bot", "x" * 50_000)]
    rows += [(c, 0, "user", "alone") for c in range(9001, 9011)]  # no conversation 9000
    rng.shuffle(rows)
    return [(*r, 1, "d", 0.5) for r in rows]


@pytest.mark.parametrize("shard_turns", [7, 150, 200_000])
def test_trie_equals_plain_prefixes(spark, odd_turns, shard_turns):
    encoded = prefix_trie.encode_turns(spark.createDataFrame(odd_turns, SCHEMA))
    assert nodes(prefix_trie.prefix_trie(encoded, shard_turns)) == plain_nodes(turns_of(odd_turns))


def test_rebuilt_conversations(spark, odd_turns):
    """The query's splice: heads of the hundred's first conversation, also where it's missing or all turns go."""
    convs = turns_of(odd_turns)
    want = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        want[c] = convs.get(base, [])[:h] + ts[h:]
    assert any(not ts for ts in want.values())
    encoded = queries.rebuilt(prefix_trie.encode_turns(spark.createDataFrame(odd_turns, SCHEMA)))
    assert nodes(prefix_trie.prefix_trie(encoded, 40)) == plain_nodes(want)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(prefix_trie.encode_turns(spark.createDataFrame([], SCHEMA))).count() == 0
    one = spark.createDataFrame([(3, None, None, None)], "conv_id long, turn long, role string, text string")
    assert [r[:7] for r in nodes(prefix_trie.prefix_trie(prefix_trie.encode_turns(one)))] == [(3, 0, -1, 1, 1, 1, 0), (3, 1, 3, 1, 0, 1, 0)]


def test_tree_is_balanced_by_medians():
    """1,023 sequences of one turn inserted in median order give a tree of ten levels."""
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.median_order(1023):
        tree.insert(prefix_trie.np.array([i]), prefix_trie.np.array([1]), 1, i, "x")
    deep, at = 0, [(tree.inside[0], 1)]
    while at:
        x, d = at.pop()
        if x >= 0:
            deep = max(deep, d)
            at += [(tree.low[x], d + 1), (tree.high[x], d + 1)]
    assert deep == 10 and sorted(tree.symbol[x] for x in tree.walk()) == list(range(-1, 1023))


def test_query_equals_sql(spark):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
    from check_oracles import compare, connect

    sf = "/root/testdata/sf0.001"
    for name, sql in queries.SQL.items():
        problem = compare(queries.QUERIES[name](spark, sf).toPandas(), connect(sf).sql(sql).df())
        assert not problem, (name, problem)
