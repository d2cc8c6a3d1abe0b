"""Each operator against a plain version, on the smallest table with odd rows added, and on an empty table."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import words
from gridcast.llm import (
    chunk_dedup, decontaminate, lm_score, packing, pii, quality_crf, queries, robust_rules, secret_scan, shingle_join, suffix_dedup,
)
from gridcast.llm.text import flat, shingle_sets, span_hashes, word_spans
from gridcast.sources.tables import shared_folder


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


def test_words_and_shingles():
    bodies = ["a B  c\td", None, "", "x y z a b c", "é\x0bÜ"]
    data, offsets = flat(pa.array(bodies))
    starts, ends, before = word_spans(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == [w for t in bodies for w in words(t, False)]
    assert np.diff(before).tolist() == [4, 0, 0, 6, 2]
    hashes = span_hashes(data, starts, ends)
    assert hashes[0] == hashes[7] and hashes[1] == hashes[8]
    assert np.diff(shingle_sets(hashes, before, 5)[1]).tolist() == [1, 0, 0, 2, 1]


def test_lm_scoring(odd, nothing):
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    got = {r.doc_id: r for r in lm_score.score_texts(odd, train).collect()}
    bodies = {i: [*words(t), None] for i, t in texts(odd)}
    count = Counter(w for i, ws in bodies.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in bodies.items():
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9)
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())
    assert lm_score.score_texts(nothing, train).count() == 0


def test_tree_is_a_distribution():
    """After each context, the probabilities of all words and of the unknown one sum to 1."""
    rng = np.random.default_rng(3)
    ids = np.concatenate([np.tile([0, 1, 2, 3], 60), rng.integers(0, 6, 300)])
    table = np.sort(rng.integers(1, 1 << 60, 6).astype(np.uint64))
    counts = np.bincount(ids, minlength=6)
    n, S = len(ids), lm_score.S
    pairs, pair_n = np.unique(ids[:-1] * S + ids[1:], return_counts=True)
    pairs, pair_n = pairs[pair_n > 2], pair_n[pair_n > 2]
    at = lm_score._place(pairs, ids[:-1] * S + ids[1:])
    ok = (at[:-1] >= 0) & (at[1:] >= 0)
    triples, triple_n = np.unique(at[:-1][ok] * S + ids[2:][ok], return_counts=True)
    triples, triple_n = triples[triple_n > 2], triple_n[triple_n > 2]
    ok = (at[:-2] >= 0) & (at[1:-1] >= 0) & (at[2:] >= 0)
    quads, quad_n = np.unique(at[:-2][ok] * S + at[2:][ok], return_counts=True)
    quads, quad_n = quads[quad_n > 2], quad_n[quad_n > 2]
    tree = lm_score.grow(table, counts, n, 6, [pairs, triples, quads], [pair_n, triple_n, quad_n])
    assert tree.keep[0].any() and tree.keep[1].any()
    for context in ([], [0], [5, 1], [0, 1, 2], [3, 0, 1], [2, 2, 2]):
        stream = np.array([[*table[context], w] for w in [*table, np.uint64(7)]]).ravel()
        begin = np.arange(0, len(stream) + 1, len(context) + 1)
        logs, found = tree.scores(stream, begin)
        last = begin[1:] - 1
        logs = logs[last] + np.where(found[last] < 0, -math.log10(n + 7), 0)
        assert math.isclose((10.0**logs).sum(), 1, rel_tol=1e-6)


def test_lm_tables_score_like_the_tree(odd, monkeypatch):
    """The weights of runs add up to the scores of the plain tree, whether they're sent to the tasks or joined."""
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    bodies = {i: [*words(t), None] for i, t in texts(odd)}
    learnt = [ws for i, ws in bodies.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for ws in learnt for w in ws)
    n, v = sum(count.values()), len(count)
    number = {w: i for i, w in enumerate(w for w in count if count[w] > 1)}
    table, places = np.arange(len(number), dtype=np.uint64), [dict(zip([(w,) for w in number], range(len(number)), strict=True))]
    keys, sizes = [], []
    for k in (2, 3, 4):
        got = Counter(r for ws in learnt for r in zip(*[ws[j:] for j in range(k)], strict=False))
        got = {r: c for r, c in got.items() if c > 1}
        left = {r: places[1 if k == 4 else k - 2][r[:2] if k == 4 else r[:-1]] for r in got}
        right = {r: places[1][r[2:]] if k == 4 else number[r[-1]] for r in got}
        order = sorted(got, key=lambda r: (left[r], right[r]))
        places.append({r: i for i, r in enumerate(order)})
        keys.append(np.array([left[r] * lm_score.S + right[r] for r in order], np.int64))
        sizes.append(np.array([got[r] for r in order]))
    monkeypatch.setattr(lm_score, "END", np.uint64(number[None]))
    tree = lm_score.grow(table, np.array([count[w] for w in number]), n, v, keys, sizes)
    monkeypatch.undo()
    assert tree.keep[0].any() and tree.keep[1].any()
    want = {}
    for i, ws in bodies.items():
        logs, found = tree.scores(np.array([number.get(w, 1 << 40) for w in ws], np.uint64), np.array([0, len(ws)]))
        rare = [math.log10((count[w] + 1) / (n + v + 1)) for w, at in zip(ws, found, strict=True) if at < 0]
        want[i] = logs.sum() + sum(rare)
    for share in (lm_score.HOT_SHARE, 1.0):
        monkeypatch.setattr(lm_score, "HOT_SHARE", share)
        assert {r.doc_id: r.score for r in lm_score.score_texts(odd, train).collect()} == pytest.approx(want, rel=1e-7)


def test_lm_scoring_leaves_only_its_result_on_disk(spark, odd):
    """The tables behind the scores are deleted, and so are the files of the exchanges that made them."""
    folder = Path(re.sub("^file:/*", "/", shared_folder(spark))) / "gridcast"
    before = set(folder.glob("*"))
    scored = lm_score.score_texts(odd, F.lit(True))
    assert len(set(folder.glob("*")) - before) == 1
    assert scored.count() == odd.count() == scored.dropDuplicates(["doc_id"]).count()  # read twice
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_lm_run_keys_stay_inside_a_text():
    """Equal runs have equal keys wherever they are, and no run crosses two texts."""
    begin = np.array([0, 4, 5, 9])
    found = lm_score.mix(np.array([1, 2, 3, 9, 9, 2, 3, 1, 9], np.uint64))
    for k, (key, whole) in enumerate(lm_score.runs(found, begin, 4), 1):
        want = [i for a, b in zip(begin, begin[1:], strict=False) for i in range(a, b - k + 1)]
        assert np.flatnonzero(whole).tolist() == want
        of = {i: tuple(found[i : i + k]) for i in want}
        assert all((key[i] == key[j]) == (of[i] == of[j]) for i in want for j in want)
        if k > 1:
            assert all(key[i] == lm_score.run_key(last[i : i + 1], last[i + 1 : i + 2], k)[0] for i in want)
        last = key


def test_lm_contexts_do_not_depend_on_the_size(spark):
    """A passage that occurs three times is learnt from, however many other words there are."""
    passage = " ".join(f"word{i}" for i in range(40))
    rows = [(i, passage, True) for i in range(3)] + [(3, passage, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    filler = spark.range(10, 110).select(F.col("id").alias("doc_id"), F.expr("repeat('x ', 50000)").alias("text"), F.lit(True).alias("learn"))
    got = lm_score.score_texts(docs.unionByName(filler), F.col("learn")).filter("doc_id = 3").first()
    assert got.train_tokens > 4_000_000 and got.score > got.base_score / 5


def plain_components(bodies, size=5, percent=80):
    sets = {}
    for i, t in bodies:
        w = words(t)
        sets[i] = set(zip(*[w[j:] for j in range(size)], strict=False)) if len(w) >= size else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for n, i in enumerate(keys):
        for j in keys[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_jaccard_join(odd, nothing):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.jaccard_components(odd).collect()}
    assert got == plain_components(texts(odd))
    assert shingle_join.jaccard_components(nothing).count() == 0


def test_jaccard_join_of_chained_copies(spark):
    """Copies of a copy of a copy: neighbours are linked and the ends aren't; repeated rows change nothing."""
    rng = np.random.default_rng(5)
    body, rows = [f"w{i}" for i in range(60)], []
    for i in range(120):
        rows.append((i * 3, " ".join(body)))
        body = list(body)
        body[rng.integers(len(body))] = f"x{i}"
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.jaccard_components(docs).collect()}
    assert got == plain_components(rows)


def test_signatures_meet_for_every_close_pair():
    rng = np.random.default_rng(1)
    for n in (5, 9, 23, 60, 200):
        for _ in range(60):
            base = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            k = int(rng.integers(0, n // 4 + 1))
            a, b = np.unique(base[:n]), np.unique(base[k : n + int(rng.integers(0, 3))])
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both) or both == len(a) == len(b):
                continue
            keys, whose = shingle_join.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 80)
            assert set(keys[whose == 0].tolist()) & set(keys[whose == 1].tolist())


def test_repeated_strings(odd, nothing):
    got = {r.doc_id: r for r in suffix_dedup.drop_repeated_strings(odd).collect()}
    seen = set()
    for i, t in sorted(texts(odd)):
        raw = t.encode()
        gone, own = bytearray(len(raw)), set()
        for p in range(len(raw) - 49):
            own.add(raw[p : p + 50])
            if raw[p : p + 50] in seen:
                gone[p : p + 50] = b"\1" * 50
        seen |= own
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        assert [(s.start, s.end) for s in got[i].spans] == spans and got[i].n_bytes == len(raw)
        assert bytes(got[i].kept) == bytes(x for x, g in zip(raw, gone, strict=True) if not g)
    assert suffix_dedup.drop_repeated_strings(nothing).count() == 0


def test_packing(odd, nothing):
    from tokenizers import Tokenizer

    rows = packing.pack(odd, queries.TOKENIZER).collect()
    tokenizer, own, places = Tokenizer.from_file(queries.TOKENIZER), defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    for i, t in texts(odd):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want = [(p, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for p, a in enumerate(range(0, len(ids), 2048))]
        assert sorted(own[i]) == want
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.02 * sum(r.length for r in rows) / 2048 + 1
    assert packing.pack(nothing, queries.TOKENIZER).count() == 0


def test_local_search_empties_bins():
    lengths = [6, 6, 3, 3, 2, 4, 5, 5, 7, 1]
    bins = packing.improve([[i] for i in range(len(lengths))], lengths, 10)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert max(sum(lengths[i] for i in b) for b in bins) <= 10 and len(bins) <= 5


def test_quality(spark, tables, odd, nothing):
    labels = queries.training_labels(tables("labels"))
    field = quality_crf.train_quality(odd, labels)
    scored = quality_crf.add_quality(odd, field).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored) and scored[0]._email == "x"
    truth = {r.doc_id: r.quality for r in tables("labels").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([(r.score >= 0.7) == truth[r.doc_id] for r in scored if r.doc_id in truth]) > 0.9
    assert quality_crf.add_quality(nothing, field).count() == 0
    blank = quality_crf.train_quality(nothing, labels)
    assert [r.score for r in quality_crf.add_quality(odd.limit(2), blank).collect()] == [0.5, 0.5]


def test_marginals_by_enumeration():
    rng = np.random.default_rng(2)
    emit, turn, before = rng.normal(size=6), rng.normal(size=(2, 2)), np.array([0, 4, 5, 6])
    good, _, log_z = quality_crf.marginals(emit, turn, before)
    total, yes = 0.0, np.zeros(4)
    for code in range(16):
        y = [code >> i & 1 for i in range(4)]
        weight = math.exp(sum(emit[i] * y[i] for i in range(4)) + sum(turn[y[i - 1], y[i]] for i in range(1, 4)))
        total += weight
        yes += weight * np.array(y)
    assert np.allclose(good[:4], yes / total) and math.isclose(log_z[0], math.log(total))


def test_quality_rules(odd, nothing):
    got = {r.doc_id: r for r in robust_rules.quality_rules(odd).collect()}
    assert len(got) == odd.count()
    for i, t in texts(odd):
        w = words(t, False)
        count, twice, lines, repeats = Counter(zip(w, w[1:], w[2:], strict=False)), set(), set(), 0
        for j in range(len(w) - 2):
            twice |= {j, j + 1, j + 2} if count[tuple(w[j : j + 3])] > 1 else set()
        for line in t.split("\n"):
            if words(line):
                repeats += line in lines
                lines.add(line)
        r, failed = got[i], len(w) < 50 or 100 * len(twice) > 50 * len(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), repeats, len(twice), failed)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert r.kept == (not failed and r.distance <= robust_rules.LIMIT)
    assert robust_rules.quality_rules(nothing).count() == 0


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def test_secrets(odd, nothing):
    got = {r.doc_id: r.secrets for r in secret_scan.find_secrets(odd).collect()}
    for i, t in texts(odd):
        want = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        assert [tuple(s) for s in got[i] if s.kind < 3] == sorted(want)
    assert len(got[1008]) == 3
    assert secret_scan.find_secrets(nothing).count() == 0


def test_entropy_windows_by_recount(spark):
    run = "aaaaaaaaaaaaaaaaaaaaaaaaaZ3kQ9xPm7Lw2Vt8Rb5YaaaaaaaaaaaaaaaaaaaaaaaX"

    def entropy(s):
        return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())

    want = set()
    for i in range(len(run) - 19):
        if entropy(run[i : i + 20]) >= 3.7 - 1e-9:
            want |= set(range(i, i + 20))
    got = {x for a, b in secret_scan.high_entropy(run, 20, 3.7) for x in range(a, b)}
    assert got == want and got
    texts_ = ["key Z3kQ9xPm7Lw2Vt8Rb5YcD here", "id 123e4567-e89b-12d3-a456-426614174000 x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts_)], "doc_id long, text string")
    assert [[tuple(s) for s in r.secrets] for r in secret_scan.find_secrets(rows).orderBy("doc_id").collect()] == [[(4, 3, 25)], []]


def test_secrets_of_one_letter_case(spark):
    """Letters of one case with digits are secrets as well, and a base span takes only its own part of a longer key."""
    low, up = "k7w2m9qx4t8zr5vb1nc6yh3pjd0gsf", "K7W2M4QX5TZR6VBNC3YHPJDGSFLEAU"
    mixed = "Zk3Qx9PmLw7Vt2Rb8YhN" + "0123456789abcdef" + "Hs5Gq8WnTj4Uz1XeRv6K"
    rows = spark.createDataFrame([(0, f"a {low} b"), (1, f"a {up} b"), (2, mixed), (3, "abcdefghijklmnopqrstuvwxyz")], "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.secrets] for r in secret_scan.find_secrets(rows).collect()}
    assert got[0] == [(2, 3, 2 + len(low))] and got[1] == [(2, 3, 2 + len(up))] and got[3] == []
    assert [s for s in got[2] if s[1] == 2] == [(20, 2, 36)] and got[2][0][:2] == (0, 3) and got[2][-1][1:] == (3, 56)
    assert all(a[2] <= b[0] for a, b in zip(got[2], got[2][1:], strict=False))


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_pii(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        out += [(m.start(), 1, m.end())] if all(int(x) <= 255 for x in m[0].split(".")) else []
    for kind, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            out += [(m.start(), kind, m.end())] if (kind == 2 and 14 <= len(d) <= 19 and luhn(d)) or (kind == 3 and 10 <= len(d) <= 15) else []
    return sorted(out)


def test_pii(spark, odd, nothing):
    more = ["a@b.c_d@e.f..g@h.i", "1.2.3.4.5.6.7.8 01.002.0003.255", "4111 1111 1111 1111 4111-1111-1111-1112", "+1.+12345678901 x +44 (0) 20 7946 0958)"]
    docs = odd.select("doc_id", "text", "_email").unionByName(spark.createDataFrame([(2000 + i, t, "y") for i, t in enumerate(more)], "doc_id long, text string, _email string"))
    trees = pii.train_trees(docs, sample=500)
    assert trees.trees
    got = {r.doc_id: r for r in pii.add_spans(docs, trees).collect()}
    for i, t in texts(docs):
        assert [(s.start, s.kind, s.end) for s in got[i].pii if s.score is None] == plain_pii(t), t[:80]
    assert got[0]._email == "x"
    clean = {r.doc_id: r.text for r in pii.redact(docs, pii.Trees()).collect()}
    assert clean[2000] == "[EMAIL]" * 3 and clean[1000] is None
    assert pii.add_spans(nothing, trees).count() == 0 and pii.train_trees(nothing) == pii.Trees()


def test_pii_is_learnt_at_any_rarity(spark):
    """A few e-mail addresses among many documents, more than the sample holds, still give trees and a threshold."""
    rows = [(i, f"call john{i} @ home or see item {i * 7919 % 100000} {i % 97} {i % 89}") for i in range(1200)]
    rows += [(5000 + i, f"write mail to user{i}.name@host{i}.example.org today") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trees = pii.train_trees(docs, sample=20)
    assert trees.trees and 0 in trees.thresholds
    # The threshold holds for all documents that weren't learnt from: no candidate without an address passes it.
    extra = spark.createDataFrame([(0, "write mail to user77.name (at) host77 (dot) example (dot) org today")], "doc_id long, text string")
    assert pii.add_spans(docs.unionByName(extra), trees).filter("doc_id < 1200").selectExpr("sum(size(filter(pii, x -> x.score is not null)))").first()[0] <= 24


def test_chunks(odd, nothing):
    got = {r.doc_id: r for r in chunk_dedup.drop_repeated_chunks(odd).collect()}
    seen = set()
    for i, t in sorted(texts(odd)):
        raw, kept = t.encode(), b""
        for a, b in zip(*chunk_dedup.chunk_ends(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])), strict=True):
            if b - a < chunk_dedup.MIN_BYTES or raw[a:b] not in seen:
                kept += raw[a:b]
            seen.add(raw[a:b])
        assert got[i].text.encode() == kept and got[i].n_bytes == len(raw)
        assert sum(s.end - s.start for s in got[i].spans) == len(raw) - len(kept)
    assert chunk_dedup.drop_repeated_chunks(nothing).count() == 0


def test_chunks_resist_insertions():
    rng = np.random.default_rng(4)
    body = bytes(rng.integers(97, 123, 8000).astype(np.uint8))
    cut = lambda raw: {raw[a:b] for a, b in zip(*chunk_dedup.chunk_ends(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])), strict=True)}
    before, after = cut(body), cut(body[:4000] + b"inserted" + body[4000:])
    assert len(before - after) <= 8 and hashlib.sha256(b"".join(sorted(before))).digest()


def test_benchmark(spark, tables, odd, nothing):
    items = tables("benchmark").unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "zz yy xx")], "item_id long, text string"))
    bench = {r.item_id: words(r.text) for r in items.collect()}
    owners = defaultdict(set)
    grams = {i: Counter(zip(*[w[j:] for j in range(min(5, len(w)))], strict=False)) for i, w in bench.items() if w}
    for i, g in grams.items():
        for s in g:
            owners[s].add(i)
    extra = [(3000, "intro zz yy xx outro"), (3001, " ".join(bench[0][:-1] + ["changed", "and", "more"]))]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    want = {}
    for i, t in texts(docs):
        w = words(t)
        for item, g in grams.items():
            k, m = min(5, len(bench[item])), len(bench[item])
            shingles = list(zip(*[w[j:] for j in range(k)], strict=False))
            for p in range(len(w) - m + 1) if any(s in g for s in shingles) else ():
                c, both, all_ = Counter(shingles[p : p + m - k + 1]), 0.0, 0.0
                for s in c.keys() | g.keys():
                    both += min(c[s], g[s]) / max(1, len(owners.get(s, ())))
                    all_ += max(c[s], g[s]) / max(1, len(owners.get(s, ())))
                if both / all_ >= 0.8 - 1e-11:
                    want[i, item] = max(want.get((i, item), 0), both / all_)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_benchmark(docs, items).collect()}
    assert got == pytest.approx(want) and (3000, 902) in got and (3001, 0) in got
    clean = {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()}
    assert clean == {i for i, _ in texts(docs)} - {i for i, _ in want}
    assert decontaminate.find_benchmark(nothing, items).count() == 0


def test_benchmark_in_shares(spark, tables, odd, monkeypatch):
    """Shingles are weighed over the whole benchmark, so a smaller share size changes nothing."""
    common = "the answer to this question is one of these four choices"
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(12)) + " " + common) for i in range(30)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    bodies = [(i, t.replace(f"w{i}x0 ", "other ").replace(f"w{i}x1 ", "words ").replace(common, f"{common[:30]} changed here")) for i, t in rows]
    bodies += [(100 + i, t) for i, t in rows] + [(200 + i, rows[i][1].replace(f"w{i}x11", rows[i + 1][1][-57:])) for i in range(29)]
    docs = spark.createDataFrame(bodies, "doc_id long, text string")
    found = lambda: {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_benchmark(docs, items, percent=20).collect()}
    whole = found()
    assert len(whole) >= 50
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 1200)
    assert found() == pytest.approx(whole)


def test_benchmark_in_shorter_documents(spark):
    """An item without its last words, alone in a document, is compared as a whole."""
    bench = [f"q{i}" for i in range(40)]
    items = spark.createDataFrame([(1, " ".join(bench)), (2, "zz yy xx")], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(bench[:-2])), (2, " ".join(bench[:20])), (3, "zz yy")], "doc_id long, text string")
    got = [tuple(r) for r in decontaminate.find_benchmark(docs, items).collect()]
    assert [(r[0], r[1], r[3], r[4]) for r in got] == [(1, 1, 0, 38)] and got[0][2] == pytest.approx(34 / 36)
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()} == {2, 3}


def test_pipeline_against_plain_stages(spark, tables):
    from tests.llm.conftest import SF

    stages, docs = dict(corpus_pipeline.STAGES), tables("documents")
    kept = stages["quality classifier"](spark, docs, SF)
    bad = {r.doc_id for r in queries.op5_quality_classifier(spark, SF).collect() if not r.predicted}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in texts(docs)} - bad
    single = stages["n-gram Jaccard join"](spark, kept, SF)
    assert {r.doc_id for r in single.collect()} == {i for i, (_, c) in plain_components(texts(kept)).items() if i == c}
    clean = stages["benchmark decontamination"](spark, single, SF)
    found = {r.doc_id for r in queries.op10_benchmark_decontamination(spark, SF).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - found
    safe = stages["PII"](spark, clean, SF)
    assert safe.columns == docs.columns and safe.count() == clean.count()
    assert not any(plain_pii(r.text or "") for r in safe.collect())
    final = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in final.select("doc_id").distinct().collect()} == {r.doc_id for r in safe.collect()}
    assert set(queries.QUERIES) >= {"pipeline"} and len(queries.QUERIES) == 14
