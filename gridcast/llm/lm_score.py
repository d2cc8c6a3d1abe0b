"""Language-model scores from a probabilistic suffix tree over words.

Symbols are lower-cased words and an end mark for each text. The root is the word distribution of the training texts
with one added to each count and to that of the unknown word. A context of up to three words is a candidate if the
training texts have it ``LEAST`` times or more, as are its next words; the same count holds at every size, so the tree
grows with the corpus. A candidate is kept if its next words diverge enough from those of its longest kept suffix: the
gain in log likelihood must exceed ``GAIN`` for each of its parameters.

A state's probabilities are its counts smoothed by those of its parent, ``WEIGHT`` of them; what its listed words leave
goes to all other words in proportion to the parent. Each word is scored by the longest kept suffix of what precedes it.

A position is a word with the three words before it. All positions after the same last word meet in one part, so that the
states that end with that word, and all their next words, are counted, grown and scored there at once; the root's
probability of a rare last word is found before, where all its occurrences meet. Only sums for each text leave a part. The
parts are gone through in ``ROUNDS``, so the exchange on disk holds a share of the positions at a time; each reads the words
from a stored table of their numbers. A word after which there are more positions than a part should hold is split by the word before it, and so
on; the states that several parts share are counted first, and their table is sent to those parts. Frequent words, at
least ``HOT_SHARE`` of all, are sent as numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.text import BASE, batch_of, blocks, bounded_batches, flat, mix, span_hashes, word_spans
from gridcast.sources.tables import cut, release

LEAST, HOT_SHARE, GAIN, WEIGHT = 2, 1e-6, 4.0, 1.0
HELD = 2_000_000
ROUNDS, GROUPS = 3, 2  # in which positions are exchanged, and the parts of each for a shuffle partition
HOT_RUNS, HOT_PARTS = 50_000, 3  # a context that occurs more often than both, the latter in mean parts, is spread over parts
END = np.uint64(0x1D8E4E27C47D124F)
S = 1 << 24  # more than the words, and than the entries of any level, of a ``Tree``


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words followed by the end mark, and where each text begins."""
    data, offsets = flat(batch.column("text"))
    starts, ends, before = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    n = len(before) - 1
    out = np.full(len(words) + n, END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(before))] = words
    return out, before + np.arange(n + 1)


def run_key(state: np.ndarray, suffix: np.ndarray, k: int) -> np.ndarray:
    """Hash of a run of ``k`` tokens from those of the run without its last token and of the run without its first."""
    return mix(state * BASE + suffix + np.uint64(k))


def runs(found: np.ndarray, begin: np.ndarray, longest: int) -> list:
    """For each length up to ``longest``, the hash of the run of tokens from each place, and whether it ends in its text."""
    inside = np.ones(len(found), bool)
    out = [(found, inside.copy())]
    inside[begin[1:] - 1] = False  # each text has a token, its end mark
    for k in range(2, longest + 1):
        part, fits = out[-1]
        key, whole = np.zeros(len(found), np.uint64), inside & fits
        whole[:-1] &= fits[1:]
        at = np.flatnonzero(whole)
        key[at] = run_key(part[at], part[at + 1], k)
        out.append((key, whole))
    return out


def count_keys(docs: DataFrame, keys: Callable, parts: int, size: int = 1) -> DataFrame:
    """(key, n, n_train) summed over all texts, and of runs of ``size`` tokens also state and suffix.

    ``keys`` gives a block's keys, for each whether it's of a training text, and state and suffix. Counts are summed in each
    task before they're sent, packed in one row for each part of the keys, so a very common key costs one entry for each
    ``HELD`` entries of a task. The key of a longer run isn't sent, as state and suffix give it.
    """
    more = ["state", "suffix"] if size > 1 else []
    names = ["n", "n_train", *(more or ["keys"])]
    schema = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in names)])

    def merged(held: list) -> list:
        key, n, train, *rest = (np.concatenate(c) for c in zip(*held, strict=True))
        key, order, first = sorted_keys(key)
        return [(key, *(np.add.reduceat(x[order], first).astype(np.int64) for x in (n, train)), *(x[order[first]] for x in rest))]

    def send(held: list) -> pa.RecordBatch:
        key, *rest = merged(held)[0]
        part = part_of(mix(key), parts)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        some = np.flatnonzero(np.diff(edges))
        sent = rest if more else (*rest, key)
        cols = [[x[order[edges[p] : edges[p + 1]]].tobytes() for p in some] for x in sent]
        return batch_of(schema, some, *cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for b in blocks(batches):
            key, train, *rest = keys(b)
            if not len(key):
                continue
            held += merged([(key, np.ones(len(key), np.int64), train, *rest)])
            if sum(len(x[0]) for x in held) > HELD:
                held = merged(held)
                if len(held[0][0]) > HELD // 2:
                    yield send(held)
                    held = []
        if held:
            yield send(held)

    def add(group: pa.Table) -> pa.Table:
        n, train, *rest = (np.frombuffer(b"".join(group.column(c).to_pylist()), np.int64) for c in names)
        rest = [x.view(np.uint64) for x in rest]
        read = (run_key(*rest, size), n, train, *rest) if more else (*rest, n, train)
        return pa.table(dict(zip(out, (x.view(np.int64) for x in merged([read])[0]), strict=True)))

    out = ["key", "n", "n_train", *more]
    packed = docs.select("text", "train").mapInArrow(run, "part int, " + ", ".join(f"{c} binary" for c in names))
    return packed.groupBy("part").applyInArrow(add, ", ".join(f"{c} long" for c in out))


def stored(df: DataFrame) -> DataFrame:
    """The same as `cut`; the files of the exchanges behind the table are deleted as soon as it's written."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return cut(df)
    finally:
        if before is None:
            conf.unset(name)
        else:
            conf.set(name, before)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that a key is in: equal shares of all values, in their order."""
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)


def sorted_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys in order, the places of all keys in that order, and where each different key begins there."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1) if len(keys) else np.zeros(0, np.int64)
    return keys[first], order, first


def _place(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in the sorted table, -1 where it isn't."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


@dataclass
class Tree:
    """The suffix tree of counts that fit one process, the plain form of what ``tree_weights`` makes as tables.

    Sorted keys of frequent words, pairs, triples and quadruples, and what the kept states say about them.

    ``keep[k]`` and ``rest[k]`` are by the state's place in level k: whether it's kept, and the log10 factor for words it
    doesn't list. ``log[k]`` is the log10 probability of each entry of level k + 1 after the state of its first words.
    """

    words: np.ndarray
    root: np.ndarray
    unknown: float
    keys: list
    keep: list
    rest: list
    log: list

    def ids(self, tokens: np.ndarray) -> np.ndarray:
        return _place(self.words, tokens)

    def places(self, ids: np.ndarray, begin: np.ndarray, depth: int) -> list:
        """For each token, the place of the word, pair, triple and quadruple that it ends; -1 where there's none."""
        n, out = len(ids), [ids]
        where = np.arange(n) - np.repeat(begin[:-1], np.diff(begin))  # words before the token in its text
        back = lambda x, k: np.concatenate([np.full(min(k, n), -1), x[: max(0, n - k)]])
        for k in range(2, depth + 1):
            left = back(out[1] if k == 4 else out[k - 2], 2 if k == 4 else 1)
            right = out[1] if k == 4 else ids
            ok = (where >= k - 1) & (left >= 0) & (right >= 0)
            at = np.full(n, -1)
            at[ok] = _place(self.keys[k - 2], left[ok] * S + right[ok])
            out.append(at)
        return out

    def scores(self, tokens: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each token; for a word that isn't frequent, without the root's part. And the words' ids."""
        ids = self.ids(tokens)
        at = self.places(ids, begin, 4)
        where = np.arange(len(ids)) - np.repeat(begin[:-1], np.diff(begin))
        total, open_ = np.zeros(len(ids)), np.ones(len(ids), bool)
        for k in (3, 2, 1):
            state = np.concatenate([[-1], at[k - 1][:-1]]) if len(ids) else at[k - 1]
            state = np.where(where >= k, state, -1)
            here = open_ & (state >= 0)
            here[here] = self.keep[k - 1][state[here]]
            listed = here & (at[k] >= 0)
            total[listed] += self.log[k - 1][at[k][listed]]
            other = here & ~listed
            total[other] += self.rest[k - 1][state[other]]
            open_ &= ~listed
        known = open_ & (ids >= 0)
        total[known] += self.root[ids[known]]
        return total, ids


def grow(words: np.ndarray, counts: np.ndarray, n: int, v: int, keys: list, sizes: list) -> Tree:
    """The tree from counts of frequent words, pairs, triples and quadruples."""
    p0 = (counts + 1) / (n + v + 1)
    ends = _place(words, np.array([END]))[0]
    pair1, pair2 = keys[0] // S, keys[0] % S
    triple_pair, triple3 = keys[1] // S, keys[1] % S
    # An entry's suffix leaves out its first word: of pair (a, b), the word b; of triple (a, b, c), the pair (b, c).
    quad_first, quad_last = keys[2] // S, keys[2] % S
    quad_state = _place(keys[1], quad_first * S + pair1[quad_last])
    quad_suffix = _place(keys[1], _place(keys[0], pair2[quad_first] * S + pair1[quad_last]) * S + pair2[quad_last])
    count = [counts.astype(float), *(s.astype(float) for s in sizes)]
    state_of = [pair1, triple_pair, quad_state]
    suffix_entry = [pair2, _place(keys[0], pair2[triple_pair] * S + triple3), quad_suffix]
    tree = Tree(words, np.log10(p0), -np.log10(n + v + 1), keys, [], [], [])
    prob = [p0]  # of each entry of level k after its first words, by the longest kept state
    for k in range(3):
        states, entries = len(count[k]), len(count[k + 1])
        state = state_of[k]
        lower = prob[k][suffix_entry[k]] if entries else np.zeros(0)
        total = count[k]
        p = (count[k + 1] + WEIGHT * lower) / (total[state] + WEIGHT) if entries else lower
        mass, under = np.bincount(state, p, states), np.bincount(state, lower, states)
        listed = np.bincount(state, count[k + 1], states)
        rest = np.maximum(1 - mass, 1e-12) / np.maximum(1 - under, 1e-12)
        gain = np.bincount(state, count[k + 1] * np.log(p / lower), states) + np.maximum(total - listed, 0) * np.log(rest)
        keep = (gain > GAIN * (1 + np.bincount(state, minlength=states))) & (np.bincount(state, minlength=states) > 0)
        if k == 0 and ends >= 0:
            keep[ends] = False
        # A state that isn't kept says what its suffix says.
        prob.append(np.where(keep[state], p, lower) if entries else p)
        tree.keep.append(keep)
        tree.rest.append(np.log10(rest))
        tree.log.append(np.log10(np.maximum(p, 1e-300)))
    return tree


def tree_weights(lower: DataFrame, level: DataFrame, above: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One level of the tree over few contexts, stored: (key, state, suffix, n, n_train, p, w) of its runs and (state, rest) of
    the kept states.

    ``lower`` has key and p (probability of the last word) of the runs shorter by one, ``level`` key, n, n_train, and the
    keys state (without the last word) and suffix (without the first), ``above`` each state's count, ``total``. States are
    few and each may have very many runs, so only the few rows are sent to all tasks.
    """
    c = F.col("n_train")
    under = lower.select(F.col("key").alias("suffix"), F.col("p").alias("lower"))
    rows = level.join(under, "suffix").join(F.broadcast(above), "state")
    rows = rows.withColumn("own", (c + WEIGHT * F.col("lower")) / (F.col("total") + WEIGHT))
    sums = rows.groupBy("state").agg(
        F.sum("own").alias("mass"), F.sum("lower").alias("under"), F.greatest(F.first("total") - F.sum(c), F.lit(0)).alias("other"),
        F.sum(c * F.log(F.col("own") / F.col("lower"))).alias("gain"), F.count("*").alias("size"),
    )
    rest = F.greatest(1 - F.col("mass"), F.lit(1e-12)) / F.greatest(1 - F.col("under"), F.lit(1e-12))
    kept = sums.withColumn("rest", rest).filter(F.col("gain") + F.col("other") * F.log("rest") > GAIN * (1 + F.col("size")))
    kept = stored(kept.select("state", F.log10("rest").alias("rest")))
    rows, keep = rows.join(F.broadcast(kept), "state", "left"), F.col("rest").isNotNull()
    weight = F.when(keep, F.log10("own") - F.log10("lower") - F.col("rest")).otherwise(0.0)
    p = F.when(keep, F.col("own")).otherwise(F.col("lower"))
    return stored(rows.select("key", "state", "suffix", "n", "n_train", p.alias("p"), weight.alias("w"))), kept


def hot_levels(docs: DataFrame, vocabulary: DataFrame, root: Column, share: float, parts: int) -> list[tuple]:
    """For each length, the contexts that occur more often than ``share`` (rows key, suffix, n, n_train), and their tables.

    A hot context's suffixes are hot as well, so these levels are a tree of their own; no context more than 1 / ``share``
    of all words is hot. Stops at the length of which there is none.
    """
    spark, often, enough = docs.sparkSession, F.col("n") > share, F.col("n_train") >= LEAST
    end = int(np.array([END]).view(np.int64)[0])
    found = vocabulary.filter(often & (F.col("key") != end)).select("key", F.lit(0).cast("long").alias("suffix"), "n", "n_train").collect()
    lower, out = vocabulary.filter(enough).withColumn("p", root), []
    for k in (2, 3, 4):
        if not found:
            break
        states = np.sort(np.array([r.key for r in found], np.int64).view(np.uint64))

        def level_of(b: pa.RecordBatch, k=k, states=states) -> tuple:
            found, begin = tokens(b)
            *_, (part, _), (run, whole) = runs(found, begin, k)
            at = np.flatnonzero(whole)
            at = at[_place(states, part[at]) >= 0]
            learn = b.column("train").to_numpy(zero_copy_only=False).astype(float)
            return run[at], learn[np.searchsorted(begin, at, "right") - 1], part[at], part[at + 1]

        above = spark.createDataFrame([(r.key, r.n_train) for r in found], "state long, total long")
        level = stored(count_keys(docs, level_of, parts, k).filter(enough | often))
        lower, kept = tree_weights(lower, level.filter(enough), above)
        out.append((found, lower, kept))
        found = level.filter(often).select("key", "suffix", "n", "n_train").collect() if k < 4 else []
        release(level)
    return out


def value_in(part: np.ndarray, parts: int) -> np.ndarray:
    """For each part a value that is in it."""
    return (((part.astype(np.uint64) << np.uint64(32)) // np.uint64(parts)) + np.uint64(1)) << np.uint64(32)


@dataclass
class Common:
    """The frequent words, numbered from the most frequent one; the number after the last stands for no word."""

    keys: np.ndarray
    start: np.ndarray
    rank: np.ndarray
    symbols: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, often: pa.Table) -> Common:
        keys, n, count = (often.column(c).to_numpy() for c in ("key", "n", "n_train"))
        keys, first = keys.view(np.uint64), np.argsort(-n, kind="stable")
        order, rank, bits = np.argsort(keys), np.empty(len(keys) + 1, np.int32), max(8, (4 * len(keys)).bit_length())
        rank[first] = np.arange(len(keys))
        start = np.searchsorted(keys[order] >> np.uint64(64 - bits), np.arange(1 << bits).astype(np.uint64)).astype(np.int32)
        return cls(np.append(keys[order], ~np.uint64(0)), start, np.append(rank[order], -1).astype(np.int32), np.append(keys[first], np.uint64(0)), np.append(count[first], 0))

    def ids(self, words: np.ndarray) -> np.ndarray:
        """The words' numbers; -1 for a word that isn't frequent. A word's first bits say where to look for it."""
        at = self.start[words >> np.uint64(65 - len(self.start).bit_length())]
        left = np.flatnonzero(self.keys[at] < words)
        while len(left):
            at[left] += 1
            left = left[self.keys[at[left]] < words[left]]
        return np.where(self.keys[at] == words, self.rank[at], np.int32(-1))

    def packed(self, x: np.ndarray, numbers: np.ndarray, *words: np.ndarray, first: int, parts: int, all_parts: int) -> tuple:
        """One entry for each of the ``parts`` from ``first`` that ``x`` falls in: part, size, ``numbers`` by byte, ``words``.

        ``numbers`` has one line for each column of words and another for the rows; ``words`` has the keys of each column's
        words without a number.
        """
        order = np.argsort(x)
        edges = np.searchsorted(part_of(x[order], all_parts), np.arange(first, first + parts + 1))
        some, cuts = np.flatnonzero(np.diff(edges)), []
        for i, own in enumerate(words):
            rare = numbers[i] < 0
            place = (np.cumsum(rare) - 1)[order[rare[order]]]
            cuts.append((own[place], np.append(0, np.cumsum(rare[order]))[edges]))
        data = np.take(numbers, order, axis=1).view(np.uint8).reshape(len(numbers), -1, 4)
        blobs = [pa.compress(data[:, edges[p] : edges[p + 1]].transpose(2, 0, 1).tobytes(), "zstd", asbytes=True) for p in some]
        return some, np.diff(edges)[some], blobs, [b"".join(own[at[p] : at[p + 1]].tobytes() for own, at in cuts) for p in some]

    def unpacked(self, table: pa.Table, columns: int) -> tuple:
        """Of all entries: words, one line for each column, the last column's numbers, each row's ``uid`` and whether it's learnt from."""
        size = pc.sum(table.column("n")).as_py() or 0
        words, last, uid, learn = np.empty((columns, size), np.uint64), np.empty(size, np.int32), np.empty(size, np.int64), np.empty(size, bool)
        at = 0
        for first, n, numbers, keys in zip(*(table.column(c).to_pylist() for c in ("uid", "n", "numbers", "words")), strict=True):
            data = np.frombuffer(pa.decompress(numbers, 4 * n * (columns + 1), "zstd"), np.uint8).reshape(4, columns + 1, n)
            own = np.ascontiguousarray(data.transpose(1, 2, 0)).view(np.int32)[:, :, 0]
            word = self.symbols[own[:-1]]
            word[own[:-1] < 0] = np.frombuffer(keys, np.uint64)
            here = slice(at, at + n)
            words[:, here], last[here], uid[here], learn[here] = word, own[-2], first + (own[-1] >> 1).astype(np.int64), own[-1] & 1
            at += n
        return words, last, uid, learn


def score_level(state: np.ndarray, entry: np.ndarray, learn: np.ndarray, able: np.ndarray, lower: Callable) -> tuple:
    """What one length of context adds to the score of each position, whether its run is in the tree, and the probability
    there. All positions of each state are given.

    ``state`` and ``entry`` are the keys of each position's context and of its run, the context and the next word. Runs are
    looked for where ``able``; ``lower`` gives the probability after the shorter context for some positions.
    """
    out, p, listed = np.zeros(len(state)), np.zeros(len(state)), np.zeros(len(state), bool)
    at = np.flatnonzero(able)
    if not len(at):
        return out, listed, p
    _, order, first = sorted_keys(entry[at])
    order, times = at[order], np.diff(np.append(first, len(at)))
    count = np.add.reduceat(learn[order], first, dtype=np.int64)
    enough = count >= LEAST
    some, count = order[first[enough]], count[enough].astype(float)
    _, by_state, begin = sorted_keys(state)
    where = np.empty(len(state), np.int64)
    where[by_state] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(state))))
    total = np.add.reduceat(learn[by_state], begin, dtype=np.int64).astype(float)
    size, of, under = len(begin), where[some], lower(some)
    own = (count + WEIGHT * under) / (total[of] + WEIGHT)
    add = lambda x: np.bincount(of, x, size)
    entries = np.bincount(of, minlength=size)
    rest = np.maximum(1 - add(own), 1e-12) / np.maximum(1 - add(under), 1e-12)
    gain = add(count * np.log(own / under)) + np.maximum(total - add(count), 0) * np.log(rest)
    keep = (gain > GAIN * (1 + entries)) & (entries > 0)
    left = np.where(keep, np.log10(rest), 0.0)
    weight = np.where(keep[of], np.log10(own) - np.log10(under) - left[of], 0.0)
    out += left[where]
    run = np.repeat(np.arange(len(some)), times[enough])
    look = order[np.repeat(enough, times)]
    listed[look], p[look] = True, np.where(keep[of], own, under)[run]
    out[look] += weight[run]
    return out, listed, p


def score_positions(words: np.ndarray, learn: np.ndarray, hot: list, entries: tuple, kept: tuple, root: Callable) -> np.ndarray:
    """What the tree adds to each position's score; ``words`` are the lines of third, second and first word before and the word.

    Of a context that isn't in ``hot`` all positions are given. Of hot ones, ``entries`` has the sorted keys of runs, p and
    w, ``kept`` those of kept states, and rest. ``root`` gives the probability without context for some positions.
    """
    a, b, c, d = words
    pair = run_key(b, c, 2)
    states, there = [c, pair, run_key(run_key(a, b, 2), pair, 3)], [np.ones(len(c), bool), b != 0, a != 0]
    score, able, p, entry = np.zeros(len(c)), np.ones(len(c), bool), None, d
    for k, state in enumerate(states):
        entry = run_key(state, entry, k + 2)
        given = there[k] & (_place(hot[k], state) >= 0) if k < len(hot) else np.zeros(len(c), bool)
        own = np.flatnonzero(there[k] & ~given)
        lower = (lambda at, own=own: root(own[at])) if k == 0 else lambda at, own=own, p=p: p[own[at]]
        listed, now = np.zeros(len(c), bool), np.zeros(len(c))
        more, listed[own], now[own] = score_level(state[own], entry[own], learn[own], able[own], lower)
        score[own] += more
        given = np.flatnonzero(given)
        at = _place(kept[0], state[given])
        score[given[at >= 0]] += kept[1][at[at >= 0]]
        at = _place(entries[0], entry[given])
        given, at = given[at >= 0], at[at >= 0]
        score[given] += entries[2][at]
        listed[given], now[given] = True, entries[1][at]
        able, p = listed, now
    return score


def score_texts(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, train, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` says of each row whether the model learns from it; null counts as no. A null or blank text is the end mark
    alone. ``base_score`` is that of the root. Repeated rows each count and are each scored. Without training rows every
    word is unknown. Only the key, the text and what ``train`` reads are used; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text_parts, each = -(-parts // 4), parts * GROUPS
    all_parts = each * ROUNDS

    def words_of(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        found, begin = tokens(b)
        return found, np.repeat(b.column("train").to_numpy(zero_copy_only=False).astype(float), np.diff(begin))

    vocabulary = stored(count_keys(docs, words_of, parts))
    sums = vocabulary.agg(F.sum("n").alias("all"), F.sum("n_train").alias("n"), F.count(F.when(F.col("n_train") > 0, 1)).alias("v")).first()
    everything, n, v = (sums[c] or 0 for c in ("all", "n", "v"))
    often = vocabulary.filter(F.col("n") >= max(2.0, HOT_SHARE * everything)).select("key", "n", "n_train").toArrow()
    rare = 1 - sum(often.column("n").to_pylist()) / max(1, everything)
    share = max(HOT_RUNS, HOT_PARTS * everything / all_parts)
    levels = hot_levels(docs, vocabulary, (F.col("n_train") + 1) / F.lit(float(n + v + 1)), share, parts)
    release(vocabulary)
    # Each hot context has some places of its own, dealt evenly over all parts. Its table goes there and to longer contexts' places.
    hot, first, times, to = [], {}, {}, [{} for _ in levels]
    for found, _, _ in levels:
        hot.append(np.sort(np.array([r.key for r in found], np.int64).view(np.uint64)))
        for r in found:
            first[r.key], times[r.key] = sum(times.values()), math.ceil(r.n / share)
    places = sum(times.values())
    for k, (found, _, _) in reversed(list(enumerate(levels))):
        for r in found:
            to[k].setdefault(r.key, set()).update((first[r.key] + i) * all_parts // places for i in range(times[r.key]))
            if k:
                to[k - 1].setdefault(r.suffix, set()).update(to[k][r.key])
    turns = [tuple(np.array([x[r] for r in h.view(np.int64).tolist()], np.uint64) for x in (first, times)) for h in hot]
    model = spark.sparkContext.broadcast((Common.of(often), hot, turns))
    log_root, size = math.log10(n + v + 1), float(n + v + 1)
    kind = docs.schema["key"].dataType.simpleString()
    row_schema = f"uid long, key {kind}, train boolean, n_tokens long, known double, base double"
    pack_schema = pa.schema([("part", pa.int32()), ("uid", pa.int64()), ("n", pa.int32()), ("numbers", pa.binary()), ("words", pa.binary())])

    def compact(x: np.ndarray, row: np.ndarray, learn: np.ndarray, ids: np.ndarray, words: np.ndarray) -> tuple:
        return x, np.vstack([ids, (row * 2 + learn).astype(np.int32)]), *(w[i < 0] for i, w in zip(ids, words, strict=True))

    def sent(held: list, base: int, turn: int, each: int, turns: int) -> pa.RecordBatch:
        columns = [np.concatenate(x, axis=-1) for x in zip(*held, strict=True)]
        some, n, *blobs = model.value[0].packed(*columns, first=turn * each, parts=each, all_parts=turns * each)
        return batch_of(pack_schema, some, np.full(len(some), base), n, *blobs)

    def contexts(found: np.ndarray, begin: np.ndarray, at: np.ndarray, ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and words of ``length`` words before the places and of the place itself; no word before the text."""
        first = np.repeat(begin[:-1], np.diff(begin))[at]
        none = model.value[0].symbols[-1:], np.int32(len(model.value[0].symbols) - 1)
        inside = [at - k >= first for k in range(length, -1, -1)]
        take = lambda x, empty: np.stack([np.where(ok, x[np.maximum(at - k, 0)], empty) for k, ok in zip(range(length, -1, -1), inside, strict=True)])
        return take(ids, none[1]), take(found, none[0][0])

    def partial(uid: np.ndarray, *values: np.ndarray) -> tuple:
        """Sums for each text, packed by the texts' parts."""
        uid, by_text, first = sorted_keys(uid)
        part = (uid & ((1 << 33) - 1)) % text_parts
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(text_parts + 1))
        some, values = np.flatnonzero(np.diff(edges)), [uid, *(np.add.reduceat(x[by_text].astype(float), first) if len(uid) else x for x in values)]
        return some, *[[x[order[edges[p] : edges[p + 1]]].tobytes() for p in some] for x in values]

    def summed(df: DataFrame, *names: str) -> DataFrame:
        def add(group: pa.Table) -> pa.Table:
            uid, *values = (np.frombuffer(b"".join(group.column(c).to_pylist()), t) for c, t in zip(("uids", *names), (np.int64, *[float] * len(names)), strict=True))
            uid, of = np.unique(uid, return_inverse=True)
            return pa.table({"uid": uid, **{c: np.bincount(of, x, len(uid)) for c, x in zip(names, values, strict=True)}})

        return df.select("part", "uids", *names).groupBy("part").applyInArrow(add, f"uid long, {', '.join(f'{c} double' for c in names)}")

    # The words' numbers are stored once; later passes read them. Rows of texts and of blocks of texts are in one table.
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, size, first_uid, schema = model.value[0], 0, TaskContext.get().partitionId() << 33, None
        logs = np.log10(common.count + 1.0) - log_root

        def whole(**have) -> pa.RecordBatch:
            n = len(have["uid"])
            return pa.RecordBatch.from_arrays([have.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

        for b in blocks(batches):
            found, begin = tokens(b)
            ids, row, n_rows = common.ids(found), np.repeat(np.arange(b.num_rows), np.diff(begin)), b.num_rows
            schema = schema or pa.schema([("uid", pa.int64()), b.schema.field("key"), b.schema.field("train"), ("n_tokens", pa.int64()), ("known", pa.float64()), ("base", pa.float64()),
                                          *((c, pa.binary()) for c in ("sizes", "learn", "numbers", "words"))])
            here = ids >= 0
            known, base = np.bincount(row[here], common.count[ids[here]] > 0, n_rows), np.bincount(row[here], logs[ids[here]], n_rows)
            uid = first_uid + size + np.arange(n_rows)
            yield whole(uid=pa.array(uid), key=b.column("key"), train=b.column("train"), n_tokens=pa.array(np.diff(begin)), known=pa.array(known), base=pa.array(base))
            learn = b.column("train").to_numpy(zero_copy_only=False).astype(np.uint8)
            numbers = pa.compress(ids.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)
            blobs = (np.diff(begin).astype(np.int32).tobytes(), learn.tobytes(), numbers, found[~here].tobytes())
            yield whole(uid=pa.array(uid[:1]), **{c: pa.array([x], pa.binary()) for c, x in zip(("sizes", "learn", "numbers", "words"), blobs, strict=True)})
            size += n_rows

    coded = stored(docs.mapInArrow(encode, f"{row_schema}, sizes binary, learn binary, numbers binary, words binary"))
    coded_words = coded.filter("numbers is not null").select("uid", "sizes", "learn", "numbers", "words")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Of each block: where its texts' uids begin, the words and their numbers, where texts begin, and of each word its text's
        place and whether it's learnt from."""
        symbols = model.value[0].symbols
        for batch in batches:
            for uid, sizes, learn, numbers, words in zip(*(batch.column(c).to_pylist() for c in ("uid", "sizes", "learn", "numbers", "words")), strict=True):
                sizes = np.frombuffer(sizes, np.int32)
                begin = np.append(0, np.cumsum(sizes, dtype=np.int64))
                data = np.frombuffer(pa.decompress(numbers, 4 * int(begin[-1]), "zstd"), np.uint8).reshape(4, -1)
                ids = np.ascontiguousarray(data.T).view(np.int32).ravel()
                found = symbols[ids]
                found[ids < 0] = np.frombuffer(words, np.uint64)
                yield uid, found, ids, begin, np.repeat(np.arange(len(sizes)), sizes), np.frombuffer(learn, np.uint8)

    def exchanged(batches: Iterator[pa.RecordBatch], choose: Callable, length: int, turn: int, each: int, turns: int) -> Iterator[pa.RecordBatch]:
        """The places that ``choose`` gives for this turn, with the value that decides their part, and their words."""
        held, base = [], 0
        for uid, found, ids, begin, row, learn in decoded(batches):
            if held and (base != uid >> 33 << 33 or sum(len(h[0]) for h in held) > HELD):
                yield sent(held, base, turn, each, turns)
                held = []
            base = uid >> 33 << 33
            at, x = choose(found, ids, begin)
            mine = part_of(x, turns) == turn
            at, x = at[mine], x[mine]
            held.append(compact(x, uid - base + row[at], learn[row[at]], *contexts(found, begin, at, ids, length)))
        if held:
            yield sent(held, base, turn, each, turns)

    # Words that aren't frequent meet all their occurrences: counts for their texts, and for runs of two of which they're the last.
    def rare_places(found: np.ndarray, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(ids < 0)
        return at, mix(found[at])

    def count_rare(group: pa.Table) -> pa.Table:
        common, hot, _ = model.value
        (c, d), _, uid, learn = common.unpacked(group, 2)
        _, order, first = sorted_keys(d)
        count = np.zeros(len(d), np.int64)
        if len(d):
            count[order] = np.repeat(np.add.reduceat(learn[order], first, dtype=np.int64), np.diff(np.append(first, len(d))))
        some, *sums = partial(uid, count > 0, np.log10(count + 1.0) - log_root)
        able = np.flatnonzero(learn & (c != 0) & (_place(hot[0], c) < 0 if hot else True))
        run, order, first = sorted_keys(run_key(c[able], d[able], 2))
        enough = np.diff(np.append(first, len(able))) >= LEAST
        run, first = run[enough], able[order[first[enough]]]
        out = [{"part": some.astype(np.int32), **{c: pa.array(x, pa.binary()) for c, x in zip(("uids", "known", "base"), sums, strict=True)}},
               {"part": part_of(mix(c[first]), all_parts), "run": run.view(np.int64), "p": (count[first] + 1) / size}]
        schema = pa.schema([("part", pa.int32()), ("run", pa.int64()), ("p", pa.float64()), *((c, pa.binary()) for c in ("uids", "known", "base"))])
        whole = lambda x: pa.table([x.get(f.name, pa.nulls(len(x["part"]), f.type)) for f in schema], schema=schema)
        return pa.concat_tables([whole(x) for x in out])

    pack_names = "n int, numbers binary, words binary"
    rare_schema, pack = "part int, run long, p double, uids binary, known binary, base binary", f"part int, uid long, {pack_names}"
    turns_of_rare, rare_tables = max(1, math.ceil(ROUNDS * rare)), []
    for turn in range(turns_of_rare):
        words = coded_words.mapInArrow(lambda x, turn=turn: exchanged(x, rare_places, 1, turn, parts, turns_of_rare), pack)
        rare_tables.append(stored(words.groupBy("part").applyInArrow(count_rare, rare_schema)))
    rare_rows = rare_tables[0]
    for x in rare_tables[1:]:
        rare_rows = rare_rows.unionByName(x)

    # Each position's word and the words before it meet all others after the same context, where the tree is grown.
    def positions(found: np.ndarray, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        common, hot, turns = model.value
        inside = np.ones(len(found), bool)
        inside[begin[:-1]] = False  # a text's first word has no context
        inside[1:] &= (ids[:-1] < 0) | (common.count[ids[:-1]] >= LEAST)  # the word before is no context
        at = np.flatnonzero(inside)
        x = mix(found[at - 1])
        if hot:
            place = _place(hot[0], found[at - 1])
            some = np.flatnonzero(place >= 0)
            deep = contexts(found, begin, at[some], ids, 3)[1]
            pair = run_key(deep[1], deep[2], 2)
            state, longer, place = deep[2].copy(), np.where(deep[1] != 0, pair, np.uint64(0)), place[some]
            first, times = (t[place] for t in turns[0])
            for k in range(1, len(hot)):
                on = _place(hot[k], longer)
                hit = (on >= 0) & (state == (deep[2] if k == 1 else pair)) & (longer != 0)
                state, first, times = (np.where(hit, *t) for t in ((longer, state), (turns[k][0][on], first), (turns[k][1][on], times)))
                triple = np.where(deep[0] != 0, run_key(run_key(deep[0], deep[1], 2), pair, 3), np.uint64(0))
                longer = np.where(hit, triple if k == 1 else mix(deep[3]), longer)
            x[some] = value_in((first + mix(longer) % times) * np.uint64(all_parts) // np.uint64(places), all_parts)
        return at, x

    def grow_part(records: pa.Table, entries: pa.Table) -> pa.Table:
        common, hot, _ = model.value
        words, ids, uid, learn = common.unpacked(records, 4)
        what = entries.column("kind").to_numpy()
        given = []
        for i in (2, 3, 4):
            run, p, w = (entries.column(c).to_numpy()[what == i] for c in ("run", "p", "w"))
            order = np.argsort(run.view(np.uint64))
            given.append((run.view(np.uint64)[order], p[order], w[order]))

        def root(at: np.ndarray) -> np.ndarray:
            own = ids[at]
            out = (common.count[own] + 1) / size
            other = own < 0
            place = _place(given[0][0], run_key(words[2, at[other]], words[3, at[other]], 2))
            out[other] = given[0][1][place]
            return out

        score = score_positions(words, learn, hot, given[1], given[2][::2], root)
        some = np.flatnonzero(score)
        part, uids, sums = partial(uid[some], score[some])
        return pa.table({"part": pa.array(part, pa.int32()), "uids": pa.array(uids, pa.binary()), "score": pa.array(sums, pa.binary())})

    entries = [rare_rows.filter("run is not null").select("part", F.lit(2).alias("kind"), "run", "p", F.lit(0.0).alias("w"))]
    for (_, rows, kept), where in zip(levels, to, strict=True):
        routes = F.broadcast(spark.createDataFrame([(s, p) for s, some in where.items() for p in some], "state long, part int"))
        entries.append(rows.join(routes, "state").select("part", F.lit(3).alias("kind"), F.col("key").alias("run"), "p", "w"))
        entries.append(kept.join(routes, "state").select("part", F.lit(4).alias("kind"), F.col("state").alias("run"), F.lit(0.0).alias("p"), F.col("rest").alias("w")))
    every = entries[0]
    for x in entries[1:]:
        every = every.unionByName(x)
    scores = []
    for turn in range(ROUNDS):
        own = every.filter(F.col("part").between(turn * each, (turn + 1) * each - 1)).withColumn("part", F.col("part") - turn * each)
        packed = coded_words.mapInArrow(lambda x, turn=turn: exchanged(x, positions, 3, turn, each, ROUNDS), pack)
        found = packed.groupBy("part").cogroup(own.groupBy("part")).applyInArrow(grow_part, "part int, uids binary, score binary")
        scores.append(stored(summed(found, "score")))
    names = ["uid", "key", "train", "n_tokens", "known", "base", "score"]
    more = summed(rare_rows.filter("run is null"), "known", "base")
    found = coded.filter("numbers is null").select(*names[:-1])
    for x in (more, *scores):
        found = found.unionByName(x, allowMissingColumns=True)
    only = lambda c: F.first(c, ignorenulls=True).alias(c)
    add = lambda c: F.coalesce(F.sum(c), F.lit(0.0)).alias(c)
    scored = stored(found.groupBy("uid").agg(only("key"), only("train"), only("n_tokens"), *map(add, names[4:])))
    model.destroy()
    release(coded, *rare_tables, *scores, *[x for _, *tables in levels for x in tables])
    return scored.select(
        F.col("key").alias(key), "train", "n_tokens", F.col("known").cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("base") + F.col("score")).alias("score"),
    )
