"""Jaccard similarity join of word n-gram sets over a forest of count-vector R-trees.

A document's set holds the hashes of its distinct word windows. Hashes are cut into groups by their leading bits.

* Roots: sets of sizes a and b with Jaccard similarity p differ in at most (a + b)(1 - p)/(1 + p) windows. Cut into more
  groups than that, two such sets agree wholly in one group, so each pair to be found meets in the root of some tree: same
  size range, same group, same content. Groups that are empty carry no information; a document uses them only if it has
  too many of them to rely on the others, which keeps the search exact.
* Points and nodes: in a tree, a document is the vector of its counts per group. A leaf keeps the largest count of up to 64
  points at each coordinate, and a branch that of up to 32 leaves. The sum of the smaller coordinates of two vectors bounds
  the overlap of the sets; the same sum of two corners bounds all points below them. What stays is verified on the sets.
* Every root first compares its points with one pivot, by their vectors and then by their sets. Once those links are joined
  to components, a tree whose points all lie in one component is done; only others are searched, and only between
  components. So a group of thousands of copies costs a few comparisons for each, not all pairs, and no link that changes a
  component is lost. A pair that meets in several trees is left to the one with the least root.

Equality is that of 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.components import components
from gridcast.llm.text import (
    batch_of, blocks, bounded_batches, flat, mix, only, shingle_sets, span_hashes, word_spans,
)
from gridcast.sources.tables import cut

MOST_BITS = 14
LEAF, FAN = 64, 32  # points of a leaf, leaves of a branch
LISTED = 16  # roots that each point carries
PIVOT_SHARE = 256
FEW = 200_000  # names that are broadcast
EMPTY = np.uint64(0x632BE59BD9B4E019)


def class_starts(percent: int, upto: int) -> np.ndarray:
    """Starts of size classes: a set and a linked one that is no smaller lie in the same class or in adjacent ones."""
    out = [1]
    while out[-1] <= upto:
        out.append(out[-1] * 100 // percent + 1)
    return np.array([*out, out[-1] * 100 // percent + 1], np.int64)


def block_sets(batch: pa.RecordBatch, size: int, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(batch.column(text))
    starts, ends, before = word_spans(data, offsets)
    return shingle_sets(span_hashes(data, starts, ends), before, size)


def set_names(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name for each whole set, 0 for the empty one."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets ^ EMPTY), dtype=np.uint64)])
    n = np.diff(ends)
    names = mix(total[ends[1:]] - total[ends[:-1]] + n.astype(np.uint64))
    return np.where(n > 0, names, np.uint64(0)).view(np.int64)


def signatures(sets: np.ndarray, ends: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Root keys of each set and the index of the set; sets that only link with themselves have none."""
    n = np.diff(ends)
    starts = class_starts(percent, int(n.max(initial=1)))
    own = np.searchsorted(starts, n, "right") - 1
    keys, whose = [], []
    for lower in (True, False):  # as the one in the smaller class of the range, then as the one in the larger
        cls = own if lower else own - 1
        ok = (n > 0) & (cls >= 0)
        top = starts[np.clip(cls, 0, None) + 2] - 1
        most = lambda a, b: (a + b) * (100 - percent) // (100 + percent)
        differ = most(n, np.minimum(n * 100 // percent, top) if lower else starts[np.clip(cls, 0, None) + 1] - 1)
        groups = most(top, top) + most(top, top) // 20 + 3
        use = np.flatnonzero(ok & (differ > 0))
        if not len(use):
            continue
        index = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in use])
        doc = np.repeat(use, n[use])
        h = sets[index]
        group = ((h >> np.uint64(32)) * groups[doc].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(h), bool)
        new[1:] = (group[1:] != group[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        content = np.add.reduceat(mix(h), at)
        salt = mix(cls[doc[at]].astype(np.uint64) * np.uint64(1 << 40) + group[at])
        keys.append(mix(content ^ salt))
        whose.append(doc[at])
        filled = np.bincount(doc[at], minlength=len(n))
        for i in use[groups[use] - filled[use] >= groups[use] - differ[use]]:
            mine = group[at[doc[at] == i]]
            free = np.setdiff1d(np.arange(groups[i], dtype=np.uint64), mine)
            keys.append(mix(mix(np.uint64(cls[i]) * np.uint64(1 << 40) + free) ^ EMPTY))
            whose.append(np.full(len(free), i))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(whose)


def digest_sets(docs: DataFrame, key: str, size: int) -> DataFrame:
    """(key, n_shingles, name) for each row; ``name`` is the same for the same set."""
    schema = pa.schema([("key", pa.int64()), ("n_shingles", pa.int64()), ("name", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            sets, ends = block_sets(b, size)
            yield batch_of(schema, b.column(0), np.diff(ends), set_names(sets, ends))

    return docs.mapInArrow(run, "key long, n_shingles long, name long")


def shared_roots(docs: DataFrame, size: int, percent: int, parts: int) -> DataFrame:
    """(root, name, pivot) of every root with two or more different sets. Roots with the same sets count once.

    Root keys travel as packed arrays, one row for each block of texts and part of the key space, about 8 bytes a key.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("low", "mid", "local", "names"))])
        for b in blocks(batches):
            sets, ends = block_sets(b, size)
            names = set_names(sets, ends)
            _, first = np.unique(names, return_index=True)
            keys, whose = signatures(sets, ends, percent)
            keep = np.isin(whose, first)
            keys, whose = keys[keep], whose[keep]
            part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            order = np.lexsort((whose, part))
            part, keys, whose = part[order], keys[order], whose[order]
            edges = np.searchsorted(part, np.arange(parts + 1))
            some = np.flatnonzero(np.diff(edges))
            cols = [[], [], [], []]
            for p in some:
                s = slice(edges[p], edges[p + 1])
                here, local = np.unique(whose[s], return_inverse=True)
                cols[0].append((keys[s] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())
                cols[1].append(((keys[s] >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8).tobytes())
                cols[2].append(local.astype(np.uint16 if len(here) < 65536 else np.uint32).tobytes())
                cols[3].append(names[here].tobytes())
            yield batch_of(schema, some.astype(np.int32), *cols)

    def meet(group: pa.Table) -> pa.Table:
        blob = lambda name, kind: np.frombuffer(b"".join(group.column(name).to_pylist()), kind)
        keys = (blob("mid", np.uint8).astype(np.uint64) << np.uint64(32)) | blob("low", np.uint32)
        names = [np.frombuffer(x, np.int64) for x in group.column("names").to_pylist()]
        kinds = (np.uint16 if len(x) < 65536 else np.uint32 for x in names)
        local = group.column("local").to_pylist()
        names = np.concatenate([n[np.frombuffer(x, kind)] for n, x, kind in zip(names, local, kinds, strict=True)])
        order = np.lexsort((names, keys))
        keys, names = keys[order], names[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
        keys, names = keys[new], names[new]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        count = np.diff(np.concatenate([at, [len(keys)]]))
        same = np.add.reduceat(mix(names.view(np.uint64)), at) if len(at) else at.astype(np.uint64)
        many = np.flatnonzero(count >= 2)
        _, one = np.unique(mix(same[many] + count[many].astype(np.uint64)), return_index=True)
        many = many[one]
        if not len(many):
            index, root, pivot = (np.zeros(0, np.int64),) * 3
        else:
            n = count[many]
            index = np.repeat(at[many], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            root = np.repeat(mix(same[many] + n.astype(np.uint64)).view(np.int64), n)
            pivot = np.repeat(names[at[many]], n)
        return pa.table({"root": root, "name": names[index], "pivot": pivot})

    packed = docs.select("text").mapInArrow(pack, "part int, low binary, mid binary, local binary, names binary")
    met = packed.groupBy("part").applyInArrow(meet, "root long, name long, pivot long")
    return met.dropDuplicates(["root", "name"])


def _dealt(table: DataFrame, pairs: DataFrame, *columns: str) -> DataFrame:
    """(pivot, share, name, *columns) of both ends of the pairs (a, b), each pivot ``a`` right before its partners.

    ``table`` has a row for each name. A pivot with many partners is dealt over several tasks, ``PIVOT_SHARE`` partners
    in each or so. Up to ``FEW`` names are counted and broadcast, so that of the table only their rows are sent; beyond
    that, the table itself is.
    """
    names = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    if names.limit(FEW + 1).count() <= FEW:
        table = table.join(F.broadcast(names), "name", "left_semi")
    load = pairs.groupBy("a").agg(F.count("*").alias("n"))
    load = load.select("a", F.ceil(F.col("n") / PIVOT_SHARE).cast("int").alias("shares"))
    dealt = pairs.join(load, "a").select(F.col("b").alias("name"), F.col("a").alias("pivot"),
                                         F.pmod(F.xxhash64("b"), F.col("shares")).cast("int").alias("share"))
    heads = load.select(F.col("a").alias("name"), F.col("a").alias("pivot"),
                        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    sent = dealt.unionByName(heads).join(table.select("name", *columns), "name").select("pivot", "share", "name", *columns)
    return sent.repartition("pivot", "share").sortWithinPartitions("pivot", "share", F.col("name") != F.col("pivot"))


def _need(x, y, percent: int):
    """Least overlap of linked sets of sizes x and y."""
    return (percent * (x + y) + 99 + percent) // (100 + percent)


def sift(table: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of names that pass the bound of their count vectors, which are a tenth as long as the texts."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, head, head_n = None, None, 0
        for b in batches:
            found = [[], []]
            for pivot, share, name, n, vector in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                own = _loosen(vector)
                if name == pivot:
                    at, head, head_n = (pivot, share), own, n
                    continue
                assert at == (pivot, share)
                width = min(len(own), len(head))
                if np.minimum(_folded(own, width), _folded(head, width)).sum() >= _need(n, head_n, percent):
                    found[0].append(pivot)
                    found[1].append(name)
            yield batch_of(out, *found)

    return _dealt(table, pairs, "n", "vector").mapInArrow(test, "a long, b long")


def verify(table: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those pairs (a, b) of names whose sets reach the similarity; texts, which are smaller than their sets, are sent."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, head = None, None
        for b in blocks(batches):
            sets, ends = block_sets(b, size)
            found = [[], []]
            columns = (b.column(i).to_pylist() for i in range(3))
            for i, (pivot, share, name) in enumerate(zip(*columns, strict=True)):
                own = sets[ends[i] : ends[i + 1]]
                if name == pivot:
                    at, head = (pivot, share), own
                    continue
                assert at == (pivot, share)
                small, big = sorted((len(own), len(head)))
                if 100 * small < percent * big:
                    continue
                both = len(np.intersect1d(own, head, assume_unique=True))
                if 100 * both >= percent * (small + big - both):
                    found[0].append(pivot)
                    found[1].append(name)
            yield batch_of(out, *found)

    return _dealt(table, pairs, "text").mapInArrow(test, "a long, b long")


def _counts(own: np.ndarray) -> np.ndarray:
    """Count vector of a set, with a coordinate for one or two windows; coordinates are nested, so pairs of them add up."""
    bits = min(max((len(own) // 2).bit_length(), 4), MOST_BITS)
    return np.bincount((own >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint16)


def _squeeze(vector: np.ndarray) -> bytes:
    """Counts, most of them 0 or 1, in a tenth of their bytes."""
    return zlib.compress(vector.astype(np.uint16).tobytes(), 1)


def _loosen(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint16)


def _folded(vector: np.ndarray, width: int) -> np.ndarray:
    return vector.reshape(width, -1).sum(1, dtype=np.int32)


def _narrow(vectors: np.ndarray, width: int) -> np.ndarray:
    return vectors if vectors.shape[1] == width else vectors.reshape(len(vectors), width, -1).sum(2, dtype=np.int32)


def _overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of each row of ``a`` with each of ``b``: for t = 1, 2, ... the coordinates where both reach t."""
    total, t = np.zeros((len(a), len(b)), np.float32), 1
    while (some := (a.max(0) >= t) & (b.max(0) >= t)).any():
        total += (a[:, some] >= t).astype(np.float32) @ (b[:, some] >= t).astype(np.float32).T
        t += 1
    return total


@dataclass
class Leaf:
    """Some points of one root: the largest count at each coordinate and, by point, name, label, size, the
    least of its roots, and counts."""

    root: int
    corner: np.ndarray
    names: np.ndarray
    labels: np.ndarray
    sizes: np.ndarray
    least: np.ndarray
    ends: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Leaf:
        """From rows (root, label, n, name, vector, least)."""
        labels, sizes, names = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
        vectors = [_loosen(r[4]) for r in rows]
        width = min(map(len, vectors))
        vectors = np.stack([_folded(v, width) for v in vectors]).astype(np.uint16)
        ends = np.cumsum([0, *(len(r[5]) for r in rows)])
        least = np.array([x for r in rows for x in r[5]], np.int64)
        return cls(rows[0][0], vectors.max(0), names, labels, sizes, least, ends, vectors)

    def packed(self) -> list[bytes]:
        longs = (self.names, self.labels, self.sizes, self.least, self.ends.astype(np.int64))
        return [*(x.tobytes() for x in longs), _squeeze(self.vectors)]

    @classmethod
    def loose(cls, root: int, *packed: bytes) -> Leaf:
        *longs, vectors = packed
        names, *others = (np.frombuffer(x, np.int64) for x in longs)
        vectors = _loosen(vectors).reshape(len(names), -1)
        return cls(root, vectors.max(0), names, *others, vectors)

    def roots(self, i: int) -> set[int]:
        return set(self.least[self.ends[i] : self.ends[i + 1]].tolist())

    def near(self, other: Leaf, percent: int) -> list[tuple[int, int]]:
        """Pairs (a, b) of a point of each, of different labels, that pass the bound and have no lesser root in common.

        A pair meets in each root that both have. Points carry the least few of their roots: if both list a lesser one, the
        pair is found there. In the least common root it's never left out.
        """
        least = _need(int(self.sizes.min()), int(other.sizes.min()), percent)
        width = min(self.vectors.shape[1], other.vectors.shape[1])
        if self is not other and np.minimum(_folded(self.corner, width), _folded(other.corner, width)).sum() < least:
            return []
        apart = self.labels[:, None] != other.labels[None, :]
        if not apart.any():
            return []
        overlap = _overlaps(_narrow(self.vectors, width), _narrow(other.vectors, width))
        ok = apart & (overlap >= _need(self.sizes[:, None], other.sizes[None, :], percent))
        out = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(ok) if self is other else ok)), strict=True):
            if all(r >= self.root for r in self.roots(i) & other.roots(j)):
                a, b = int(self.names[i]), int(other.names[j])
                out.append((min(a, b), max(a, b)))
        return out


def search_trees(table: DataFrame, points: DataFrame, percent: int, leaf_size: int = LEAF, fan: int = FAN) -> DataFrame:
    """Pairs (a, b) of points (root, name, label) of one root and of different labels that pass the count-vector bound.

    Points with their vectors are sorted by root, label and size over all tasks, so a root with very many points has as
    many tasks as it needs; runs of ``leaf_size`` points are leaves, and runs of ``fan`` leaves branches. A leaf is searched
    where it's built. Then branches of a root meet by their corners only, and the leaves of branches that pass are sent
    to one task for each pair of branches.
    """
    kinds = [*((c, pa.int64()) for c in ("a", "b", "root", "branch", "leaf", "low", "high", "size")), ("corner", pa.binary())]
    parts = ("names", "labels", "sizes", "least", "ends", "vectors")
    node = pa.schema([*kinds, *((c, pa.binary()) for c in parts)])
    pair = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        rows, held, branch = [], [], []
        number = 0

        def close_leaf() -> None:
            if held:
                branch.append(leaf := Leaf.of(held))
                rows.extend((a, b, *[None] * 13) for a, b in leaf.near(leaf, percent))
                held.clear()

        def close_branch(whole: bool) -> None:
            nonlocal number
            if branch and not (whole and len(branch) == 1):  # a root's only leaf has been searched
                id_, low, high = first + number, *(f(int(f(x.sizes)) for x in branch) for f in (min, max))
                width = min(len(x.corner) for x in branch)
                corner = np.stack([_folded(x.corner, width) for x in branch]).max(0)
                rows.extend((None, None, x.root, id_, i, None, None, None, None, *x.packed()) for i, x in enumerate(branch))
                rows.append((None, None, branch[0].root, id_, None, low, high, len(branch), _squeeze(corner), *[None] * 6))
                number += 1
            branch.clear()

        root, begun, before = None, 0, False  # roots begun in this task; whether the root has an earlier branch
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if r[0] != root:
                    close_leaf()
                    close_branch(begun > 1 and not before)  # the task's first and last root may have points in others
                    root, begun, before = r[0], begun + 1, False
                elif len(held) == leaf_size:
                    close_leaf()
                    if len(branch) == fan:
                        close_branch(False)
                        before = True
                held.append(r)
                if len(rows) >= 256:
                    yield batch_of(node, *zip(*rows, strict=True))
                    rows.clear()
        close_leaf()
        close_branch(False)
        if rows:
            yield batch_of(node, *zip(*rows, strict=True))

    def corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for low, other_low, *both in zip(*(b.column(c).to_pylist() for c in ("low", "r_low", "corner", "r_corner")), strict=True):
                x, y = map(_loosen, both)
                width = min(len(x), len(y))
                keep.append(np.minimum(_folded(x, width), _folded(y, width)).sum() >= _need(low, other_low, percent))
            yield b.select(["branch", "r_branch"]).filter(pa.array(keep, pa.bool_()))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left = None, []
        for b in batches:
            found = []
            for x, y, other, root, *packed in zip(*(b.column(i).to_pylist() for i in range(4 + len(parts))), strict=True):
                if at != (x, y):
                    at, left = (x, y), []
                leaf = Leaf.loose(root, *packed)
                if other or x == y:
                    for mine in left:
                        found += mine.near(leaf, percent)
                if not other:
                    left.append(leaf)
            if found:
                yield batch_of(pair, *zip(*found, strict=True))

    ends = F.sort_array(F.collect_list("root"))
    named = points.groupBy("name").agg(F.first("label").alias("label"), ends.alias("roots")).join(table.select("name", "n", "vector"), "name")
    rows = named.select(F.explode("roots").alias("root"), "label", "n", "name", "vector", F.slice("roots", 1, LISTED).alias("least"))
    order = ["root", "label", "n", "name"]
    schema = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'binary'}" for f in node)
    nodes = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(build, schema))
    branches = nodes.filter("leaf is null and a is null").select("root", "branch", "low", "high", "size", "corner")
    right = branches.select(*[F.col(c).alias(f"r_{c}") for c in branches.columns])
    met = branches.join(right, (F.col("root") == F.col("r_root")) & (F.col("branch") <= F.col("r_branch"))
                        & ((F.col("branch") != F.col("r_branch")) | (F.col("size") > 1))
                        & (F.col("low") * percent <= F.col("r_high") * 100) & (F.col("r_low") * percent <= F.col("high") * 100))
    met = met.select("branch", "r_branch", "low", "r_low", "corner", "r_corner").mapInArrow(corners, "x long, y long")
    sides = F.when(F.col("x") == F.col("y"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    met = met.withColumn("other", F.explode(sides)).withColumn("branch", F.when(F.col("other") == 0, F.col("x")).otherwise(F.col("y")))
    sent = met.join(nodes.filter("leaf is not null"), "branch").select("x", "y", "other", "root", *parts, "leaf")
    across = sent.repartition("x", "y").sortWithinPartitions("x", "y", "other", "leaf").drop("leaf").mapInArrow(meet, "a long, b long")
    return nodes.filter("a is not null").select("a", "b").unionByName(across).distinct()


def _own_texts(named: DataFrame, size: int) -> DataFrame:
    """(name, n, vector, text) of the rows whose text has the set of its name: a repeated key can have other texts too."""
    out = pa.schema([("name", pa.int64()), ("n", pa.int64()), ("vector", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            sets, ends = block_sets(b, size)
            own = set_names(sets, ends) == b.column("name").to_numpy()
            b = b.filter(pa.array(own))
            rows = [_squeeze(_counts(sets[ends[i] : ends[i + 1]])) for i in np.flatnonzero(own)]
            yield batch_of(out, b.column("name"), np.diff(ends)[own], rows, b.column("text"))

    return named.mapInArrow(run, "name long, n long, vector binary, text string")


def _apart(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs whose ends aren't in one component yet."""
    a, b = (named.select(F.col("vertex").alias(f"_{c}"), F.col("component").alias(f"_{c}_in")) for c in "ab")
    met = pairs.join(a, F.col("a") == F.col("_a"), "left").join(b, F.col("b") == F.col("_b"), "left")
    return met.filter(F.coalesce("_a_in", "a") != F.coalesce("_b_in", "b")).select("a", "b")


def _named_texts(docs: DataFrame, size: int) -> DataFrame:
    """(name, text) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("name", pa.int64()), ("text", pa.string())])
        for b in blocks(batches):
            yield batch_of(out, set_names(*block_sets(b, size)), b.column("text"))

    return docs.select("text").mapInArrow(run, "name long, text string")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id) per row: the smallest key reachable over links of similarity ``percent`` or more.

    A null or blank text has an empty set, is linked with nothing and is its own component. Repeated texts are one
    class. Keys must be integers. Rows that repeat a key are vertices of their own, each with its own text. A row without a
    key is a vertex too, and names no component: the id is null if no linked row has a key. Other columns aren't read. An
    empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    docs = only(docs, key, text).toDF("key", "text").withColumn("key", F.col("key").cast("long"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digests = cut(digest_sets(docs, "key", size))
    classes = cut(digests.filter("n_shingles > 0").groupBy("name").agg(F.min("key").alias("rep")))
    roots = cut(shared_roots(docs, size, percent, parts))
    members = classes.join(roots.select("name").distinct(), "name", "left_semi")
    keyed = docs.join(members, F.col("key") == F.col("rep")).select("name", "text")
    unkeyed = _named_texts(docs.filter("key is null"), size).join(members.filter("rep is null").select("name"), "name", "left_semi")
    table = cut(_own_texts(keyed.unionByName(unkeyed.dropDuplicates(["name"])), size))
    # Each point meets the least of its pivots first; other pivots only if the two are still apart.
    stars = roots.filter("name != pivot").select(F.col("pivot").alias("a"), F.col("name").alias("b")).distinct()
    first = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = cut(verify(table, cut(sift(table, first, percent)), size, percent))
    named = components(links, "a", "b")
    second = _apart(stars.join(first, ["a", "b"], "left_anti"), named)
    links = cut(links.unionByName(verify(table, cut(sift(table, cut(second), percent)), size, percent)))
    named = components(links, "a", "b")
    points = roots.select("root", "name").join(named, F.col("name") == F.col("vertex"), "left")
    points = cut(points.select("root", "name", F.coalesce("component", "name").alias("label")))
    split = points.groupBy("root").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("root")
    open_points = cut(points.join(split, "root", "left_semi"))
    if not open_points.isEmpty():
        more = search_trees(table, open_points, percent)
        # What the pivots have compared needn't be verified again.
        done = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links = cut(links.unionByName(verify(table, cut(more.join(done, ["a", "b"], "left_anti")), size, percent)))
        named = components(links, "a", "b")
    # From names of sets to keys: the smallest key of all classes in a component.
    tops = named.join(classes, F.col("vertex") == F.col("name")).groupBy("component").agg(F.min("rep").alias("least"))
    roots_own = classes.withColumnRenamed("name", "component")
    tops = tops.join(roots_own, "component").select("component", F.least("least", "rep").alias("component_id"))
    merged = named.join(tops, "component").select(F.col("vertex").alias("name"), "component_id")
    merged = merged.unionByName(tops.select(F.col("component").alias("name"), "component_id"))
    of_class = classes.join(merged, "name", "left").select("name", F.coalesce("component_id", "rep").alias("component_id"))
    out = digests.join(of_class, "name", "left")
    return out.select(F.col("key").alias(key), "n_shingles", F.coalesce("component_id", "key").alias("component_id"))
