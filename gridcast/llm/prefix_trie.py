"""A trie of the prefixes that conversations share: ternary search trees per range shard, shared nodes merged at the edges.

Turns are numbered by a dictionary of their distinct (role, text) pairs. Conversations become sequences of numbers; equal
sequences are counted first, then dealt by range, so a shard's sequences share no node with another shard's but those on
the paths of its first and its last sequence. Each shard grows one ternary search tree and finishes all other nodes; the
two paths of every shard meet in one streaming pass, whose size follows the number of shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.text import bounded_batches, only
from gridcast.sources.tables import cut

SHARD_TURNS = 200_000
ROWS = 20_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


def encode_turns(conversations: DataFrame) -> DataFrame:
    """One row (``conv_id``, ``ids``, ``chars``) per conversation: its turns in order as dictionary numbers, and the code
    points of each turn's text.

    Reads ``conv_id``, ``turn``, ``role`` and ``text``; other columns may have any name. A null turn comes first, turns
    of the same number go by a digest of role and text, a null role or text is empty, repeated rows are repeated turns,
    and rows with a null ``conv_id`` take no part. A turn's number stands for the SHA-256 of its role and text, so texts
    aren't shuffled. A conversation's numbers form one row, of 16 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = only(conversations, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    book = turns.groupBy("digest").agg(F.max("chars").alias("chars"))
    book = cut(book.withColumn("id", F.monotonically_increasing_id()))  # numbers are fixed by the written table
    placed = turns.drop("chars").join(book, "digest")
    at = F.struct(F.col("turn").isNotNull().alias("k"), "turn", "digest", "id", "chars")
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(at)).alias("t"))
    return whole.select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars"))


def _sequences(batch: pa.RecordBatch, *columns: str) -> list[list[np.ndarray]]:
    out = []
    for c in columns:
        column = batch.column(c)
        edges, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        out.append([values[a:b] for a, b in zip(edges, edges[1:], strict=False)])
    return out


def _count_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal sequences, sorted, as one row each: members, the smallest of them, and the digest of all of them."""
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("chars", pa.list_(pa.int64())), ("n", pa.int64()),
                        ("first", pa.int64()), ("ends", pa.string())])
    key = held = digest = None
    done: list[tuple] = []
    for batch in batches:
        ids, chars = _sequences(batch, "ids", "chars")
        for seq, size, conv in zip(ids, chars, batch.column("conv_id").to_pylist(), strict=True):
            now = seq.tobytes()
            if now == key:
                held[2] += 1
                digest.update(b",%d" % conv)
                continue
            if key is not None:
                done.append((*held, digest.hexdigest()))
            key, held, digest = now, [seq.tolist(), size.tolist(), 1, conv], hashlib.sha256(b"%d" % conv)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
            done = []
    if key is not None:
        done.append((*held, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)


class TernaryTree:
    """A ternary search tree over sequences of numbers; node 0 is the empty sequence.

    ``low`` and ``high`` lead to smaller and larger siblings, ``inside`` to the sequences that go on. ``above`` is the
    node of the sequence without its last number.
    """

    def __init__(self) -> None:
        self.symbol, self.low, self.inside, self.high, self.above = [-1], [-1], [-1], [-1], [-1]
        self.chars, self.depth, self.n, self.first, self.ends = [0], [0], [0], [None], [None]

    def insert(self, ids: np.ndarray, chars: np.ndarray, n: int, first: int, ends: str) -> list[int]:
        """Add a sequence of ``n`` members; returns the nodes on its path, the root first."""
        at, path = 0, [0]
        for s, c in zip(ids.tolist(), chars.tolist(), strict=True):
            before, side, x = at, self.inside, self.inside[at]
            while x >= 0 and self.symbol[x] != s:
                side = self.low if s < self.symbol[x] else self.high
                before, x = x, side[x]
            if x < 0:
                x = side[before] = len(self.symbol)
                for column, value in zip(
                    (self.symbol, self.low, self.inside, self.high, self.above, self.chars, self.depth, self.n, self.first, self.ends),
                    (s, -1, -1, -1, at, c, len(path), 0, None, None), strict=True,
                ):
                    column.append(value)
            path.append(x)
            at = x
        for x in path:
            self.n[x] += n
            self.first[x] = first if self.first[x] is None else min(self.first[x], first)
        self.ends[at] = ends
        return path

    def walk(self) -> list[int]:
        """All nodes, each after the node above it; iterative, so that depth is no limit."""
        out, open_ = [0], [self.inside[0]]
        while open_:
            x = open_.pop()
            if x >= 0:
                out.append(x)
                open_ += (self.high[x], self.inside[x], self.low[x])
        return out


def median_order(n: int) -> Iterator[int]:
    """0..n-1, the middle first, then the middles of both halves and so on: sorted items inserted so keep a tree balanced."""
    open_ = [(0, n)]
    while open_:
        a, b = open_.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            open_ += ((m + 1, b), (a, m))


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, spine long"
SPINE = "ids array<long>, chars array<long>, n array<long>, first array<long>, children array<long>, leaves array<long>, saved array<long>, ends array<string>"


def _schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    node = [(c.split()[0], pa.string() if "string" in c else pa.int64()) for c in NODE.split(", ")]
    return pa.schema([*node, *((c, longs) for c in ("ids", "chars", "n", "first", "children", "leaves", "saved")), ("ends", pa.list_(pa.string()))])


def _rows(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), ROWS):
        part = list(zip(*rows[a : a + ROWS], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(part, schema, strict=True)], schema=schema)


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's tree: rows of the nodes that only this shard has, then its first and last path.

    A path has one entry for each of its nodes with what hangs on the node in this shard, other nodes of the two paths
    and what hangs on those left out. Where both paths run together, the last one's entries are 0.
    """
    schema, parts = _schema(), []
    for batch in batches:
        n, first, ends = (batch.column(c).to_pylist() for c in ("n", "first", "ends"))
        parts += zip(*_sequences(batch, "ids", "chars"), n, first, ends, strict=True)
    if not parts:
        return
    tree, paths = TernaryTree(), {}
    for i in median_order(len(parts)):
        path = tree.insert(*parts[i])
        if i in (0, len(parts) - 1):
            paths[i] = path
    name = 2 * TaskContext.get().partitionId()
    spines = [paths[0]] + ([paths[len(parts) - 1]] if len(parts) > 1 else [])
    owner = {x: name + side for side, path in reversed(list(enumerate(spines))) for x in path}
    size = len(tree.symbol)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    rows = []
    for x in reversed(tree.walk()):
        if x in owner:
            continue
        above = tree.above[x]
        leaves[x] += tree.inside[x] < 0
        saved[x] += (tree.n[x] - 1) * tree.chars[x]
        children[above] += 1
        leaves[above] += leaves[x]
        saved[above] += saved[x]
        known = above not in owner
        rows.append((tree.first[x], tree.depth[x], tree.first[above] if known else None, tree.n[x], children[x], leaves[x],
                     saved[x], tree.ends[x] or NO_ENDS, None if known else owner[above], *[None] * 8))
        if len(rows) >= ROWS:
            yield from _rows(rows, schema)
            rows = []
    for side, path in enumerate(spines):
        own = [owner[x] == name + side for x in path]
        of = lambda column, empty=0: [column[x] if mine else empty for x, mine in zip(path, own, strict=True)]  # noqa: B023, E731
        rows.append((*[None] * 8, name + side, [tree.symbol[x] for x in path[1:]], [tree.chars[x] for x in path], of(tree.n),
                     of(tree.first, None), of(children), of(leaves), of(saved), of(tree.ends, None)))
    yield from _rows(rows, schema)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All shards' paths in order: a node is finished when a path no longer runs through it.

    Gives a row per node, and per node and path through it a row with only ``spine``, ``depth`` and ``conv_id``, by which
    children find the node's smallest member. Open nodes are those of one path.
    """
    schema = pa.schema(list(_schema())[:9])
    stack: list[dict] = []
    before: list[int] = []
    rows: list[tuple] = []

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            at = len(stack)
            node["leaves"] += node["children"] == 0
            node["saved"] += (node["n"] - 1) * node["chars"]
            if stack:
                stack[-1]["children"] += 1
                stack[-1]["leaves"] += node["leaves"]
                stack[-1]["saved"] += node["saved"]
            rows.append((node["first"], at, None, node["n"], node["children"], node["leaves"], node["saved"],
                         node["ends"] or NO_ENDS, node["spines"][0] if at else None))
            rows.extend((node["first"], at, *[None] * 6, s) for s in node["spines"])

    for batch in batches:
        for row in batch.to_pylist():
            ids = row["ids"]
            same = 0
            while stack and same < min(len(ids), len(before)) and ids[same] == before[same]:
                same += 1
            close(same + 1 if stack else 0)
            before = ids
            for d in range(len(ids) + 1):
                if d == len(stack):
                    stack.append({"n": 0, "first": None, "children": 0, "leaves": 0, "saved": 0, "ends": None, "chars": row["chars"][d], "spines": []})
                node = stack[d]
                for c in ("n", "children", "leaves", "saved"):
                    node[c] += row[c][d]
                if row["first"][d] is not None:
                    node["first"] = row["first"][d] if node["first"] is None else min(node["first"], row["first"][d])
                node["ends"] = row["ends"][d] or node["ends"]
                node["spines"].append(row["spine"])
            if len(rows) >= ROWS:
                yield from _rows(rows, schema)
                rows = []
    close(0)
    yield from _rows(rows, schema)


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every distinct prefix of the sequences (``conv_id``, ``ids``, ``chars``) as a node, the empty one included.

    A node's members are the conversations that start with it. Columns: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (the parent's ``conv_id``; null at the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless
    nodes in its subtree, itself included), ``saved_tokens`` (over its subtree, members less one times the characters of
    the last turn) and ``ends_sha256`` (of the members that end here, ascending, joined by commas).

    ``conv_id`` must be unique and not null, as `encode_turns` makes it. Empty sequences are members of the root alone;
    no sequences give no rows. Equal sequences are streamed through one task in order, as their digest needs, but held as
    one; a shard holds ``shard_turns`` turns of different sequences and one sequence more.
    """
    bounded_batches(sequences.sparkSession)
    dealt = sequences.select("conv_id", "ids", "chars").repartition("ids").sortWithinPartitions("ids", "conv_id")
    counted = cut(dealt.mapInArrow(_count_equal, "ids array<long>, chars array<long>, n long, first long, ends string"))
    turns = counted.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]  # one number
    shards = max(1, -(-turns // shard_turns))
    placed = counted.repartitionByRange(shards, "ids").sortWithinPartitions("ids")
    grown = cut(placed.mapInArrow(_grow, f"{NODE}, {SPINE}"))
    own = [c.split()[0] for c in NODE.split(", ")]
    paths = grown.filter("ids IS NOT NULL").select("spine", *[c.split()[0] for c in SPINE.split(", ")])
    merged = cut(paths.coalesce(1).sortWithinPartitions("ids").mapInArrow(_merge, NODE))  # two paths for each shard
    names = merged.filter("n_convs IS NULL").select("spine", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_above"))
    nodes = grown.filter("ids IS NULL").select(*own).unionByName(merged.filter("n_convs IS NOT NULL"))
    found = nodes.filter("spine IS NOT NULL").join(names, ["spine", "depth"]).withColumn("parent_conv_id", F.col("_above"))
    return nodes.filter("spine IS NULL").select(*own).unionByName(found.select(*own)).drop("spine")
