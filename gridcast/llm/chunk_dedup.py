"""Repeated substrings by content-defined chunks.

A gear hash over the last 32 bytes proposes chunk ends, so an insertion changes the chunks around it and no others. Chunks
have 32 to 512 bytes (the last of a text may be shorter) and end between characters. Of equal chunks, by a 128-bit
digest, the first in order of key and position stays; shorter ones than ``MIN_BYTES`` always stay.

In each block of texts, only the first of equal chunks is sent on: a chunk that a third of all texts hold costs one entry
for each block. Entries travel packed, in one row for each block and part of the digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.text import BYTE, batch_of, blocks, bounded_batches, flat, mix, only

MIN_BYTES, MAX_BYTES, WINDOW, MASK_BITS = 32, 512, 32, 5


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the last 32 bytes' table values, each shifted by its distance."""
    h, step = BYTE[data], 1
    while step < WINDOW:  # a window of 2k bytes from two of k
        wide = h.copy()
        wide[step:] += h[:-step] << np.uint64(step)
        h, step = wide, step * 2
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of all chunks, text after text."""
    inner = (data & 0xC0) == 0x80  # not the first byte of a character
    hit = ((gear(data) >> np.uint64(WINDOW - MASK_BITS)) & np.uint64((1 << MASK_BITS) - 1)) == 0
    hit[:-1] &= ~inner[1:]
    wanted = np.flatnonzero(hit) + 1
    bound = np.searchsorted(wanted, offsets)
    starts, ends = [], []
    for i in range(len(offsets) - 1):
        last, stop = int(offsets[i]), int(offsets[i + 1])
        for at in [*wanted[bound[i] : bound[i + 1]].tolist(), stop]:
            if at - last < MIN_BYTES and at != stop:
                continue
            while at - last > MAX_BYTES:
                cut_ = last + MAX_BYTES
                while cut_ > last + MIN_BYTES and inner[cut_]:
                    cut_ -= 1
                starts.append(last)
                ends.append(cut_)
                last = cut_
            if at > last and (at == stop or at - last >= MIN_BYTES):
                starts.append(last)
                ends.append(at)
                last = at
    return np.array(starts, np.int64), np.array(ends, np.int64)


def repeated_chunks(docs: DataFrame, parts: int) -> DataFrame:
    """(key, body, start, end) of every chunk, in bytes of its text, that equals an earlier one. ``body`` is the text's hash,
    which tells rows of one key apart; rows come in the order of key, then body."""
    schema = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("digests", "keys", "bodies", "starts", "ends"))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            data, offsets = flat(b.column("text"))
            starts, ends = chunk_ends(data, offsets)
            owner = np.searchsorted(offsets, starts, "right") - 1
            keys, bodies = b.column("key").to_numpy()[owner], b.column("body").to_numpy()[owner]
            big = ends - starts >= MIN_BYTES
            starts, ends, keys, bodies, owner = starts[big], ends[big], keys[big], bodies[big], owner[big]
            raw = data.tobytes()
            digest = b"".join(hashlib.blake2b(raw[i:j], digest_size=16).digest() for i, j in zip(starts.tolist(), ends.tolist(), strict=True))
            pairs = np.frombuffer(digest, np.uint64).reshape(-1, 2)
            starts, ends = starts - offsets[owner], ends - offsets[owner]
            order = np.lexsort((starts, bodies, keys, pairs[:, 1], pairs[:, 0]))
            pairs, keys, bodies, starts, ends = pairs[order], keys[order], bodies[order], starts[order], ends[order]
            later = np.zeros(len(keys), bool)
            later[1:] = (pairs[1:] == pairs[:-1]).all(1)
            # Entries known to be repeats go by their key, with an empty digest; equal rows repeat each other's entries.
            same = np.zeros(len(keys), bool)
            same[1:] = later[1:] & (keys[1:] == keys[:-1]) & (bodies[1:] == bodies[:-1]) & (starts[1:] == starts[:-1])
            first = np.maximum.accumulate(np.where(later, 0, np.arange(len(keys)))) if len(keys) else later
            same |= (keys == keys[first]) & (bodies == bodies[first]) & (starts == starts[first]) & later if len(keys) else later
            place = np.where(later, mix(keys.astype(np.int64).view(np.uint64)), pairs[:, 0])
            part = ((place >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            pairs = np.where(later[:, None], np.uint64(0), pairs)
            keep = ~same
            part, pairs, keys, bodies, starts, ends = part[keep], pairs[keep], keys[keep], bodies[keep], starts[keep], ends[keep]
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            some = np.flatnonzero(np.diff(edges))
            cols = [[], [], [], [], []]
            for p in some:
                own = order[edges[p] : edges[p + 1]]
                for column, values in zip(cols, (pairs, keys.astype(np.int64), bodies, starts.astype(np.uint32), ends.astype(np.uint32)), strict=True):
                    column.append(values[own].tobytes())
            yield batch_of(schema, some.astype(np.int32), *cols)

    def meet(group: pa.Table) -> pa.Table:
        read = lambda name, kind: np.frombuffer(b"".join(group.column(name).to_pylist()), kind)
        pairs, keys, bodies = read("digests", np.uint64).reshape(-1, 2), read("keys", np.int64), read("bodies", np.int64)
        starts, ends = read("starts", np.uint32).astype(np.int64), read("ends", np.uint32).astype(np.int64)
        known = (pairs == 0).all(1)
        order = np.lexsort((starts, bodies, keys, pairs[:, 1], pairs[:, 0]))
        same = np.zeros(len(keys), bool)
        same[order[1:]] = (pairs[order[1:]] == pairs[order[:-1]]).all(1)
        first = np.maximum.accumulate(np.where(same[order], 0, np.arange(len(order)))) if len(order) else order
        head = order[first]
        again = np.zeros(len(keys), bool)
        again[order] = same[order] & ((keys[order] != keys[head]) | (bodies[order] != bodies[head]) | (starts[order] != starts[head]))
        out = again | known
        return pa.table({"key": keys[out], "body": bodies[out], "start": starts[out], "end": ends[out]})

    packed = docs.mapInArrow(pack, "part int, digests binary, keys binary, bodies binary, starts binary, ends binary")
    return packed.groupBy("part").applyInArrow(meet, "key long, body long, start long, end long")


def drop_repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_bytes, spans (array of start and end byte, joined where they touch), text (what stays).

    A null text counts as empty and has no spans. Keys must be integers; equal rows
    are one text to this operator, other rows of one key are texts of their own, and rows with a null key are kept whole. Other columns aren't read; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    docs = only(docs, key, text).toDF("key", "text").withColumn("key", F.col("key").cast("long"))
    docs = docs.withColumn("body", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gone = repeated_chunks(docs.filter("key is not null"), parts).distinct()
    gone = gone.groupBy("key", "body").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    met = docs.join(gone, ["key", "body"], "left")
    schema = "key long, n_bytes long, spans array<struct<start:long,end:long>>, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(iter([batch])):
                sizes, spans, kept = [], [], []
                for body, gone in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                    raw, joined, rest, at = (body or "").encode(), [], [], 0
                    for s in gone or []:
                        if joined and s["start"] <= joined[-1]["end"]:
                            joined[-1]["end"] = max(joined[-1]["end"], s["end"])
                        else:
                            joined.append(dict(s))
                    for s in joined:
                        rest.append(raw[at : s["start"]])
                        at = s["end"]
                    sizes.append(len(raw))
                    spans.append(joined)
                    kept.append(b"".join([*rest, raw[at:]]).decode())
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("key"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())],
                    ["key", "n_bytes", "spans", "text"],
                )

    return met.select("key", "text", "spans").mapInArrow(run, schema).toDF(key, "n_bytes", "spans", "text")
