"""Packing token pieces into sequences: best fit, then a local search that swaps pieces between underfull sequences.

Pieces are dealt at random over groups of about ``GROUP`` pieces, each packed in one task. Sequences that are nearly
full stay; the pieces of the others are dealt anew, over fewer groups, until one group is left. The local search moves
a piece, or exchanges one for one or two for one, whenever that raises the sum of squared fills; a sequence whose pieces
have all moved is gone.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.text import BLOCK, batch_of, blocks, bounded_batches, flat, only, span_hashes, word_spans
from gridcast.sources.tables import cut

GROUP = 20_000
NEIGHBOURS = 48
NEARLY_FULL = 0.995
CACHE_WORDS = 200_000


# How byte-level tokenizers write a byte: printable ones of Latin-1 as themselves, the others, in order, from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: chr(b) for b in _SHOWN} | {b: chr(0x100 + i) for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}


def _word_pattern(path: str) -> str | None:
    """The pattern by which the tokenizer cuts words, if it drops white space, maps bytes and lets no token span words."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if [s.get("type") for s in steps] != ["Split", "ByteLevel"] or steps[1].get("use_regex") or spec.get("post_processor"):
        return None
    lower = {"type": "Lowercase"} in (spec.get("normalizer") or {}).get("normalizers", [])
    split = steps[0]
    return split["pattern"].get("Regex") if split["behavior"] == "Removed" and split["invert"] and lower else None


class Encoder:
    """Token ids of whole texts. Words are looked up once for each block and kept in tables of bounded size.

    For a tokenizer that splits at white space, words of ASCII and of Western European letters are cut by the tokenizer's own
    pattern, and each cut is encoded once by its vocabulary; a word of letters alone is its own cut. All other words go
    through the whole tokenizer, and so do those of a tokenizer that treats such letters otherwise, which is tried out.
    """

    PLAIN = re.compile("[!-;=-~À-ÖØ-öø-ÿ]+")  # "<" may begin a special token
    PROBES = ("abc", "Qzx", "l'eau", "it's", "12ab-c", "é", "Été", "naïve", "straße", "ÀÖØöøÿ", "çñ'Þð12", "x=é;Ü")

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer, self.parts = Tokenizer.from_file(path), {}
        self._forget()
        pattern = _word_pattern(path)
        self.word_wise, self.cut = pattern is not None, pattern and regex.compile(pattern).findall
        self.model = self.tokenizer.model
        if self.word_wise:
            self.whole = all(self.cut(w) == [w] for w in ("a", "abc", "zq", "hello", "dont", "thell", "abcdefghijklmnopqrstuvwxyz"))
            self.western = True
            self.western = [self._cut_ids(w) for w in self.PROBES] == self.encode(list(self.PROBES))
            self.parts.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part_ids(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join([BYTE_LETTERS[b] for b in part.encode()])
            ids = self.parts[part] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
        return ids

    def _cut_ids(self, word: str) -> bytes:
        return b"".join([self._part_ids(part) for part in self.cut(word.lower())])

    def words(self, words: list[str]) -> list[bytes]:
        out: list = [None] * len(words)
        rest, parts, whole, western, plain = [], self.parts, self.whole, self.western, self.PLAIN.fullmatch
        for i, word in enumerate(words):
            ascii_ = word.isascii()
            if ascii_ and whole and word.isalpha():
                word = word.lower()
                out[i] = parts.get(word) or self._part_ids(word)
            elif (ascii_ or western) and plain(word):
                out[i] = self._cut_ids(word)
            else:
                rest.append(i)
        if len(parts) > CACHE_WORDS:
            parts.clear()
        for i, ids in zip(rest, self.encode([words[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def block(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's start."""
        data, offsets = flat(batch.column("text"))
        if not self.word_wise:
            ids = self.encode([x or "" for x in batch.column("text").to_pylist()])
            return np.frombuffer(b"".join(ids), "<u4"), np.cumsum([0, *(len(x) // 4 for x in ids)])
        starts, ends, before = word_spans(data, offsets)
        each, hashes = pd.factorize(span_hashes(data, starts, ends, fold=False))
        first = np.empty(len(hashes), np.int64)
        first[each[::-1]] = np.arange(len(each))[::-1]
        names = hashes.tolist()
        at = np.fromiter(map(self.known.get, names, itertools.repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(at < 0)
        if len(new):
            raw, spots = data.tobytes(), first[new]
            ids = self.words([raw[a:b].decode() for a, b in zip(starts[spots].tolist(), ends[spots].tolist(), strict=True)])
            at[new] = len(self.sizes) + np.arange(len(new))
            self._keep(hashes[new].tolist(), b"".join(ids), np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
        out, end = _gather(self.table, self.begins[at][each], self.sizes[at][each])
        if len(self.known) > CACHE_WORDS:  # words of this block are the likeliest to come again
            table, sizes = _gather(self.table, self.begins[at], self.sizes[at])[0], self.sizes[at]
            self._forget()
            self._keep(names, table.tobytes(), sizes)
        return out, np.concatenate([[0], end])[before]

    def _forget(self) -> None:
        """``known`` has each word's place in ``begins`` and ``sizes``, which say where its ids are in ``table``."""
        self.known: dict[int, int] = {}
        self.table, self.begins, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _keep(self, names: list[int], ids: bytes, sizes: np.ndarray) -> None:
        self.known.update(zip(names, range(len(self.sizes), len(self.sizes) + len(names)), strict=True))
        self.begins = np.concatenate([self.begins, len(self.table) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.table = np.concatenate([self.table, np.frombuffer(ids, "<u4")])


def _gather(table: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``table`` at all the ranges in a row, and where each range ends in the result."""
    end = np.cumsum(sizes)
    if not len(end) or not end[-1]:
        return table[:0], end
    return table[np.arange(end[-1]) + np.repeat(begins - (end - sizes), sizes)], end


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


def token_pieces(docs: DataFrame, key: str, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(key, piece, start, length, ids_crc32) of every text's ids and the end id, cut every ``capacity`` ids."""
    schema = pa.schema([("key", docs.schema["key"].dataType.typeName() == "string" and pa.string() or pa.int64()),
                        ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, limit=BLOCK // 2):
            ids, begin = encoder(tokenizer).block(b)
            rows: list[list] = [[], [], [], [], []]
            last = np.array([end_id], "<u4").tobytes()
            for i, k in enumerate(b.column("key").to_pylist()):
                own = ids[begin[i] : begin[i + 1]].tobytes() + last
                for p, at in enumerate(range(0, len(own), 4 * capacity)):
                    part = own[at : at + 4 * capacity]
                    for column, value in zip(rows, (k, p, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            yield batch_of(schema, *rows)

    return docs.mapInArrow(run, f"key {docs.schema['key'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins


def improve(bins: list[list[int]], lengths: list[int], capacity: int, neighbours: int = NEIGHBOURS) -> list[list[int]]:
    """Local search over underfull bins; each step takes tokens from a bin to one that is at least as full."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    open_ = [b for b in range(len(bins)) if fill[b] < capacity]
    moved = True
    while moved:
        moved = False
        open_ = sorted((b for b in open_ if 0 < fill[b] < capacity), key=lambda b: (fill[b], b))
        for place, a in enumerate(open_):
            # The receivers next in line, and those with the most room.
            near = open_[place + 1 : place + 1 + neighbours // 2] + open_[max(place + 1 + neighbours // 2, len(open_) - neighbours // 2) :]
            for b in near:
                if not bins[a] or fill[b] < fill[a]:
                    continue
                room, best = capacity - fill[b], (0, None, None)
                mine = [(lengths[x], (x,)) for x in bins[a]]
                if len(mine) > 1 and len(mine) <= 40:
                    mine += [(lengths[x] + lengths[y], (x, y)) for i, x in enumerate(bins[a]) for y in bins[a][i + 1 :]]
                theirs = [(0, ())] + [(lengths[y], (y,)) for y in bins[b]]
                for gives, out in mine:
                    if len(out) == 2 and gives > room + max(lengths[y] for y in bins[b]):
                        continue
                    for takes, back in theirs:
                        if best[0] < gives - takes <= room and (len(out) < 2 or back):
                            best = (gives - takes, out, back)
                    if best[0] == room:
                        break
                gain, out, back = best
                if gain > 0:
                    bins[a] = [x for x in bins[a] if x not in out] + list(back)
                    bins[b] = [y for y in bins[b] if y not in back] + list(out)
                    fill[a] -= gain
                    fill[b] += gain
                    moved = True
    return [b for b in bins if b]


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0,
         group: int = GROUP) -> DataFrame:
    """Each piece's place: key, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``; only documents longer than ``capacity`` are cut. A null or blank text is
    the end id alone. Repeated keys are packed as they come, each row as a document. Other columns aren't read; an empty
    table gives no rows. Sequences are gapless from offset 0.
    """
    bounded_batches(docs.sparkSession)
    docs = only(docs, key, text).toDF("key", "text")
    kind = docs.schema["key"].dataType.simpleString()
    pieces = cut(token_pieces(docs, "key", tokenizer, capacity, end_id))
    names = ["key", "piece", "start", "length", "ids_crc32"]
    full = pieces.filter(F.col("length") == capacity).select(
        *names, (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    todo, out, shift = pieces.filter(F.col("length") < capacity), [full], 1
    columns = f"key {kind}, piece int, start long, length long, ids_crc32 long, bin long, offset long, done boolean"

    def one(groups: int, last: bool):
        def run(table: pa.Table) -> pa.Table:
            group = table.column("g")[0].as_py()
            lengths = table.column("length").to_pylist()
            bins = improve(best_fit(lengths, capacity), lengths, capacity)
            rows, bin_, offset, done = [], [], [], []
            for n, b in enumerate(bins):
                keep = last or sum(lengths[i] for i in b) >= NEARLY_FULL * capacity
                at = 0
                for i in b:
                    rows.append(i)
                    bin_.append(n * groups + group)
                    offset.append(at)
                    done.append(keep)
                    at += lengths[i]
            got = table.select(names).take(pa.array(rows, pa.int64()))
            parts = (("bin", bin_, pa.int64()), ("offset", offset, pa.int64()), ("done", done, pa.bool_()))
            for name, values, type_ in parts:
                got = got.append_column(name, pa.array(values, type_))
            return got

        return run

    for round_ in range(4):
        n = todo.count()
        if not n:
            break
        groups = -(-n // group)
        last = groups == 1 or round_ == 3
        dealt = todo.withColumn("g", F.pmod(F.xxhash64("key", "piece", "start", F.lit(round_)), F.lit(groups)))
        packed = cut(dealt.groupBy("g").applyInArrow(one(groups, last), columns))
        # Odd ids are full pieces'; even ones count rounds, then groups and bins.
        out.append(packed.filter("done").select(*names, (F.col("bin") * 8 + 2 * shift - 2).alias("sequence_id"), "offset"))
        todo, shift = packed.filter("not done").select(*names), shift + 1
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole.withColumnRenamed("key", key)

