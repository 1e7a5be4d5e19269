"""Exact substring dedup over the whole corpus, by prefix-free parsing.

Every start of a ``length``-byte string is assigned the place of the smallest 8-byte rolling
hash among its first ``WINDOW`` places (the trigger).  Consecutive starts with one trigger
form a phrase; equal text parses alike, whatever surrounds it.  A phrase's dictionary entry
is the text from its first start to the end of its last string; its core is the part right
of the trigger that all strings which could ever have this trigger contain.

1. Tasks parse their documents and combine what they have: of each entry only the earliest
   place (the parse's first reference to it) is handed on, packed, to the bucket of its core.
   A core with several entries in one task is handed on once, as such.
2. A bucket sorts its cores and entries - the suffixes of the dictionary in the order of a
   suffix array, as far as the strings reach.  Later places of an entry are copies.  If no
   other entry has the core, no other string equals those of the first place: all fresh.
   Otherwise the strings of the entry's first place have to be compared one by one.
3. Documents (in blocks, with what the buckets found) hash the strings to compare; these are
   sorted by bucket of the hash, and each string's earliest place is fresh.
4. A start that is not fresh is a copy of an earlier string: the bytes it covers go.

Only the earliest place of each core, entry or string leaves a task, so text that a third of
all documents share costs one row per task, and no group of equal strings meets anywhere.
Hashes of strings have 64 bits and 32 further bits beside the sorted ones; those of entries
64 beside their core's.

Defined results: a null text counts as empty, and texts shorter than ``length`` keep all
bytes; a null key orders before all others; equal rows (same key and text) are one document
and each gets its result; further columns of the input are not read.  A key stands for one
text; the key has to be an integer.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import slices, stash
from rankloom.llm.packing import pack, spread, unpack_all, unzipped, zipped
from rankloom.llm.vocabulary import ragged
from rankloom.llm.words import BASE, join, mix, powers

LENGTH = 100               # bytes of a string
WINDOW = 56                # places a string's trigger is chosen from
GRAM = 8                   # bytes of the rolling hash
BLOCK_BYTES = 16 << 20     # text of one block of documents
SLICE_BYTES = 4 << 20      # text parsed at once, in chunks:
CHUNK = 1 << 19
FLUSH = 1_500_000          # phrases a task holds before it hands them on
SPARE_BITS = 12            # hash bits for sorting beyond those that count the corpus
NULL_KEY = -(1 << 63)

FRESH, CHECK = 0, 1                    # what is known of the strings of a range of starts
PLAIN, SEVERAL = 0, 1                  # a core's entry; a core with several entries
ENTRY = (np.uint64, np.uint64, np.int64, np.int64, np.uint8, np.uint8)
RANGE = (np.int64, np.int64, np.uint8, np.uint8)
STRING = (np.uint64, np.uint32, np.int64, np.int64)

INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BASE2 = np.uint64(0xD1342543DE82EF95)
INVERSE2 = np.uint64(pow(int(BASE2), -1, 1 << 64))


class Hashes:
    """Hashes of all strings in a chunk of bytes, from prefix sums over its 8-byte grams."""

    def __init__(self, part: np.ndarray):
        n = len(part) - GRAM + 1
        self.gram = mix(np.ndarray((n,), "<u8", np.ascontiguousarray(part), strides=(1,)))

    @staticmethod
    def sums(gram, base) -> np.ndarray:
        return np.concatenate([[np.uint64(0)], np.cumsum(gram * powers(len(gram), base))])

    def of(self, sums, inverse, at: np.ndarray, length: int) -> np.ndarray:
        return (sums[at + (length - GRAM + 1)] - sums[at]) * powers(len(sums), inverse)[at]


def _chunks(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator:
    """(offset, bytes, starts in them) covering all starts in [begin, end) of each text."""
    starts = np.zeros(len(buf) + 1, np.int8)
    some = begin < end
    starts[begin[some]] += 1
    starts[end[some]] -= 1
    valid = np.cumsum(starts[:-1], dtype=np.int8) > 0
    for at in range(0, len(buf), CHUNK):
        inside = np.flatnonzero(valid[at:at + CHUNK])
        if len(inside):
            yield at, buf[at:at + CHUNK + 2 * LENGTH], inside


def parse(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int = LENGTH):
    """(core, entry, first start, number of starts) of the phrases."""
    core_size, out = length + 1 - WINDOW, []
    for at, part, inside in _chunks(buf, begin, end):
        h = Hashes(part)
        low = (h.gram & np.uint64(0xFFFFFFFF_00000000)) | np.arange(len(h.gram), dtype=np.uint64)
        width = 1
        while width < WINDOW:
            step = min(width, WINDOW - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        trigger = (low[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (np.diff(trigger) != 0) | (np.diff(inside) != 1)])
        size = np.diff(np.r_[new, len(inside)])
        first, last = inside[new], inside[new] + size - 1
        sums = h.sums(h.gram, BASE)
        core = mix(h.of(sums, INVERSE, trigger[new], core_size))
        entry = mix(h.of(sums, INVERSE, first, length) * np.uint64(3) + size.astype(np.uint64)
                    + mix(h.of(sums, INVERSE, last, length)))
        out.append((core, entry, first + at, size.astype(np.uint8)))
    if not out:
        return [np.zeros(0, k) for k in (np.uint64, np.uint64, np.int64, np.uint8)]
    return [np.concatenate(c) for c in zip(*out)]


def earliest(key: np.ndarray, more: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of each (key, more) the row with the smallest (doc, start), in order of key, more."""
    o = np.argsort(key, kind="stable")
    k = key[o]
    same = k[1:] == k[:-1]
    in_run = np.r_[False, same] | np.r_[same, False] if len(k) else np.zeros(0, bool)
    if in_run.any():
        sub = o[in_run]
        sub = sub[np.lexsort((start[sub], doc[sub], more[sub], key[sub]))]
        o[in_run] = sub
        keep = np.ones(len(o), bool)
        keep[in_run] = np.r_[True, (key[sub][1:] != key[sub][:-1])
                             | (more[sub][1:] != more[sub][:-1])]
        o = o[keep]
    return o


def _several(key: np.ndarray) -> np.ndarray:
    """Rows of a sorted key that are not alone."""
    same = key[1:] == key[:-1]
    return np.r_[False, same] | np.r_[same, False] if len(key) else np.zeros(0, bool)


def _cut(key: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the hash range begins in sorted hashes."""
    edges = [(b << 64) // parts for b in range(parts)]
    return np.r_[np.searchsorted(key, np.array(edges, np.uint64)), len(key)]


def _by_part(key: np.ndarray, parts: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Packed rows of the columns (the sorted key's differences first) for each part."""
    at = _cut(key, parts)
    for b in np.flatnonzero(np.diff(at)).tolist():
        s = slice(at[b], at[b + 1])
        yield b, pack(np.diff(key[s], prepend=np.uint64(0)), *(c[s] for c in columns))


def _by_block(blocks: int, doc, start, size, kind) -> Iterator[tuple[int, bytes]]:
    block = spread(doc, blocks)
    o = np.lexsort((start, doc, block))
    block, doc, start, size, kind = block[o], doc[o], start[o], size[o], kind[o]
    new = np.flatnonzero(np.r_[True, np.diff(block) != 0]) if len(block) else block
    for a, b in zip(new.tolist(), [*new[1:].tolist(), len(block)]):
        yield int(block[a]), pack(np.diff(doc[a:b], prepend=0), start[a:b], size[a:b],
                                  kind[a:b])


def _ranges(rows: list[bytes]):
    """doc, start, size and kind of packed ranges, sorted by doc."""
    parts = [unpack_all([r], *RANGE) for r in rows]
    doc = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(p[0]) for p in parts)])
    cols = [np.concatenate([np.zeros(0, RANGE[i]), *(p[i] for p in parts)]) for i in (1, 2, 3)]
    o = np.argsort(doc, kind="stable")
    return doc[o], *(c[o] for c in cols)


def _keys(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pa.compute.fill_null(column.cast(pa.int64()), NULL_KEY).to_numpy(zero_copy_only=False)


class _Batch:
    """Texts of one slice of a block, with the ranges known for them."""

    def __init__(self, keys, texts, ranges, length):
        self.keys, self.texts = keys, texts
        self.buf, self.first = join(texts)
        doc, start, size, kind = ranges
        low, high = np.searchsorted(doc, keys), np.searchsorted(doc, keys, "right")
        mine = ragged(low, high - low)
        self.row = np.repeat(np.arange(len(keys)), high - low)
        self.start, self.size, self.kind = start[mine], size[mine].astype(np.int64), kind[mine]
        self.strings = np.maximum(np.array([len(t) for t in texts], np.int64) - length + 1, 0)
        # a range may lie beyond a text's end only if its key has texts of several lengths
        self.size = np.minimum(self.size, np.maximum(self.strings[self.row] - self.start, 0))

    def places(self, kind: int) -> np.ndarray:
        """Starts in ``buf`` of the strings in ranges of a kind."""
        pick = self.kind == kind
        return ragged(self.first[self.row[pick]] + self.start[pick], self.size[pick])


def _batches(table: pa.Table, ranges, length: int) -> Iterator[tuple[int, int, _Batch]]:
    keys = _keys(table.column("k"))
    texts = [unzipped(z) for z in table.column("z").to_pylist()]
    for a, b in slices([len(t) for t in texts], SLICE_BYTES):
        yield a, b, _Batch(keys[a:b], texts[a:b], ranges, length)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256[, kept]) for every row: what stays of its
    text without the bytes of strings that occur earlier; ``kept`` as binary."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 math.ceil(total / BLOCK_BYTES))
    # sorted hashes are cut to what tells most of the corpus's strings apart
    mask = np.uint64(~((1 << max(0, 64 - SPARE_BITS - max(1, int(total)).bit_length())) - 1)
                     & 0xFFFFFFFF_FFFFFFFF)
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))

    def hand_on(held):
        """A task's phrases: entries by bucket of the core, and ranges to compare."""
        core, entry, start, size, doc = (np.concatenate(c) for c in zip(*held))
        o = earliest(core, entry, doc, start)
        core, entry, start, size, doc = core[o], entry[o], start[o], size[o], doc[o]
        several = _several(core)
        flag = np.where(several, SEVERAL, PLAIN).astype(np.uint8)
        once = ~several | np.r_[True, core[1:] != core[:-1]]
        rows = [(b, "entries", data) for b, data in _by_part(
            core[once], blocks, entry[once], doc[once], start[once], size[once], flag[once])]
        check = np.full(int(several.sum()), CHECK, np.uint8)
        return rows + [(b, "ranges", data) for b, data in _by_block(
            blocks, doc[several], start[several], size[several], check)]

    def as_batches(rows):
        for i in range(0, len(rows), 2000):
            part = rows[i:i + 2000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int32()),
                 pa.array([r[1] for r in part], pa.string()),
                 pa.array([r[2] for r in part], pa.binary())], ["part", "what", "data"])

    def phrases(batches):
        held, n = [], 0
        for batch in batches:
            keys, col = _keys(batch.column("k")), batch.column("t")
            sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
            for a, b in slices(sizes, SLICE_BYTES):
                buf, first = join([(t or "").encode() for t in col.slice(a, b - a).to_pylist()])
                core, entry, start, size = parse(buf, first[:-1], first[1:] - length, length)
                row = np.searchsorted(first, start, "right") - 1
                held.append((core & mask, entry, start - first[row], size, keys[a:b][row]))
                n += len(core)
                if n > FLUSH:
                    yield from as_batches(hand_on(held))
                    held, n = [], 0
        if n:
            yield from as_batches(hand_on(held))

    def resolve(table: pa.Table) -> pa.Table:
        what, data = table.column("what").to_pylist(), table.column("data").to_pylist()
        part = table.column("part")[0].as_py()
        out = [(part, d) for w, d in zip(what, data) if w == "ranges"]
        parts = [unpack_all([d], *ENTRY) for w, d in zip(what, data) if w == "entries"]
        if parts:
            core = np.concatenate([np.cumsum(p[0]) for p in parts])
            entry, doc, start, size, flag = (np.concatenate([p[i] for p in parts])
                                             for i in range(1, 6))
            shared = np.unique(core[flag == SEVERAL])
            o = np.flatnonzero(flag == PLAIN)
            o = o[earliest(core[o], entry[o], doc[o], start[o])]
            several = _several(core[o]) | np.isin(core[o], shared)
            out += _by_block(blocks, doc[o], start[o], size[o],
                             np.where(several, CHECK, FRESH).astype(np.uint8))
        return pa.table({"block": pa.array([b for b, _ in out], pa.int32()),
                         "ranges": pa.array([d for _, d in out], pa.binary())})

    def compare(table: pa.Table, known: pa.Table) -> pa.Table:
        ranges = _ranges(known.column("ranges").to_pylist())
        held = [[np.zeros(0, k) for k in STRING]]
        for _, _, b in _batches(table, ranges, length):
            places = b.places(CHECK)
            wanted = np.zeros(len(b.buf) + 1, bool)
            wanted[places] = True
            for at in range(0, len(b.buf), CHUNK):
                here = np.flatnonzero(wanted[at:at + CHUNK])
                if not len(here):
                    continue
                h = Hashes(b.buf[at:at + CHUNK + length])
                one = mix(h.of(h.sums(h.gram, BASE), INVERSE, here, length)) & mask
                two = mix(h.of(h.sums(h.gram, BASE2), INVERSE2, here, length))
                row = np.searchsorted(b.first, here + at, "right") - 1
                held.append([one, (two >> np.uint64(32)).astype(np.uint32), b.keys[row],
                             here + at - b.first[row]])
        one, two, doc, start = (np.concatenate(c) for c in zip(*held))
        o = earliest(one, two, doc, start)
        out = list(_by_part(one[o], blocks, two[o], doc[o], start[o]))
        return pa.table({"part": pa.array([p for p, _ in out], pa.int32()),
                         "data": pa.array([d for _, d in out], pa.binary())})

    def choose(table: pa.Table) -> pa.Table:
        parts = [unpack_all([d], *STRING) for d in table.column("data").to_pylist()]
        one = np.concatenate([np.cumsum(p[0]) for p in parts])
        two, doc, start = (np.concatenate([p[i] for p in parts]) for i in range(1, 4))
        o = earliest(one, two, doc, start)
        ones = np.ones(len(o), np.uint8)
        out = list(_by_block(blocks, doc[o], start[o], ones, ones * np.uint8(FRESH)))
        return pa.table({"block": pa.array([b for b, _ in out], pa.int32()),
                         "ranges": pa.array([d for _, d in out], pa.binary())})

    def finish(table: pa.Table, known: pa.Table) -> pa.Table:
        ranges, rows = _ranges(known.column("ranges").to_pylist()), []
        for a, e, b in _batches(table, ranges, length):
            change = np.zeros(len(b.buf) + 1, np.int32)
            some = b.strings > 0
            change[b.first[:-1][some]] += 1                     # every start of a string ...
            change[(b.first[:-1] + b.strings)[some]] -= 1
            copy = np.cumsum(change[:-1]) > 0
            copy[b.places(FRESH)] = False                       # ... that is not fresh
            change = np.zeros(len(b.buf) + 1, np.int32)
            edge = np.diff(np.r_[False, copy, False].astype(np.int8))
            change[np.flatnonzero(edge == 1)] += 1
            change[np.flatnonzero(edge == -1) + length - 1] -= 1
            gone = np.cumsum(change[:-1]) > 0
            opens = gone & ~np.r_[False, gone[:-1]]
            n_gone = np.add.reduceat(np.r_[gone, False].astype(np.int64), b.first[:-1])
            n_open = np.add.reduceat(np.r_[opens, False].astype(np.int64), b.first[:-1])
            for i, t in enumerate(b.texts):
                kept = t
                if n_gone[i]:
                    s = b.first[i]
                    kept = b.buf[s:s + len(t)][~gone[s:s + len(t)]].tobytes()
                rows.append((len(t), int(n_gone[i]), int(n_open[i]),
                             hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*rows)) if rows else [()] * 5
        out = {"k": table.column("k"), "n_bytes": pa.array(cols[0], pa.int64()),
               "n_removed": pa.array(cols[1], pa.int64()),
               "n_spans": pa.array(cols[2], pa.int64()),
               "kept_sha256": pa.array(cols[3], pa.string())}
        return pa.table(out | ({"kept": pa.array(cols[4], pa.binary())} if with_text else {}))

    def pack_texts(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(spread(_keys(batch.column("k")), blocks), pa.int32()),
                 batch.column("k"),
                 pa.array([zipped((t or "").encode()) for t in batch.column("t").to_pylist()],
                          pa.binary())], ["block", "k", "z"])

    range_type = "block int, ranges binary"
    known = stash(source.mapInArrow(phrases, "part int, what string, data binary")
                  .groupBy("part").applyInArrow(resolve, range_type), "repeats-ranges")
    packed = source.mapInArrow(pack_texts, f"block int, k {kind}, z binary")
    strings = (packed.groupBy("block").cogroup(known.groupBy("block"))
               .applyInArrow(compare, "part int, data binary")
               .groupBy("part").applyInArrow(choose, range_type))
    out = packed.groupBy("block").cogroup(known.unionByName(strings).groupBy("block"))
    result = out.applyInArrow(
        finish, f"k {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                + (", kept binary" if with_text else ""))
    return result.withColumnRenamed("k", key)
