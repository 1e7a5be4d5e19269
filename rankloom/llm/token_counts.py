"""Token counts by rank-synchronous merging of ragged numpy arrays.

The pre-tokens a batch brings that are not yet known are held as one flat array of symbols
plus the row each symbol belongs to.  Each round looks up the rank of every neighbouring
pair, takes each row's lowest rank, and applies that pair at all its places in all rows at
once (of overlapping places, as in ``aaa``, the left ones).  Rows with no pair left are
done; the count of a pre-token is the number of its symbols that survive.

Defined results: a null text has 0 bytes and 0 tokens; a special string inside a text is one
token; equal rows give equal counts; further columns of the input are kept off.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame

from rankloom.llm.common import slices
from rankloom.llm.vocabulary import Vocabulary, load, read

LIMIT = 512                # tokens; a document above it is over the limit
CACHE_WORDS = 1_000_000    # counts of pre-tokens a worker remembers before it starts afresh
SLICE_BYTES = 4 << 20      # text worked on at once
NONE = np.int64(1) << 40   # the rank of a pair that never merges


class PairTable:
    """Ranks of pairs in an open hash table, read with whole arrays."""

    def __init__(self, voc: Vocabulary):
        self.bits = max(4, int(len(voc.merged) * 8).bit_length())
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.rank = np.full(len(self.keys), NONE, np.int64)
        keys = (voc.left << 32) | voc.right
        left, at, self.reach = np.arange(len(keys)), self._slot(keys), 0
        while len(left):        # each round places one key in each free slot that is asked for
            free = self.keys[at[left]] < 0
            _, first = np.unique(at[left][free], return_index=True)
            put = left[free][first]
            self.keys[at[put]], self.rank[at[put]] = keys[put], put
            left = np.setdiff1d(left, put)
            at[left] += 1
            self.reach += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.rank[at], NONE)
        more = np.flatnonzero((out == NONE) & (self.keys[at] >= 0))
        for _ in range(self.reach):
            if not len(more):
                break
            at[more] += 1
            hit = self.keys[at[more]]
            found = hit == keys[more]
            out[more[found]] = self.rank[at[more[found]]]
            more = more[~found & (hit >= 0)]
        return out


def count_merged(pieces: list[bytes], voc: Vocabulary, table: PairTable) -> np.ndarray:
    """Symbols left of each piece when no more pair merges."""
    counts = np.array([len(p) for p in pieces], np.int64)
    sym = voc.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    row = np.repeat(np.arange(len(pieces)), counts)
    while len(sym) > 1:
        rank = table.lookup(sym[:-1], sym[1:])
        rank[row[:-1] != row[1:]] = NONE
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        lowest = np.minimum.reduceat(np.r_[rank, NONE], starts)
        size = np.diff(np.r_[starts, len(row)])
        least = np.repeat(lowest, size)
        here = np.flatnonzero((rank == least[:-1]) & (rank < NONE))
        if not len(here):
            break
        # of neighbouring places of one pair take the first, third, ...
        run = np.flatnonzero(np.r_[True, np.diff(here) != 1])
        nth = np.arange(len(here)) - np.repeat(run, np.diff(np.r_[run, len(here)]))
        here = here[nth % 2 == 0]
        sym[here] = voc.merged[rank[here]]
        np.subtract.at(counts, row[here], 1)
        keep = least < NONE             # rows with nothing left to merge are done
        keep[here + 1] = False
        sym, row = sym[keep], row[keep]
    return counts


class Counter:
    def __init__(self, raw: bytes):
        self.voc = load(raw)
        self.table = PairTable(self.voc)
        self.known: dict[str, int] = dict.fromkeys(self.voc.special, 1)

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > CACHE_WORDS:
            self.known = dict.fromkeys(self.voc.special, 1)
        rows = [self.voc.pretokens(t) for t in texts]
        new = list(set().union(*rows).difference(self.known))
        if new:
            counts = count_merged([p.encode() for p in new], self.voc, self.table)
            self.known.update(zip(new, counts.tolist()))
        known = self.known.__getitem__
        return [sum(map(known, r)) for r in rows]


@functools.lru_cache(maxsize=2)
def counter(raw: bytes) -> Counter:
    return Counter(raw)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for every row."""
    raw = docs.sparkSession.sparkContext.broadcast(read(path))

    def run(batches):
        c = counter(raw.value)
        for batch in batches:
            col = batch.column(text)
            sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
            for a, b in slices(sizes, SLICE_BYTES):
                n = c.count([t or "" for t in col.slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(a, b - a), pa.array(sizes[a:b], pa.int64()),
                     pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    [key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
