"""Benchmark decontamination: an FM-index per training shard.

A shard is a slice of documents inside a task.  Words that no benchmark item has cannot be
part of a hit, so the shard's word sequence is cut there and only runs at least as long as
the shortest window are indexed, with a separator of its own after each run.  The runs'
suffix array gives the Burrows-Wheeler transform, kept as a wavelet matrix with counted
ranks; the suffix array itself is kept only at sampled positions.  All windows are searched
backward together, last word first; the occurrences of the found ones are located by
walking to the next sampled position, and the words they cover are merged into spans.

The benchmark is split into blocks of at most ``BLOCK_BYTES`` of text, each collected and
broadcast; every shard is searched for all blocks one after another, so a benchmark of any
size is searched whole, with one block in memory at a time.

Defined results: null and empty texts have no words; a null item id is the text ``null``;
items with the same id are one item; items without words are never found; equal rows give
equal results; an empty benchmark hits nothing.  ``clean`` keeps all columns and rows of its
input, also under names used here.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import slices
from rankloom.llm.vocabulary import ragged
from rankloom.llm.words import ALPHANUMERIC, Words, find_words

WINDOW = 10
BLOCK_BYTES = 4 << 20      # benchmark text in one broadcast
SHARD_BYTES = 4 << 20      # document text under one index
SAMPLE = 16                # every so many positions of a run keep their suffix position


class Patterns:
    """The windows of a block of items: as word numbers, and the items each belongs to."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.names = sorted({i for i, _ in items})
        name_of = {n: k for k, n in enumerate(self.names)}
        words = find_words([t.encode() for _, t in items], ALPHANUMERIC)
        self.vocabulary = np.unique(words.hash)
        number = np.searchsorted(self.vocabulary, words.hash) + 1
        begin = np.searchsorted(words.doc, np.arange(len(items) + 1))
        found: dict[tuple[int, ...], set[int]] = {}
        for k, (item, _) in enumerate(items):
            seq = tuple(number[begin[k]:begin[k + 1]].tolist())
            for i in range(max(1, len(seq) - window + 1) if seq else 0):
                found.setdefault(seq[i:i + window], set()).add(name_of[item])
        self.size = np.array([len(p) for p in found], np.int64)
        self.word = np.zeros((len(found), window), np.int64)   # from the last word to the first
        for k, p in enumerate(found):
            self.word[k, :len(p)] = p[::-1]
        self.owners = np.array([i for s in found.values() for i in sorted(s)], np.int64)
        self.owned = np.array([len(s) for s in found.values()], np.int64)
        self.own_at = np.cumsum(self.owned) - self.owned


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence whose separators are all different (prefix
    doubling; the end sorts first)."""
    n, step = len(ranks), 1
    _, rank = np.unique(ranks, return_inverse=True)
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank.astype(np.int64) * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= n:
            return order


class WaveletMatrix:
    """Ranks and symbols of a sequence, by one bit per level, for whole arrays of queries."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int64))
            self.zeros.append(len(seq) - int(bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        low, at = np.zeros_like(upto), upto
        for k in range(self.bits):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            ones = self.ones[k]
            low = np.where(one, self.zeros[k] + ones[low], low - ones[low])
            at = np.where(one, self.zeros[k] + ones[at], at - ones[at])
        return at - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for k in range(self.bits):
            ones = self.ones[k]
            bit = ones[at + 1] - ones[at]
            out = out * 2 + bit
            at = np.where(bit == 1, self.zeros[k] + ones[at], at - ones[at])
        return out


class FMIndex:
    """Of a sequence of word numbers, 0 between runs (and at the end)."""

    def __init__(self, seq: np.ndarray):
        separators = np.flatnonzero(seq == 0)
        ranks = seq + len(separators)
        ranks[separators] = np.arange(len(separators))     # all different
        order = suffix_array(ranks)
        bwt = seq[order - 1]
        self.bits = max(1, int(seq.max()).bit_length())
        self.wavelet = WaveletMatrix(bwt, self.bits)
        counts = np.bincount(seq, minlength=(1 << self.bits) + 1)
        self.below = np.cumsum(counts) - counts
        # keep the position of a suffix at every SAMPLE-th place and where a run begins, so
        # that no walk leaves its run
        kept = (order % SAMPLE == 0) | (bwt == 0)
        self.sampled_before = np.r_[0, np.cumsum(kept)].astype(np.int64)
        self.positions = order[kept]
        self.n = len(seq)

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.below[symbol] + self.wavelet.rank(symbol, at)

    def search(self, patterns: Patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, low, high) of the patterns that occur: their rows in suffix order."""
        which = np.arange(len(patterns.size))
        known = patterns.word.max(1, initial=0) < len(self.below) - 1
        which = which[known]
        low, high = np.zeros(len(which), np.int64), np.full(len(which), self.n)
        for i in range(patterns.word.shape[1]):
            go = patterns.size[which] > i
            symbol = patterns.word[which[go], i]
            low[go], high[go] = self._step(symbol, low[go]), self._step(symbol, high[go])
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of suffixes given by their rows."""
        out, walked = np.full(len(rows), -1), 0
        left, at = np.arange(len(rows)), rows.copy()
        while len(left):
            here = self.sampled_before[at]
            kept = self.sampled_before[at + 1] > here
            out[left[kept]] = self.positions[here[kept]] + walked
            left, at = left[~kept], at[~kept]
            if len(left):
                at = self._step(self.wavelet.symbol(at), at)
            walked += 1
        return out


def _runs(number: np.ndarray, doc: np.ndarray, least: int):
    """The indexed sequence and, for each of its places, the word it stands for (-1 for a
    separator): runs of benchmark words inside one document, at least ``least`` long."""
    inside = number > 0
    edge = np.r_[True, (~inside[1:]) | (~inside[:-1]) | (doc[1:] != doc[:-1])] if len(number) \
        else np.zeros(0, bool)
    begin = np.flatnonzero(edge)
    size = np.diff(np.r_[begin, len(number)])
    good = inside[begin] & (size >= least)
    begin, size = begin[good], size[good]
    if not len(begin):
        return None, None
    word = np.full(int(size.sum()) + len(size), -1, np.int64)
    at = np.cumsum(size + 1) - size - 1
    word[ragged(at, size)] = ragged(begin, size)
    seq = np.where(word >= 0, number[word], 0)
    return seq, word


def hits(words: Words, patterns: Patterns, n_docs: int):
    """(bool per word: covered by an occurrence; (text, item) pairs that occur)."""
    none = np.zeros(0, np.int64)
    covered = np.zeros(len(words.start), bool)
    if not len(patterns.size) or not len(words.start):
        return covered, none, none
    at = np.minimum(np.searchsorted(patterns.vocabulary, words.hash),
                    len(patterns.vocabulary) - 1)
    number = np.where(patterns.vocabulary[at] == words.hash, at + 1, 0)
    seq, word = _runs(number, words.doc, int(patterns.size.min()))
    if seq is None:
        return covered, none, none
    index = FMIndex(seq)
    which, low, high = index.search(patterns)
    rows = ragged(low, high - low)
    if not len(rows):
        return covered, none, none
    which = np.repeat(which, high - low)
    begin = word[index.locate(rows)]
    change = np.zeros(len(covered) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.subtract.at(change, begin + patterns.size[which], 1)
    covered = np.cumsum(change)[:-1] > 0
    pair = np.unique(words.doc[begin] * len(patterns.size) + which)
    doc, which = pair // len(patterns.size), pair % len(patterns.size)
    items = patterns.owners[ragged(patterns.own_at[which], patterns.owned[which])]
    pair = np.unique(np.repeat(doc, patterns.owned[which]) * len(patterns.names) + items)
    return covered, pair // len(patterns.names), pair % len(patterns.names)


def ship(benchmark: DataFrame, item: str = "item_id", text: str = "text",
         window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcasts of the benchmark's blocks."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"),
                            F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    spark = benchmark.sparkSession
    return [spark.sparkContext.broadcast(
        (window, [(r.item, r.text) for r in rows.filter(
            F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()]))
        for b in range(blocks)]


class Searcher:
    def __init__(self, blocks: list):
        self.blocks = blocks
        self.one = Patterns(blocks[0].value[1], blocks[0].value[0]) if len(blocks) == 1 else None

    def patterns(self):
        if self.one is not None:
            yield self.one
            return
        for b in self.blocks:
            window, items = b.value
            yield Patterns(items, window)

    def search(self, texts: list[str | None]):
        """Words, covered flags, and the item names each text has."""
        words = find_words([(t or "").encode() for t in texts], ALPHANUMERIC)
        covered, names = np.zeros(len(words.start), bool), [[] for _ in texts]
        for p in self.patterns():
            c, docs, items = hits(words, p, len(texts))
            covered |= c
            for d, i in zip(docs.tolist(), items.tolist()):
                names[d].append(p.names[i])
        return words, covered, names


def _shards(batch: pa.RecordBatch, place: int):
    col = batch.column(place)
    sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
    for a, b in slices(sizes, SHARD_BYTES):
        yield a, b, col.slice(a, b - a).to_pylist()


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id",
                  text: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) for every row."""
    blocks = ship(benchmark, window=window)

    def run(batches):
        searcher = Searcher(blocks)
        for batch in batches:
            for a, b, texts in _shards(batch, 1):
                words, covered, names = searcher.search(texts)
                n_words = np.bincount(words.doc, minlength=b - a)
                n_hit = np.bincount(words.doc[covered], minlength=b - a)
                sha = [hashlib.sha256(",".join(sorted(n)).encode()).hexdigest() for n in names]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n_words, pa.int64()),
                     pa.array(n_hit, pa.int64()), pa.array([len(n) for n in names], pa.int64()),
                     pa.array(sha), pa.array(n_hit > 0, pa.bool_())],
                    [key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_words long, n_hit long, n_items long, items_sha256 string, "
             "contaminated boolean")


def _without(words: Words, covered: np.ndarray, texts: list[str | None]) -> list[str | None]:
    """The texts without the spans of covered words (from the first word's begin to the last
    word's end; what stands between covered words goes, too)."""
    out = list(texts)
    joined = np.r_[False, covered[1:] & covered[:-1] & (words.doc[1:] == words.doc[:-1])] \
        if len(covered) else covered
    first = np.flatnonzero(covered & ~joined)
    last = np.flatnonzero(covered & ~np.r_[joined[1:], False]) if len(covered) else first
    raw = words.buf.tobytes() if len(first) else b""
    for d in np.unique(words.doc[first]).tolist():
        mine = words.doc[first] == d
        kept, at = [], int(words.first[d])
        for s, e in zip(words.start[first[mine]].tolist(), words.end[last[mine]].tolist()):
            kept.append(raw[at:s])
            at = e
        kept.append(raw[at:int(words.first[d + 1]) - 1])
        out[d] = b"".join(kept).decode()
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text",
          window: int = WINDOW) -> DataFrame:
    """The same rows and columns with the spans of occurring windows removed from the text."""
    blocks, place = ship(benchmark, window=window), docs.columns.index(text)

    def run(batches):
        searcher = Searcher(blocks)
        for batch in batches:
            for a, b, texts in _shards(batch, place):
                words, covered, _ = searcher.search(texts)
                new = pa.array(_without(words, covered, texts), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [new if i == place else c.slice(a, b - a)
                     for i, c in enumerate(batch.columns)], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
