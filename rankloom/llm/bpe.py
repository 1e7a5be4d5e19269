"""BPE encoding by backtracking over longest matches, decoding by an offset table.

Encoding a pre-token: an Aho-Corasick automaton gives the longest token at every byte.
From left to right the longest token is tried that may stand next to the one before it;
if none may, the one before is given up for its next shorter prefix.  Two tokens may stand
next to each other when BPE, run on their bytes together, would merge nothing across
their border: undo the merges of both from the latest on, and see whether a pair across
the border would have been merged earlier.  Positions found to be dead ends are marked, so
each is left at most once and the work is linear in the bytes.

Decoding gathers bytes through the offsets of the ids, and reads them as UTF-8 with
replacement characters.

Defined results: a null text counts as empty (no ids); special strings inside a text give
their special id; equal rows give equal results; further columns of the input are kept off.
"""

from __future__ import annotations

import functools
import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame

from rankloom.llm.common import slices
from rankloom.llm.vocabulary import Vocabulary, load, ragged, read

CACHE_WORDS = 600_000      # pre-tokens a worker remembers before it starts afresh
CACHE_PAIRS = 1_000_000    # border checks it remembers
SLICE_BYTES = 4 << 20      # text worked on at once


class Encoder:
    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self.pairs = {(int(a), int(b)): k for k, (a, b) in
                      enumerate(zip(voc.left, voc.right))}
        # when a token comes into being: single bytes at once, merged ones by their merge
        self.born, self.parts = {}, {}
        for k, (a, b, m) in enumerate(zip(voc.left, voc.right, voc.merged)):
            self.born.setdefault(int(m), k)
            self.parts.setdefault(int(m), (int(a), int(b)))
        special = set(voc.special.values())
        plain = {t: i for i, t in enumerate(voc.tokens) if t and i not in special}
        self.automaton = ahocorasick.Automaton()
        for t, i in plain.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t), i))
        self.automaton.make_automaton()
        self.shorter = {}       # a token's longest proper prefix that is a token
        for t, i in plain.items():
            for n in range(len(t) - 1, 0, -1):
                if (p := plain.get(t[:n])) is not None:
                    self.shorter[i] = p
                    break
        self.sizes = voc.length.tolist()
        self.may: dict[tuple[int, int], bool] = {}

    def compatible(self, pair: tuple[int, int]) -> bool:
        """Does BPE leave the border between the two tokens alone?"""
        if len(self.may) >= CACHE_PAIRS:
            self.may.clear()
        known = self.may[pair] = self._border_holds(*pair)
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        # Going back in time: a and b are the tokens at the border just before merge `now`.
        # A pair across it is merged if its merge comes before either side is merged on
        # (on equal merges the left occurrence goes first).
        end = len(self.voc.merged)
        until_a = until_b = end      # merges that consume a resp. b inside their own token
        while True:
            k = self.pairs.get((a, b))
            if k is not None and k < until_a and k <= until_b:
                return False
            born_a, born_b = self.born.get(a, -1), self.born.get(b, -1)
            if born_a < 0 and born_b < 0:
                return True
            if born_a >= born_b:    # a was made last: before that its right part stood here
                until_a, a = born_a, self.parts[a][1]
            else:
                until_b, b = born_b, self.parts[b][0]

    def encode(self, piece: bytes) -> list[int]:
        word = piece.decode("latin-1")
        may, check = self.may.get, self.compatible
        # taking the longest token each time is right when all its borders hold
        out = [token for _, (_, token) in self.automaton.iter_long(word)]
        for pair in zip(out, out[1:]):
            if not (may(pair) if pair in self.may else check(pair)):
                return self._backtrack(word)
        return out

    def _backtrack(self, word: str) -> list[int]:
        n = len(word)
        longest, reach = [0] * n, [0] * n
        for end, (size, token) in self.automaton.iter(word):
            if size > reach[at := end - size + 1]:
                reach[at], longest[at] = size, token
        size_of, shorter_of, may = self.sizes, self.shorter.get, self.may.get
        open_at = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + size_of[token]
            if open_at[end]:
                holds = not out
                if out and (holds := may(pair := (out[-1], token))) is None:
                    holds = self.compatible(pair)
                if holds:
                    out.append(token)
                    at = end
                    if at < n:
                        token = longest[at]
                    continue
            token = shorter_of(token)
            while token is None:            # nothing fits here: give up the token before
                open_at[at] = 0
                before = out.pop()
                at -= size_of[before]
                token = shorter_of(before)
        return out


class Codec:
    """A worker's encoder with a bounded table of pre-tokens it has met."""

    def __init__(self, raw: bytes):
        self.voc = load(raw)
        self.encoder = Encoder(self.voc)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids: list[int] = []
        self.starts: list[int] = []
        self.counts: list[int] = []
        self.joined: list[str] = []

    def _add(self, piece: str) -> int:
        special = self.voc.special.get(piece)
        ids = [special] if special is not None else self.encoder.encode(piece.encode())
        self.starts.append(len(self.ids))
        self.counts.append(len(ids))
        self.ids += ids
        self.joined.append(",".join(map(str, ids)))
        i = self.index[piece] = len(self.starts) - 1
        return i

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """Ids of each text, and the same as decimal numbers joined by commas."""
        if len(self.index) > CACHE_WORDS:
            self.forget()
        get, add = self.index.get, self._add
        rows = []
        for text in texts:
            pieces = self.voc.pretokens(text)
            found = list(map(get, pieces))
            if None in found:
                for p in {p for i, p in zip(found, pieces) if i is None}:
                    add(p)
                found = list(map(get, pieces))
            rows.append(found)
        ids, starts = np.array(self.ids, np.int64), np.array(self.starts, np.int64)
        counts, joined = np.array(self.counts, np.int64), self.joined
        out = []
        for found in rows:
            at = np.array(found, np.int64)
            out.append(ids[ragged(starts[at], counts[at])] if len(at) else ids[:0])
        return out, [",".join([joined[i] for i in found]) for found in rows]

    def decode(self, ids: np.ndarray) -> str:
        voc = self.voc
        return voc.blob[ragged(voc.offset[ids], voc.length[ids])].tobytes().decode(
            "utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(raw: bytes) -> Codec:
    return Codec(raw)


def _texts(batch: pa.RecordBatch, text: str):
    col = batch.column(text)
    sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
    for a, b in slices(sizes, SLICE_BYTES):
        yield a, b, [t or "" for t in col.slice(a, b - a).to_pylist()]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>): the token ids of every text."""
    raw = docs.sparkSession.sparkContext.broadcast(read(path))

    def run(batches):
        c = codec(raw.value)
        for batch in batches:
            for a, b, texts in _texts(batch, text):
                ids, _ = c.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(a, b - a),
                     pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))],
                    [key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): the texts that arrays of ids stand for; null ids give an empty text."""
    raw = rows.sparkSession.sparkContext.broadcast(read(path))

    def run(batches):
        c = codec(raw.value)
        for batch in batches:
            texts = [c.decode(np.array(x or [], np.int64)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(texts, pa.string())], [key, "text"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
               with_ids: bool = False, release: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256[, ids]): digests of the ids and of what they
    decode to, in one pass.  ``release`` gives a worker's table of pre-tokens back when a task
    ends, for jobs of several steps."""
    raw = docs.sparkSession.sparkContext.broadcast(read(path))

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches):
        c = codec(raw.value)
        for batch in batches:
            for a, b, texts in _texts(batch, text):
                ids, joined = c.encode(texts)
                out = {key: batch.column(key).slice(a, b - a),
                       "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                       "ids_sha256": pa.array([sha(s.encode()) for s in joined]),
                       "decoded_sha256": pa.array([sha(c.decode(x).encode()) for x in ids])}
                if with_ids:
                    out["ids"] = pa.array([x.astype(np.int32) for x in ids],
                                          pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
        if release:
            codec.cache_clear()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
             + (", ids array<int>" if with_ids else ""))
