"""Cross-tokenizer alignment: an associative monoid of fragments over byte ranges.

A text (with a space before it) is cut into tokens by two tokenizers, A and B.  Offsets where
tokens of both end cut it into groups; tokens of a group whose byte ranges overlap are links.

*Fragments.*  A long text is dealt out as chunks of bytes.  A chunk owns the A tokens of the
words that begin in its range and the B tokens of the words that begin there; as A may begin
anew before any ASCII white space and B only before a space, the two ranges differ.  A
fragment is what is known of a run of chunks: the open tokens before its first common end,
closed groups, the open tokens after its last one.  Two neighbours compose by joining the
open ends between them and cutting these again.  Composing is associative, so the fragments
of a text are reduced as a tree over tasks, ``FAN`` at a time; closed groups are written as
soon as they are known and never move again.  Texts up to ``CHUNK`` bytes are one fragment.

*Words.*  Both tokenizers begin anew before a space that no other white space surrounds, so
there every group ends, and a short text is a row of closed elements, one a word.  Each distinct
word is tokenized and aligned once per worker (a table of at most ``TABLE`` bytes).  Texts with
other runs of white space are one element, as are the closed parts of long texts.

*Counts.*  Texts are worked on in blocks of at most ``BLOCK`` bytes.  Each block hands on its
distinct id pairs with their numbers; these are summed over the corpus, the highest count of
each B id is found, and every block gets the totals of its own pairs back.  A block's pairs are
bounded by its bytes, however frequent a pair is in the corpus.

*Digests.*  The groups of a long text are hashed as a stream of its units in order.

Only the two vocabulary files are broadcast (``vocabulary.MAX_BYTES`` each at most).

Defined results: a null or empty text, and one whose tokens do not spell the text again
(U+2581 in it, for one), has no tokens: zeros and an empty digest.  Very long texts are whole;
only a run without any ASCII white space is tokenized by one task.  Repeated rows and repeated
or null keys are rows of their own, alike; an empty table gives no rows; further columns of the
input are not read.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import slices, stash
from rankloom.llm.packing import pack, unpack, unzipped, zipped
from rankloom.llm.vocabulary import Vocabulary, ragged, read

CHUNK = 64 << 10           # bytes of text in a chunk; shorter texts are whole
BLOCK = 8 << 20            # bytes of text whose pairs are counted together
TABLE = 48 << 20           # bytes of words and links that a worker remembers
SLICE = 2 << 20            # bytes of text worked on at once
JOINED = 50_000            # characters of new words tokenized side by side
FAN = 16                   # neighbours composed by one task

FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


# ---- the two tokenizers --------------------------------------------------------------------

class Pieces:
    """A token table: the bytes of each id."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self.blob[ragged(self.offset[ids], self.length[ids])]


class Tokenizers:
    """A: a byte-level BPE file of the tokenizers library.  B: a sentencepiece model."""

    def __init__(self, raw_a: bytes, raw_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # tasks run side by side already
        import sentencepiece
        import tokenizers
        self._a = tokenizers.Tokenizer.from_str(raw_a.decode())
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        self._b = sp = sentencepiece.SentencePieceProcessor(model_proto=raw_b)
        self.a = Pieces(Vocabulary(raw_a).tokens)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.b = Pieces([bytes([int(p[3:5], 16)]) if sp.is_byte(i)
                         else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        # B may begin anew before a space only if no piece has one behind other characters
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        # decimal ids, each with what may follow it
        self.words = [f"{i}{after}" for n, ends in ((len(self.a.length), ",|"),
                                                    (len(self.b.length), ",;"))
                      for after in ends for i in range(n)]

    def encode_a(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int64) for e in
                self._a.encode_batch(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self._b.encode(texts, num_threads=1)] if texts else []


@functools.lru_cache(maxsize=1)
def tokenizers_of(raw_a: bytes, raw_b: bytes) -> Tokenizers:
    return Tokenizers(raw_a, raw_b)


def spelled(table: Pieces, ids: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
    """For each text: do its ids spell it?"""
    sizes = np.array([table.length[x].sum() for x in ids], np.int64)
    ok = sizes == np.array([len(t) for t in texts], np.int64)
    flat = np.concatenate([x for x, same in zip(ids, ok) if same] or [np.zeros(0, np.int64)])
    want = np.frombuffer(b"".join(t for t, same in zip(texts, ok) if same), np.uint8)
    wrong = np.flatnonzero(table.spell(flat) != want)
    ends = np.cumsum(sizes[ok])
    ok[np.flatnonzero(ok)[np.unique(np.searchsorted(ends, wrong, "right"))]] = False
    return ok


# ---- chunks --------------------------------------------------------------------------------

_A_CUT = re.compile(rb"(?<=[!-~\x80-\xff])[\t-\r ]")
_B_CUT = re.compile(rb"(?<=[!-~\x80-\xff]) (?=[^\t-\r ])")


def _next_cut(pattern: re.Pattern, data: bytes, at: int) -> int:
    """The first place from ``at`` on where a word may begin anew; the end if there is none."""
    while m := pattern.search(data, at):
        before = data[max(0, m.start() - 4):m.start()].decode("utf-8", "ignore")
        if before and not before[-1].isspace():     # white space beyond ASCII runs on
            return m.start()
        at = m.end()
    return len(data)


def chunks(data: bytes, size: int, apart: bool):
    """(a0, a1, b0, b1): the A and B ranges of each chunk of ``size`` bytes."""
    end, a0, b0 = len(data), 0, 0
    for lo in range(size, end + size, size):
        a1 = a0 if a0 >= lo else _next_cut(_A_CUT, data, lo) if apart and lo < end else end
        b1 = b0 if b0 >= lo else _next_cut(_B_CUT, data, lo) if apart and lo < end else end
        if lo >= end:
            a1 = b1 = end
        if a1 > a0 or b1 > b0:
            yield a0, a1, b0, b1
        a0, b0 = a1, b1


# ---- streams, groups and fragments -----------------------------------------------------------

class Streams:
    """Consecutive tokens of A from byte ``a_at`` on and of B from ``b_at`` on."""

    def __init__(self, a_at: int, a: np.ndarray, b_at: int, b: np.ndarray):
        self.a_at, self.a, self.b_at, self.b = a_at, a, b_at, b

    def __add__(self, other: Streams) -> Streams:
        return Streams(self.a_at, np.concatenate([self.a, other.a]),
                       self.b_at, np.concatenate([self.b, other.b]))

    def split(self, i: int, j: int, tok: Tokenizers) -> tuple[Streams, Streams]:
        """The first i tokens of A and j of B, and the rest."""
        return (Streams(self.a_at, self.a[:i], self.b_at, self.b[:j]),
                Streams(self.a_at + int(tok.a.length[self.a[:i]].sum()), self.a[i:],
                        self.b_at + int(tok.b.length[self.b[:j]].sum()), self.b[j:]))

    def common(self, tok: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of A and B tokens up to each common end."""
        a = self.a_at + np.cumsum(tok.a.length[self.a])
        b = self.b_at + np.cumsum(tok.b.length[self.b])
        _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        return i + 1, j + 1


class Fragment:
    """Open tokens before the first common end (``head``; all tokens if there is no such end),
    whether there is one (``cut``), and the open tokens after the last one (``tail``)."""

    def __init__(self, head: Streams, cut: bool, tail: Streams | None, ok: bool = True):
        self.head, self.cut, self.tail, self.ok = head, cut, tail, ok


def recut(body: Streams, closed_left: bool, tok: Tokenizers):
    """(head, closed streams or None, tail) of joined open tokens; head is None if there is no
    common end or ``closed_left``; tail is what follows the last common end."""
    i, j = body.common(tok)
    if not len(i):
        return None, None, body
    head = None
    done, tail = body.split(i[-1], j[-1], tok)
    if not closed_left:
        head, done = done.split(i[0], j[0], tok)
    return head, (done if len(done.a) else None), tail


def fragment(body: Streams, ok: bool, first: bool, tok: Tokenizers):
    """(fragment, closed streams or None) of one chunk; ``first``: a text begins here."""
    head, done, tail = recut(body, first, tok)
    nothing = Streams(body.a_at, body.a[:0], body.b_at, body.b[:0])
    if first:
        return Fragment(nothing, True, tail, ok), done
    if head is None:
        return Fragment(body, False, nothing, ok), None
    return Fragment(head, True, tail, ok), done


def compose(left: Fragment, right: Fragment, tok: Tokenizers):
    """(fragment, closed streams or None) of two neighbours; associative."""
    ok = left.ok and right.ok
    head, done, tail = recut((left.tail if left.cut else left.head) + right.head, left.cut, tok)
    if right.cut:              # what is joined ends with a common end
        tail = right.tail
    if left.cut:
        return Fragment(left.head, True, tail, ok), done
    if head is None:
        return Fragment(tail, False, right.tail, ok), None
    return Fragment(head, True, tail, ok), done


# ---- rows ------------------------------------------------------------------------------------

_FIELDS = ("kind string, rid long, key {}, whole boolean, j long, ok boolean, cut boolean, "
           "at long, a binary, b_at long, b binary, tail_at long, tail_a binary, tail_b_at long, "
           "tail_b binary, block long, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, groups binary, pairs array<long>, times array<long>, "
           "links binary, n_each binary, items binary, n_items binary")
_PA = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(),
       "array<long>": pa.list_(pa.int64())}


def _schema(key: str) -> str:
    return _FIELDS.format(key)


def _pa_schema(key: pa.DataType) -> pa.Schema:
    fields = [f.split() for f in _FIELDS.split(", ")]
    return pa.schema([(name, _PA.get(kind, key)) for name, kind in fields])


def _ids(x: np.ndarray) -> bytes:
    return pack(x.astype(np.int32))


def _load(x: bytes) -> np.ndarray:
    return unpack(x, np.int32)[0].astype(np.int64)


def _open_row(rid, key, j: int, f: Fragment) -> dict:
    return {"kind": "open", "rid": rid, "key": key, "j": j, "ok": f.ok, "cut": f.cut,
            "at": f.head.a_at, "a": _ids(f.head.a), "b_at": f.head.b_at, "b": _ids(f.head.b),
            "tail_at": f.tail.a_at, "tail_a": _ids(f.tail.a), "tail_b_at": f.tail.b_at,
            "tail_b": _ids(f.tail.b)}


def _fragment_of(r: dict) -> Fragment:
    return Fragment(Streams(r["at"], _load(r["a"]), r["b_at"], _load(r["b"])), r["cut"],
                    Streams(r["tail_at"], _load(r["tail_a"]), r["tail_b_at"],
                            _load(r["tail_b"])), r["ok"])


def _closed_row(rid, key, s: Streams) -> dict:
    return {"kind": "closed", "rid": rid, "key": key, "at": s.a_at, "a": _ids(s.a),
            "b": _ids(s.b)}


def links(a: np.ndarray, b: np.ndarray, tok: Tokenizers):
    """(end of each link, A id, B id, ends of A tokens, of B tokens) of closed streams."""
    a_end, b_end = np.cumsum(tok.a.length[a]), np.cumsum(tok.b.length[b])
    size = int(a_end[-1]) + 1 if len(a_end) else 1
    in_a, in_b = np.zeros(size, bool), np.zeros(size, bool)
    in_a[a_end] = True
    in_b[b_end] = True
    ends = np.flatnonzero(in_a | in_b)
    # each stretch between ends is one pair of tokens: those that end there or later
    of_a = (np.cumsum(in_a, dtype=np.int32) - in_a)[ends]
    of_b = (np.cumsum(in_b, dtype=np.int32) - in_b)[ends]
    return ends, a[of_a], b[of_b], a_end, b_end


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a << 32) | b


class Elements:
    """Closed streams that a worker has aligned: words, which it finds again, and others."""

    def __init__(self, tok: Tokenizers):
        self.tok = tok
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []             # groups of each element
        self.columns = [np.zeros(0, np.int64) for _ in range(4)]    # n_a, n_b, n_groups, n_links
        self.fine = np.zeros(0, bool)
        self.links = np.zeros(0, np.int64)
        self.size = 0

    def _add(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
             fine: np.ndarray) -> np.ndarray:
        """Streams of n_a and n_b tokens each as new elements; those that are not ``fine`` have
        no tokens."""
        ends, x, y, a_end, b_end = links(a, b, self.tok)
        texts, n_groups = group_texts(a, b, a_end, b_end, n_a, n_b, self.tok)
        stop = np.concatenate([[0], a_end])[np.cumsum(n_a)]
        n_links = np.diff(np.concatenate([[0], np.searchsorted(ends, stop, "right")]))
        first = len(self.texts)
        self.texts += texts
        self.columns = [np.concatenate([old, new]) for old, new in
                        zip(self.columns, (n_a, n_b, n_groups, n_links))]
        self.fine = np.concatenate([self.fine, fine])
        self.links = np.concatenate([self.links, _pair(x, y)])
        self.size += sum(map(len, texts)) + 8 * len(ends) + 150 * len(texts)
        return np.arange(first, len(self.texts))

    def add_texts(self, texts: list[str]) -> np.ndarray:
        tok, none = self.tok, np.zeros(0, np.int64)
        a, b = tok.encode_a([" " + t for t in texts]), tok.encode_b(texts)
        spaced = [(" " + t).encode() for t in texts]
        fine = spelled(tok.a, a, spaced) & spelled(tok.b, b, spaced)
        a, b = ([x if ok else none for x, ok in zip(z, fine)] for z in (a, b))
        return self._add(np.concatenate(a), np.concatenate(b), *(
            np.array([len(x) for x in z], np.int64) for z in (a, b)), fine)

    def add_words(self, words: list[str]) -> np.ndarray:
        """Words without white space at their ends: tokenized side by side in one text."""
        tok = self.tok
        joined = " " + " ".join(words)
        want = np.frombuffer(joined.encode(), np.uint8)
        a, b = tok.encode_a([joined])[0], tok.encode_b([joined[1:]])[0]
        for table, ids in ((tok.a, a), (tok.b, b)):
            if table.length[ids].sum() != len(want) or (table.spell(ids) != want).any():
                return self.add_texts(words)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        n_a, n_b = (np.diff(np.searchsorted(np.cumsum(table.length[ids]), ends, "right"), prepend=0)
                    for table, ids in ((tok.a, a), (tok.b, b)))
        return self._add(a, b, n_a, n_b, np.ones(len(words), bool))

    def add_stream(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._add(a, b, np.array([len(a)]), np.array([len(b)]), np.ones(1, bool))

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """The elements of each text, in order."""
        words = [None if self.tok.apart is False or _ODD.search(" " + t) else t.split(" ")
                 for t in texts]
        new = list({w for ws in words if ws for w in ws if w not in self.index})
        plain = [w for w in new if not (w[:1].isspace() or w[-1:].isspace())]
        for lo, hi in slices([len(w) for w in plain], JOINED):
            self.index |= zip(plain[lo:hi], self.add_words(plain[lo:hi]).tolist())
        if new := [w for w in new if w not in self.index]:
            self.index |= zip(new, self.add_texts(new).tolist())
        odd = [t for t, ws in zip(texts, words) if ws is None]
        rest = iter(self.add_texts(odd) if odd else ())
        get = self.index.__getitem__
        return [np.array([next(rest)] if ws is None else list(map(get, ws)), np.int64)
                for ws in words]


#: white space by which a text can't be told apart at single spaces
_ODD = re.compile(r"\s \s|  | $|^ $")


def _in_blocks(parts, part: int, salt: int, schema: pa.Schema, store: Elements, most: int):
    """Unit rows in blocks, each followed by the block's distinct pairs and their numbers, the
    links of its elements and the elements of its units.  ``parts`` are (bytes of text, function
    that gives (row, elements) of units, and batches of other rows, which go through)."""
    held, items, size, number = [], [], 0, 0

    def flush():
        block = (salt << 60) | (part << 30) | number
        flat = np.concatenate(items)
        used, local, times = np.unique(flat, return_inverse=True, return_counts=True)
        each = store.columns[3]
        own = store.links[ragged((np.cumsum(each) - each)[used], each[used])]
        pairs, place = np.unique(own, return_inverse=True)
        total = np.bincount(place, np.repeat(times, each[used]), len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_pylist([r | {"block": block} for r in held], schema)
        one = {"kind": pa.array(["block"]), "block": pa.array([block]),
               "pairs": pa.array([pairs], pa.list_(pa.int64())),
               "times": pa.array([total], pa.list_(pa.int64())),
               "links": pa.array([_ids(place)]), "n_each": pa.array([_ids(each[used])]),
               "items": pa.array([_ids(local)]),
               "n_items": pa.array([_ids(np.array([len(x) for x in items]))])}
        yield pa.RecordBatch.from_arrays(
            [one.get(f.name, pa.nulls(1, f.type)) for f in schema], schema=schema)

    for n, work in parts:
        if held and size + n > most:
            yield from flush()
            held, items, size, number = [], [], 0, number + 1
            if store.size > TABLE:
                store.forget()
        size += n
        for out in work():
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                held.append(out[0] | {"j": len(held)})
                items.append(out[1])
    if held:
        yield from flush()


def _unit(rid, key, whole: bool, at: int, elements: np.ndarray, store: Elements) -> dict:
    text = ";".join(map(store.texts.__getitem__, elements.tolist())).encode()
    return {"kind": "unit", "rid": rid, "key": key, "whole": whole, "at": at,
            **{x: int(c[elements].sum()) for x, c in zip(FIGURES, store.columns)},
            "groups_sha256": hashlib.sha256(text).hexdigest() if whole else None,
            "groups": None if whole else zipped(text)}


def _first_pass(batches, raw_a, raw_b, chunk: int, block: int, key: pa.DataType):
    """Short texts to units in blocks, long ones to pieces, the others to rows without tokens."""
    from pyspark import TaskContext
    tok, schema = tokenizers_of(raw_a, raw_b), _pa_schema(key)
    store = Elements(tok)

    def other(rows):
        return pa.RecordBatch.from_pylist(rows, schema)

    def units(rids, keys, texts):
        yield other([{"kind": "none", "key": k} for k, t in zip(keys, texts) if not t])
        for r, k, t in zip(rids, keys, texts):
            if t and len(t) > chunk:
                data = b" " + t
                for j, (a0, a1, b0, b1) in enumerate(chunks(data, chunk, tok.apart)):
                    yield other([{"kind": "piece", "rid": r, "key": k, "j": j, "at": a0,
                                  "a": data[a0:a1], "b_at": b0, "b": data[b0:b1]}])
        short = [(r, k, t) for r, k, t in zip(rids, keys, texts) if t and len(t) <= chunk]
        for (r, k, _), elements in zip(short, store.of([t.decode() for _, _, t in short])):
            if store.fine[elements].all():
                yield _unit(r, k, True, 0, elements, store), elements
            else:
                yield other([{"kind": "none", "key": k}])

    def parts():
        for batch in batches:
            rids, keys, texts = (batch.column(c).to_pylist() for c in ("rid", "key", "text"))
            sizes = [len(t or b"") for t in texts]
            for lo, hi in slices(sizes, min(SLICE, block)):
                yield (sum(n for n in sizes[lo:hi] if n <= chunk),
                       functools.partial(units, rids[lo:hi], keys[lo:hi], texts[lo:hi]))

    yield from _in_blocks(parts(), TaskContext.get().partitionId(), 0, schema, store, block)


def _pieces(batches, raw_a, raw_b, key: pa.DataType):
    """Pieces of long texts to open fragments and closed units."""
    tok, schema = tokenizers_of(raw_a, raw_b), _pa_schema(key)
    for batch in batches:
        for r in batch.to_pylist():
            x = tok.encode_a([r["a"].decode()])[0] if r["a"] else np.zeros(0, np.int64)
            y = tok.encode_b([r["b"][1:].decode()])[0] if r["b"] else np.zeros(0, np.int64)
            ok = bool(spelled(tok.a, [x], [r["a"]])[0] and spelled(tok.b, [y], [r["b"]])[0])
            body = Streams(r["at"], x, r["b_at"], y)
            if not ok:         # the text has no tokens; keep its chunks in line
                body = Streams(r["at"], x[:0], r["b_at"], y[:0])
            f, done = fragment(body, ok, r["j"] == 0, tok)
            rows = [_open_row(r["rid"], r["key"], r["j"], f)]
            if done is not None:
                rows.append(_closed_row(r["rid"], r["key"], done))
            yield pa.RecordBatch.from_pylist(rows, schema)


def _reduce(table: pa.Table, raw_a, raw_b, key: pa.DataType, fan: int) -> pa.Table:
    """Up to ``fan`` neighbouring fragments to one, and the groups that closed between them."""
    tok, schema = tokenizers_of(raw_a, raw_b), _pa_schema(key)
    rows = sorted(table.to_pylist(), key=lambda r: r["j"])
    now, out = _fragment_of(rows[0]), []
    for r in rows[1:]:
        now, done = compose(now, _fragment_of(r), tok)
        if done is not None:
            out.append(_closed_row(r["rid"], r["key"], done))
    out.append(_open_row(rows[0]["rid"], rows[0]["key"], rows[0]["j"] // fan, now))
    return pa.Table.from_pylist(out, schema)


def _reblock(batches, raw_a, raw_b, block: int, key: pa.DataType):
    """Closed parts of long texts to units in blocks."""
    from pyspark import TaskContext
    tok, schema = tokenizers_of(raw_a, raw_b), _pa_schema(key)
    store = Elements(tok)

    def unit(r):
        elements = store.add_stream(_load(r["a"]), _load(r["b"]))
        yield _unit(r["rid"], r["key"], False, r["at"], elements, store), elements

    def parts():
        for batch in batches:
            for r in batch.to_pylist():
                yield (int(tok.a.length[_load(r["a"])].sum()), functools.partial(unit, r))

    yield from _in_blocks(parts(), TaskContext.get().partitionId(), 1, schema, store, block)


def group_texts(a, b, a_end, b_end, n_a, n_b, tok: Tokenizers) -> tuple[list[str], np.ndarray]:
    """Of each unit the groups ``a1,a2|b1;...`` and their number; units follow one another in
    the streams with n_a and n_b tokens each."""
    size = int(a_end[-1]) + 1 if len(a_end) else 1
    both = np.zeros(size, bool)
    both[a_end] = True
    in_b = np.zeros(size, bool)
    in_b[b_end] = True
    both &= in_b
    earlier = np.cumsum(both, dtype=np.int32) - both       # groups that end before each place
    of_a, of_b = earlier[a_end], earlier[b_end]
    groups = int(both.sum())
    at_a, at_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    until_a, until_b = np.cumsum(at_a), np.cumsum(at_b)
    word = np.empty(len(a) + len(b), np.int64)
    size_a, size_b = len(tok.a.length), len(tok.b.length)
    last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
    word[np.arange(len(a)) + (until_b - at_b)[of_a]] = a + size_a * last_a[:len(a)]
    word[np.arange(len(b)) + until_a[of_b]] = 2 * size_a + b + size_b * last_b[:len(b)]
    ends = np.cumsum(n_a + n_b)
    words = list(map(tok.words.__getitem__, word.tolist()))
    texts = ["".join(words[e - n:e])[:-1] for e, n in zip(ends.tolist(), (n_a + n_b).tolist())]
    return texts, np.diff(np.concatenate([[0], until_of(of_a, n_a)]))


def until_of(groups: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Groups up to the end of each unit."""
    return np.concatenate([[0], groups + 1])[np.cumsum(counts)]


def _result_schema(key: pa.DataType) -> pa.Schema:
    return pa.schema([("rid", pa.int64()), ("key", key), ("whole", pa.bool_()), ("at", pa.int64()),
                      *[(x, pa.int64()) for x in FIGURES],
                      ("groups_sha256", pa.string()), ("groups", pa.binary())])


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``counts`` values each."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _figures(rows: pa.Table, totals: pa.Table, key: pa.DataType) -> pa.Table:
    """A block's units with what the corpus totals of its pairs give."""
    schema = _result_schema(key)
    rows = rows.sort_by([("kind", "ascending"), ("j", "ascending")])    # the block row first
    head, units = rows.slice(0, 1), rows.slice(1)
    order = np.argsort(totals.column("pair").to_numpy())
    times = totals.column("times").to_numpy()[order]
    best = totals.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    place, each, items, n_items = (_load(head.column(x)[0].as_py())
                                   for x in ("links", "n_each", "items", "n_items"))
    done = {x: units.column(x) for x in schema.names if x in units.column_names}
    for name, by_pair in (("n_best", best), ("count_sum", times)):
        done[name] = pa.array(_sums(_sums(by_pair[place], each)[items], n_items))
    return pa.Table.from_arrays([done[x] for x in schema.names], schema=schema)


def _stream(batches, key: pa.DataType):
    """Units of long texts in order to one row a text."""
    schema = pa.schema([("key", key), *[(x, pa.int64()) for x in FIGURES],
                        ("groups_sha256", pa.string())])
    rid = sha = doc = None
    sums = [0] * len(FIGURES)

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([doc], key), *(pa.array([s], pa.int64()) for s in sums),
             pa.array([sha.hexdigest()])], schema=schema)

    for batch in batches:
        for r in batch.to_pylist():
            if r["rid"] != rid:
                if sha is not None:
                    yield out()
                rid, doc, sha, sums = r["rid"], r["key"], hashlib.sha256(), [0] * len(FIGURES)
            else:
                sha.update(b";")
            sha.update(unzipped(r["groups"]))
            sums = [s + r[x] for s, x in zip(sums, FIGURES)]
    if sha is not None:
        yield out()


# ---- the operator ----------------------------------------------------------------------------

def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
          chunk: int = CHUNK, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    raw_a, raw_b = sc.broadcast(read(path_a)), sc.broadcast(read(path_b))
    kind = docs.schema[key].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type
    pa_key = to_arrow_type(docs.schema[key].dataType)
    schema = _schema(kind)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("key"),
                       F.col(text).cast("binary").alias("text"))
    first = stash(rows.mapInArrow(
        lambda it: _first_pass(it, raw_a.value, raw_b.value, chunk, block, pa_key), schema),
        "align-first")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    pieces = first.filter("kind = 'piece'").select("rid", "key", "j", "at", "a", "b_at", "b")
    level = stash(pieces.repartition(parts, "rid", "j").mapInArrow(
        lambda it: _pieces(it, raw_a.value, raw_b.value, pa_key), schema), "align-pieces")
    closed = [level.filter("kind = 'closed'")]
    last = level.filter("kind = 'open'")
    while (last.agg(F.max("j")).first()[0] or 0) > 0:
        level = stash(last.groupBy("rid", F.floor(F.col("j") / fan).alias("to")).applyInArrow(
            lambda t: _reduce(t, raw_a.value, raw_b.value, pa_key, fan), schema), "align-level")
        closed.append(level.filter("kind = 'closed'"))
        last = level.filter("kind = 'open'")
    units = functools.reduce(DataFrame.unionByName, closed)
    good = last.filter("ok").select("rid")
    long = stash(units.join(good, "rid", "left_semi").select(*units.columns).mapInArrow(
        lambda it: _reblock(it, raw_a.value, raw_b.value, block, pa_key), schema), "align-long")

    both = first.unionByName(long)
    pairs = stash(both.filter("kind = 'block'").select(
        "block", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
        .select("block", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")),
        "align-pairs")
    counts = stash(pairs.groupBy("pair").agg(F.sum("times").alias("times")), "align-counts")
    id_b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(id_b.alias("id")).agg(F.max("times").alias("most"))
    totals = stash(counts.join(most, id_b == F.col("id")).select(
        "pair", "times", (F.col("times") == F.col("most")).alias("best")), "align-totals")
    own = pairs.select("block", "pair").join(totals, "pair")
    given = ["rid", "key", "whole", "at", *FIGURES[:4], "groups_sha256", "groups"]
    result = ", ".join(f"{x} long" for x in FIGURES)
    found = stash(
        both.filter("kind IN ('block', 'unit')")
        .select("block", "kind", "j", *given, "links", "n_each", "items", "n_items")
        .groupBy("block").cogroup(own.groupBy("block")).applyInArrow(
            lambda x, y: _figures(x, y, pa_key),
            f"rid long, key {kind}, whole boolean, at long, {result}, groups_sha256 string, "
            "groups binary"), "align-figures")
    streams = (found.filter(~F.col("whole")).select("rid", "key", "at", *FIGURES, "groups")
               .repartition(parts, "rid").sortWithinPartitions("rid", "at")
               .mapInArrow(lambda it: _stream(it, pa_key),
                           f"key {kind}, {result}, groups_sha256 string"))
    none = (first.filter("kind = 'none'").select("key")
            .unionByName(last.filter(~F.col("ok")).select("key"))
            .select("key", *[F.lit(0).cast("long").alias(x) for x in FIGURES],
                    F.lit("").alias("groups_sha256")))
    out = (found.filter("whole").select("key", *FIGURES, "groups_sha256")
           .unionByName(streams).unionByName(none))
    return out.withColumnRenamed("key", key)
