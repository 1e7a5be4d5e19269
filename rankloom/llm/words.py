"""Words of many texts as numpy arrays: places, texts and 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CHUNK = 1 << 20            # bytes hashed at once; cut at a place between words
SEED, BASE = 0x5EED_0F_70CE, np.uint64(0x9E3779B97F4A7C15 | 1)


def word_bytes(separators) -> np.ndarray:
    """True for the byte values that words are made of."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = word_bytes([0x20, *range(0x09, 0x0E)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text: digits, a-z and all beyond ASCII
ALPHANUMERIC = word_bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61),
                           *range(0x7B, 0x80)])

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
#: a random 64-bit number for each byte, A-Z as a-z
MIX = np.random.default_rng(SEED).integers(0, 1 << 64, 256, dtype=np.uint64)[_lower]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base=BASE) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


@dataclass
class Words:
    buf: np.ndarray        # the texts' bytes, a space after each
    first: np.ndarray      # where each text begins in buf; one more entry for the end
    start: np.ndarray      # of each word
    end: np.ndarray
    doc: np.ndarray        # the text each word belongs to
    hash: np.ndarray


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    return buf, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)


def find_words(texts: list[bytes], inside: np.ndarray = NOT_SPACE) -> Words:
    """The words of all texts, hashed with A-Z taken as a-z."""
    buf, first = join(texts)
    starts, ends, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [MIX[:0]]
    at = 0
    while at < len(buf):
        stop = min(len(buf), at + CHUNK)
        while stop < len(buf) and inside[buf[stop - 1]]:     # do not cut a word
            more = np.flatnonzero(~inside[buf[stop:stop + CHUNK]])
            stop = stop + int(more[0]) + 1 if len(more) else min(len(buf), stop + CHUNK)
        part = buf[at:stop]
        is_word = inside[part]
        edge = np.flatnonzero(np.diff(np.r_[False, is_word, False].astype(np.int8)))
        s, e = edge[0::2], edge[1::2]
        if len(s):
            size = e - s
            body = MIX[part[is_word]]
            offset = np.cumsum(size) - size
            local = np.arange(len(body)) - np.repeat(offset, size)
            h = np.add.reduceat(body * powers(int(size.max()))[local], offset)
            starts.append(s + at)
            ends.append(e + at)
            hashes.append(mix(h + size.astype(np.uint64)))
        at = stop
    start = np.concatenate(starts)
    return Words(buf, first, start, np.concatenate(ends),
                 np.searchsorted(first, start, "right") - 1, np.concatenate(hashes))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words of the array."""
    if len(hashes) < n:
        return hashes[:0]
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * BASE + hashes[i:len(hashes) - n + 1 + i])
    return out
