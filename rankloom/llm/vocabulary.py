"""A byte-level BPE vocabulary file as plain tables, and its pre-tokens.

The file (its path is a parameter) is read on the driver and shipped as a broadcast: it is
a fixed vocabulary of a few MB, whatever the size of the corpus, and ``read`` refuses more
than ``MAX_BYTES``.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import regex

MAX_BYTES = 64 << 20

# The published split pattern of the byte-level BPE vocabularies, with white
# space spelled as the Unicode property.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def read(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(MAX_BYTES + 1)
    if len(raw) > MAX_BYTES:
        raise ValueError(f"{path} is larger than {MAX_BYTES} bytes")
    return raw


def _printable() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: printable Latin-1
    characters stand for themselves, the others are numbered from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """tokens[id] (bytes), ids by bytes, merge tables, and special strings."""

    def __init__(self, raw: bytes):
        j = json.loads(raw)
        byte_of = _printable()
        vocab = j["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in j["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for s, i in vocab.items():
            if s not in self.special:
                self.tokens[i] = bytes(byte_of[c] for c in s)
        for s, i in self.special.items():
            self.tokens[i] = s.encode()
        self.byte_ids = np.zeros(256, np.int64)
        for i, t in enumerate(self.tokens):
            if len(t) == 1:
                self.byte_ids[t[0]] = i
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                  for m in j["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        # decoding: token i is blob[offset[i]:offset[i] + length[i]]
        self.length = np.array([len(t) for t in self.tokens], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._split = regex.compile(SPLIT)
        self._special = regex.compile("|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or "(?!)")

    def pretokens(self, text: str) -> list[str]:
        """The pieces that merges never cross; a special string is a piece of its own."""
        if not any(s in text for s in self.special):
            return self._split.findall(text)
        out, at = [], 0
        for m in self._special.finditer(text):
            out += self._split.findall(text[at:m.start()])
            out.append(m[0])
            at = m.end()
        return out + self._split.findall(text[at:])


@functools.lru_cache(maxsize=4)
def load(raw: bytes) -> Vocabulary:
    """One copy per Python worker."""
    return Vocabulary(raw)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of all elements of the ranges [start, start + count), one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)
