"""Number columns and texts as compressed binaries, for shuffles of many small numbers."""

from __future__ import annotations

import functools

import numpy as np
import zstandard

from rankloom.llm.words import mix


@functools.cache
def _zstd():
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def zipped(data: bytes) -> bytes:
    return _zstd()[0].compress(data)


def unzipped(data: bytes) -> bytes:
    return _zstd()[1].decompress(data)


def pack(*columns: np.ndarray) -> bytes:
    """Equally long columns: the bytes of each, plane by plane, so that empty planes cost
    next to nothing."""
    return zipped(b"".join(
        np.ascontiguousarray(c.view(np.uint8).reshape(-1, c.itemsize).T).tobytes()
        for c in columns))


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    raw = np.frombuffer(unzipped(data), np.uint8)
    kinds = [np.dtype(k) for k in kinds]
    n, out, at = len(raw) // sum(k.itemsize for k in kinds), [], 0
    for k in kinds:
        planes = raw[at:at + n * k.itemsize].reshape(k.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(k))
        at += n * k.itemsize
    return out


def unpack_all(rows: list[bytes], *kinds) -> list[np.ndarray]:
    """The rows' columns one after another."""
    parts = [unpack(r, *kinds) for r in rows]
    return [np.concatenate([np.zeros(0, k), *(p[i] for p in parts)]) for i, k in
            enumerate(kinds)]


def spread(keys: np.ndarray, parts: int) -> np.ndarray:
    """A part for each integer key."""
    return (mix(keys.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int64)
