"""Numpy helpers for words and word shingles, shared by the text operators.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased
(``bytes.lower().split()``).  Hashes are 64 bits and stable across workers.
"""

from __future__ import annotations

import numpy as np
import xxhash

CACHED_WORDS = 60_000
_ODD = np.random.default_rng(20240229).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """word -> 64-bit hash; keeps the first CACHED_WORDS."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                    0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _avalanche(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _lane(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _rotl(h ^ (_rotl(x * _P2, 31) * _P1), 27) * _P1 + _P4


def hash_longs(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of 64-bit numbers (Spark's xxhash64 with seed 42)."""
    return _avalanche(_lane(np.full(len(x), (int(_P5) + 8 + seed) % 2**64, np.uint64), x.view(np.uint64)))


def hash_slices(data: bytes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """XXH64 of each ``data[start:stop]``, as ``WordHashes`` has it; slices of one length at a time."""
    out, size = np.empty(len(start), np.uint64), stop - start
    pad = data + bytes(8)       # so that the last slice has 8 bytes to read
    longs = np.ndarray(len(data) + 1, "<u8", pad, strides=(1,))     # the 8 bytes from each position on
    order = np.argsort(np.minimum(size, 32).astype(np.uint8), kind="stable")
    cuts = np.searchsorted(size[order], np.arange(33)) if len(size) else np.zeros(33, np.int64)
    for n in range(32):
        at = order[cuts[n]:cuts[n + 1]]
        if not len(at):
            continue
        s, i = start[at], 0
        h = np.full(len(at), (int(_P5) + n) % 2**64, np.uint64)
        while n - i >= 8:
            h, i = _lane(h, longs[s + i]), i + 8
        rest = longs[s + i] if n > i else None
        if n - i >= 4:
            h, i = _rotl(h ^ ((rest & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3, i + 4
            rest = rest >> np.uint64(32)
        for _ in range(n - i):
            h = _rotl(h ^ ((rest & np.uint64(255)) * _P5), 11) * _P1
            rest = rest >> np.uint64(8)
        out[at] = _avalanche(h)
    for i in order[cuts[32]:].tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i]:stop[i]])
    return out


def words_of(text: str | None) -> list[bytes]:
    # "replace" only matters for lone surrogates, which Spark strings can't hold
    return text.encode("utf-8", "replace").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, in order; of the whole sequence when it
    is shorter; nothing for no words."""
    n = len(h)
    if n == 0:
        return h
    size = min(n, k)
    s = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        s += h[i:n - size + 1 + i] * _ODD[i]
    return mix(s)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
