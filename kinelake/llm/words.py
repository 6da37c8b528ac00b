"""Hashes of words and of runs of words, by whole arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_C = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads a polynomial hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash (not mixed) of every ``n`` consecutive entries; empty if there are fewer."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for j in range(n):
        h = h * _C + words[j : j + m]
    return h


def joined(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs from those of their two parts, the right one ``n`` long."""
    return left * np.uint64(pow(int(_C), n, 1 << 64)) + right


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_BLANK = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])


def word_hashes(raw: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at these places, eight bytes at a time; ``raw`` has eight more bytes than they need."""
    eight = np.ndarray((max(0, len(raw) - 7),), "<u8", raw, strides=(1,))
    size = end - begin
    h = mix(size.astype(np.uint64) * _C ^ (eight[begin] & _MASKS[np.minimum(size, 8)]))
    for k in range(1, 9):
        rest = np.flatnonzero(size > 8 * k)
        if not len(rest):
            return h
        h[rest] = mix(h[rest] * _C ^ (eight[begin[rest] + 8 * k] & _MASKS[np.minimum(size[rest] - 8 * k, 8)]))
    for i in np.flatnonzero(size > 72).tolist():
        h[i] = xxhash.xxh64_intdigest(raw[begin[i] : end[i]])
    return h


class Words:
    """Words (runs without bytes 9-13 and 32) of texts: where they stand in ``raw``, their hashes, and how many each text has."""

    def __init__(self, texts: list[bytes]):
        self.raw = b" ".join([*texts, b" " * 9])
        blank = _BLANK[np.frombuffer(self.raw, np.uint8)]
        turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(blank) and not blank[0]:
            turns = np.concatenate([[0], turns])
        self.begin, self.end = turns[::2], turns[1::2]
        self.hash = word_hashes(self.raw, self.begin, self.end)
        edges = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        self.last = np.searchsorted(self.begin, edges)  # number of the word after each text's last
        self.size = np.diff(self.last, prepend=0)


def texts_of(column: pa.Array) -> list[bytes]:
    """Null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices_by(bucket: np.ndarray):
    """Each bucket with the places of its entries."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
