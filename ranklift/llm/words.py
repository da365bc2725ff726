"""Vectorised word hashing over Arrow text columns, for use inside tasks.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r, with A-Z lower-cased.
Each word gets a 64-bit hash (polynomial over its bytes, then mixed); everything works
on the column's byte buffer with numpy, whole texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240607))
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64)[_LOWER] * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([1], np.uint64)
PIECE = 1 << 20


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    global _POWERS
    if base != _BASE:
        return np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), base, np.uint64)])
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 1024), _BASE, np.uint64)])
    return _POWERS


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit mixer; each seed gives another one."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Texts of one slice: bytes, text bounds, word bounds (bytes), word hashes, word bounds of each text."""

    buf: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # text i has words first[i] .. first[i + 1] - 1


def _hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    total = np.cumsum(end - start)
    cuts = [0]
    while cuts[-1] < len(start):  # runs of words of about PIECE bytes
        before = total[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(total, before + PIECE))))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        n = end[a:b] - start[a:b]
        at = np.cumsum(n) - n
        pos = np.arange(int(n.sum())) - np.repeat(at, n)
        value = _VALUE[buf[pos + np.repeat(start[a:b], n)]] * powers(int(n.max()))[pos]
        out[a:b] = np.add.reduceat(value, at)
    return mix(out)


def split_words(buf: np.ndarray, bounds: np.ndarray) -> Words:
    """Words of the texts buf[bounds[i]:bounds[i + 1]]."""
    word = ~SPACE[buf]
    edge = np.empty(len(buf) + 1, bool)
    edge[0], edge[-1] = True, True
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    inner = bounds[(bounds > 0) & (bounds < len(buf))]
    edge[inner] = True
    at = np.flatnonzero(edge)
    at = at[:-1][word[at[:-1]]] if len(buf) else at[:0]
    ends = np.flatnonzero(edge)
    end = ends[np.searchsorted(ends, at, side="right")] if len(at) else at
    return Words(buf, bounds, at, end, _hashes(buf, at, end) if len(at) else np.empty(0, np.uint64),
                 np.searchsorted(at, bounds))


def text_slices(texts: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, text bounds) for runs of whole texts of about ``limit`` bytes; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"") if texts.null_count else texts.cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, b - a, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def word_slices(texts: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, Words]]:
    for a, n, buf, bounds in text_slices(texts, limit):
        yield a, n, split_words(buf, bounds)


def shingle_sets(w: Words, size: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct ``size``-word shingle hashes of each text; a shorter text is one shingle, no word none."""
    n = len(w.hash)
    weight = powers(size + 1)
    rolling = np.zeros(max(n - size + 1, 0), np.uint64)
    for j in range(size):
        rolling += w.hash[j:n - size + 1 + j] * weight[j] if n >= size else np.uint64(0)
    rolling = mix(rolling, 5)
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= size:
            yield np.unique(rolling[a:b - size + 1])
        elif b > a:
            short = (w.hash[a:b] * weight[:b - a]).sum(dtype=np.uint64)
            yield mix(np.array([short]), 100 + int(b - a))
        else:
            yield np.empty(0, np.uint64)
