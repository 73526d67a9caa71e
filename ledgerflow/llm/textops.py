"""Vectorised text primitives for the Python stages of this subpackage.

A batch of texts is turned into one byte buffer; words, word hashes, shingles
and windows are then numpy arrays over that buffer, so no Python runs per word.
Words are maximal runs of characters other than U+0020 and U+0009..U+000D.
Those are single bytes in UTF-8 that never occur inside a longer sequence, so
working on bytes gives the same words as working on code points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
_M1, _M2, _GOLD = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
#: Odd multipliers of the rolling hashes (bytes into words, words into windows).
BYTE_BASE, WORD_BASES = 0x9E3779B97F4A7C55, (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x + _GOLD).astype(U64, copy=False)
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the life of the worker."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=U64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 1 << 23:
            _POWERS[base] = have
    return have[:n]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for every range, from one running sum."""
    n = len(values)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(values.astype(U64, copy=False) * powers(base, n), out=total[1:])
    inverse = pow(base, -1, 1 << 64)
    return (total[ends] - total[starts]) * powers(inverse, n + 1)[starts]


@dataclass
class Words:
    """Words of a run of texts: 64-bit hashes, byte ranges, and ptr[d]:ptr[d+1] as document d's words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray
    buffer: bytes

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def words(texts: list[str], hashed: bool = True) -> Words:
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    buffer = b" ".join(raw) + b" "
    data = np.frombuffer(buffer, dtype=np.uint8)
    inside = np.concatenate(([False], ~_SPACE[data]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    lengths = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    ptr = np.searchsorted(starts, bounds)
    h = mix64(range_hash(data, starts, ends, BYTE_BASE) ^ ((ends - starts).astype(U64) << U64(48))) if hashed else None
    return Words(h, starts, ends, ptr, buffer)


def runs(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``most`` characters (a longer text is a range of its own)."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and size + n > most:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words of every document, and ptr into them.

    A document of 1 to k-1 words has one shingle, all its words; one without
    words has none.
    """
    counts = np.diff(w.ptr)
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    ptr = np.concatenate(([0], np.cumsum(n)))
    first = np.repeat(w.ptr[:-1] - ptr[:-1], n) + np.arange(ptr[-1])
    last = np.minimum(first + k, np.repeat(w.ptr[1:], n))
    h = range_hash(w.hashes, first, last, WORD_BASES[0])
    return mix64(h ^ (last - first).astype(U64)), ptr


def segments_min(values: np.ndarray, ptr: np.ndarray, empty: int = (1 << 64) - 1) -> np.ndarray:
    """Minimum of values[ptr[d]:ptr[d+1]] for every d; ``empty`` where there are none."""
    out = np.full(len(ptr) - 1, empty, dtype=U64)
    some = ptr[1:] > ptr[:-1]
    if some.any():
        out[some] = np.minimum.reduceat(values, ptr[:-1][some])
    return out


def gather_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each range, concatenated."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1])


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.astype(U64, copy=False).view(np.int64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x > 0, by Stirling's series after shifting x above 8."""
    x = np.asarray(x, dtype=np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    while (low := y < 8).any():
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift
