"""Vectorised rolling hashes over byte and word sequences (numpy, 64 bits).

Prefix sums of ``digit[i] * BASE**-i`` give the Rabin-Karp hash of any range
in one subtraction and one product (mod 2**64, BASE odd, digits mixed).
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, a bijection of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


DIGIT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64; the longest table made so far is kept."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        step = np.full(max(n, 1 << 20), base, np.uint64)
        step[0] = 1
        kept = _POWERS[base] = np.multiply.accumulate(step)
    return kept[:n]


def prefix(digits: np.ndarray) -> np.ndarray:
    out = np.zeros(len(digits) + 1, np.uint64)
    np.cumsum(digits * _powers(_INVERSE, len(digits)), out=out[1:])
    return out


def range_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of digits[start:end] for arrays of ranges."""
    return (p[end] - p[start]) * _powers(BASE, len(p))[start]


def window_hash(p: np.ndarray, size: int) -> np.ndarray:
    """Hash of every range of ``size`` digits."""
    n = len(p) - size
    return (p[size:] - p[:n]) * _powers(BASE, len(p))[:n]


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix(DIGIT[data])


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte position and 64-bit hash of every word (run of non-space bytes)."""
    inside = ~SPACE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, np.zeros(0, np.uint64)
    h = range_hash(byte_prefix(data), start, end)
    return start, mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
