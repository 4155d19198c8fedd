"""Hashes of the words of a text, worked out with numpy for the whole text at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; as many as the longest text so far needed are kept."""
    out = _powers.get(base)
    if out is None or len(out) < n:
        have, out = 1, np.ones(max(1 << 12, 1 << (n - 1).bit_length()), U)
        while have < len(out):
            out[have : 2 * have] = out[:have] * U(pow(base, have, 1 << 64))
            have *= 2
        _powers[base] = out
    return out[:n]


BASE = 0x9E3779B97F4A7C15 | 1
BACK = pow(BASE, -1, 1 << 64)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word of one text, given as its bytes."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, U)
    # Within a word the sum of byte values times falling powers; one running sum gives all.
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(byte_values()[data] * powers(BASE, len(data)), out=sums[1:])
    back = powers(BACK, int(starts[-1]) + 1)
    lengths = (ends - starts).astype(U)
    return mixed((sums[ends] - sums[starts]) * back[starts] + lengths)
