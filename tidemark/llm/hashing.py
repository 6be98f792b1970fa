"""Polynomial hashes of stretches of bytes, for whole blocks of text at once in numpy.

Each byte maps to a random 64-bit number; sums of these times powers of an odd base, modulo
2**64, give the hash of any stretch from two running sums and a power of the inverse base.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64


@lru_cache(maxsize=4)
def _tables(seed: int) -> tuple[np.ndarray, int, int]:
    rng = np.random.default_rng([77, seed])
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + rng.integers(0, 2, 256, dtype=np.uint64)
    base = int(rng.integers(1 << 61, 1 << 62)) * 4 + 3
    return values, base, pow(base, -1, 1 << 64)


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(seed: int, inverse: bool, n: int) -> np.ndarray:
    have = _POWERS.get((seed, inverse))
    if have is None or len(have) < n:
        _, base, back = _tables(seed)
        full = np.full(max(n, 1 << 12), back if inverse else base, np.uint64)
        full[0] = 1
        have = _POWERS[seed, inverse] = np.multiply.accumulate(full)
    return have[:n]


class Stretches:
    """Hashes of stretches ``[start, stop)`` of a block of bytes."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        self.seed = seed
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_tables(seed)[0][data] * _powers(seed, False, len(data)), out=self.sums[1:])

    def plain(self, start, stop) -> np.ndarray:
        """Unmixed, so that only equal lengths may be compared by it."""
        return (self.sums[stop] - self.sums[start]) * _powers(self.seed, True, len(self.sums))[start]

    def sliding(self, width: int) -> np.ndarray:
        """Mixed hashes of all stretches of ``width``."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[width:] - self.sums[:n]) * _powers(self.seed, True, n))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits after which all bits depend on all (64-bit finaliser of a
    public hash function)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))
