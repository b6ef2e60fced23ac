"""Hashes of all windows of a sequence at once, from prefix sums."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Random odd value of each byte.
BYTE_VALUES = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of a 64-bit hash."""
    h = (h ^ np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(29)
    return h


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Windows:
    """``hashes(starts, length)`` of a sequence of 64-bit values, equal for equal windows wherever they lie.

    The prefix sums of values times powers of an odd base, modulo 2^64, give any window in a few operations.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers(_BASE, len(values))[:-1], out=self.sums[1:])
        self.back = powers(_INVERSE, len(values))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def all(self, length: int) -> np.ndarray:
        n = max(0, len(self.sums) - length)
        return mixed((self.sums[length:] - self.sums[:n]) * self.back[:n]) if n else np.empty(0, np.uint64)
