"""A wavelet matrix: token ids as bit-planes with rank and select, in one compressed byte string.

Plane by plane, from the highest bit, the ids are split stably into those with a 0 and those with a 1. A
token's place in the next plane is its rank among its kind, so a few ranks give the token at a position, the
number of its occurrences before a position, and, backwards, the place of its k-th occurrence.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WMX1"
RANK_BYTES = 64  # bytes of a plane per entry of its rank directory
HEADER = "<4sQBI"

_BITS_SET = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def encode(ids: np.ndarray, bits: int) -> bytes:
    """Header, then per plane: number of zeros, ones before every RANK_BYTES bytes, and the plane, compressed."""
    x = np.ascontiguousarray(ids, dtype=np.uint16 if bits <= 16 else np.uint32)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    parts = []
    for k in range(bits - 1, -1, -1):
        one = (x >> k & 1).astype(bool)
        plane = np.packbits(one)
        x = np.concatenate([np.compress(~one, x), np.compress(one, x)])  # faster than a mask as index
        ones = np.add.reduceat(_BITS_SET[plane], np.arange(0, len(plane), RANK_BYTES), dtype=np.uint32) if len(plane) else []
        ranks = np.concatenate([[0], np.cumsum(ones)]).astype("<u4").tobytes()
        body = squeeze(plane.tobytes())
        parts.append(struct.pack("<QII", len(ids) - int(one.sum()), len(ranks), len(body)) + ranks + body)
    return struct.pack(HEADER, MAGIC, len(ids), bits, RANK_BYTES) + b"".join(parts)


class WaveletMatrix:
    """Reads what ``encode`` wrote."""

    def __init__(self, blob: bytes) -> None:
        magic, self.n, self.bits, self.block = struct.unpack_from(HEADER, blob)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        at, self.zeros, self.ranks, self.planes = struct.calcsize(HEADER), [], [], []
        size, loosen = (self.n + 7) // 8, zstandard.ZstdDecompressor()
        for _ in range(self.bits):
            zeros, n_ranks, n_body = struct.unpack_from("<QII", blob, at)
            at += struct.calcsize("<QII")
            self.zeros.append(zeros)
            self.ranks.append(np.frombuffer(blob, "<u4", n_ranks // 4, at))
            at += n_ranks
            plane = loosen.decompress(blob[at : at + n_body], max_output_size=size + 1)
            self.planes.append(np.frombuffer(plane, np.uint8))
            at += n_body

    def decode(self) -> np.ndarray:
        """All ids: the splits undone from the last plane up."""
        x = np.zeros(self.n, dtype=np.uint16 if self.bits <= 16 else np.uint32)
        for k, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1])):
            one = np.unpackbits(plane, count=self.n).view(bool)
            before = np.empty_like(x)
            before[np.flatnonzero(~one)] = x[:zeros]
            before[np.flatnonzero(one)] = x[zeros:] | x.dtype.type(1 << k)
            x = before
        return x

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        plane, whole = self.planes[level], i // 8
        block = whole // self.block
        count = int(self.ranks[level][block]) + int(_BITS_SET[plane[block * self.block : whole]].sum())
        return count + (int(_BITS_SET[plane[whole] >> (8 - i % 8)]) if i % 8 else 0)

    def _place(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of that kind in a plane."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._ones(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.bits):
            bit = int(self.planes[level][i // 8] >> (7 - i % 8)) & 1
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` among the first ``i`` ids lie after the last plane."""
        low, high = 0, i
        for level in range(self.bits):
            a, b = self._ones(level, low), self._ones(level, high)
            if value >> (self.bits - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, value: int, i: int) -> int:
        """Occurrences of ``value`` among the first ``i`` ids."""
        if value >> self.bits:
            return 0
        low, high = self._range(value, i)
        return high - low

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``value``."""
        if not 0 <= k < self.count(value):
            raise IndexError(k)
        i = self._range(value, self.n)[0] + k
        for level in range(self.bits - 1, -1, -1):
            bit = value >> (self.bits - 1 - level) & 1
            i = self._place(level, bit, i - self.zeros[level] if bit else i)
        return i

    def positions(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]
