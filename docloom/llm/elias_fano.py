"""Elias-Fano coded monotone sequences with select, on numpy.

``n`` values of a sequence below ``u`` take about ``2 + log2(u / n)`` bits each: the low ``l`` bits
of every value are packed as they are, the high parts are coded in unary in one bit vector, and a
sample of every 256th one-bit lets ``select`` find any value without decoding the sequence.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQB7x")
#: One-bits between two samples of the select structure.
SAMPLE = 256


class EliasFano:
    """A monotone sequence; ``encode`` builds it, ``to_bytes``/``from_bytes`` store it, ``select(i)`` returns value ``i``."""

    def __init__(self, n: int, u: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.u, self.low, self.high, self.samples = n, u, low, high, samples
        self.l = self.low_bits(n, u)

    @staticmethod
    def low_bits(n: int, u: int) -> int:
        return max(0, (u // n).bit_length() - 1) if n else 0

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n, u = len(v), int(v[-1]) + 1 if len(v) else 0
        if n and (v[1:] < v[:-1]).any():
            raise ValueError("the sequence must not fall")
        l = cls.low_bits(n, u)
        bits = ((v[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if l else np.zeros((n, 0), np.uint8)
        ones = (v >> np.uint64(l)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, u, np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), ones[::SAMPLE].astype(np.uint64))

    def to_bytes(self) -> bytes:
        return _HEAD.pack(self.n, self.u, self.l) + struct.pack("<QQ", len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, u, _ = _HEAD.unpack_from(data)
        a, b = struct.unpack_from("<QQ", data, _HEAD.size)
        at = _HEAD.size + 16
        whole = np.frombuffer(data, np.uint8)
        return cls(n, u, whole[at : at + a], whole[at + a : at + a + b], np.frombuffer(data, "<u8", -(-n // SAMPLE), at + a + b))

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for k in range(self.l):
            at = i * self.l + k
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(k)
        return out

    def select(self, i: int) -> int:
        """Value ``i``: from the nearest sample on, bytes of the unary part are skipped by their number of ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) & (0xFF << (at & 7))
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return (one - i) << self.l | int(self._low(np.array([i]))[0])

    def select_range(self, lo: int, hi: int) -> np.ndarray:
        """Values ``lo`` to ``hi - 1``, found from the sample before ``lo`` on."""
        if hi <= lo:
            return np.zeros(0, np.int64)
        first = lo // SAMPLE
        start = int(self.samples[first])
        stop = int(self.samples[(hi - 1) // SAMPLE + 1]) if (hi - 1) // SAMPLE + 1 < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[start >> 3 : -(-stop // 8)], bitorder="little")
        ones = np.flatnonzero(bits[start & 7 :])[lo - first * SAMPLE : hi - first * SAMPLE] + start
        i = np.arange(lo, hi)
        return ((ones - i).astype(np.uint64) << np.uint64(self.l) | self._low(i)).astype(np.int64)
