"""Content-chosen anchors for windows of a fixed number of units (bytes or words).

Of the ``w = window - k + 1`` k-grams in a window, the one with the least hash is its anchor. Equal
windows have equal anchors at equal places, so windows whose anchor's hash occurs once in the corpus
occur once too and can be left out without looking at them. Consecutive windows with one anchor form
a segment; there are about ``2 / (w + 1)`` segments per unit.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 28) - 1)
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, n.bit_length())
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (_BASE, _INVERSE)]
    return _powers[0][:n], _powers[1][:n]


class SpanHash:
    """Hashes of byte spans from one pass of prefix sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power(len(data) + 1)
        self.sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1])]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        h ^= h >> np.uint64(31)
        h *= _MIX
        h ^= h >> np.uint64(29)
        return h


#: Units whose windows are cut at once; the places within must fit ``_PLACE``.
PIECE = 1 << 22


def _piece(h: np.ndarray, owner: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor place of every segment."""
    m, w = len(owner) - window + 1, window - k + 1
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    place = np.minimum(low[:m], low[w - size : w - size + m]) & _PLACE
    valid = np.flatnonzero(owner[:m] == owner[window - 1 :])
    if not len(valid):
        return (np.zeros(0, np.int64),) * 3
    place = place[valid].astype(np.int64)
    new = np.r_[True, (place[1:] != place[:-1]) | (valid[1:] != valid[:-1] + 1)]
    head = np.flatnonzero(new)
    return valid[head], np.diff(np.r_[head, len(valid)]), place[head]


def segments(data: np.ndarray, start: np.ndarray, end: np.ndarray, owner: np.ndarray, k: int, window: int, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor place and anchor hash of every segment.

    ``start`` and ``end`` are the units' byte places in ``data``, ``owner`` the document of each. Windows are
    cut ``piece`` at a time; a segment that a cut parts is two segments, which cover the same windows.
    """
    out = []
    for lo in range(0, len(start) - window + 1, piece):
        hi = min(lo + piece + window - 1, len(start))
        h = SpanHash(data[start[lo] : end[hi - 1]])(start[lo : hi - k + 1] - start[lo], end[lo + k - 1 : hi] - start[lo])
        s, n, place = _piece(h, owner[lo:hi], k, window)
        out.append((s + lo, n, place + lo, h[place]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + size), one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by half-open spans."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
