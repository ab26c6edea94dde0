"""A learned index from ranks to sorted offsets: error-bounded lines and stored residuals.

``RankIndex`` fits straight segments through the points (rank, offset), each within
``error`` of all its points, and stores what each point misses its line by as a small
integer.  ``offset(ranks)`` finds the segment, predicts, and adds the residual, which
gives the stored offset exactly.

Segments are found for all points at once: a piece of the points whose chord misses some
point by more than the bound is cut in the middle, until all pieces hold.  A piece of two
points has no error, so the depth is at most log2 of the number of points.

Defined results for odd input: no offsets give an index without segments, one offset a
single flat segment; repeated offsets are points like any others.
"""

from __future__ import annotations

import numpy as np


class RankIndex:
    """Offsets (ascending integers) as lines and residuals."""

    def __init__(self, offsets: np.ndarray, error: int = 120):
        if error < 1:
            raise ValueError("the error bound must be at least 1")
        offsets = np.asarray(offsets, np.int64)
        self.error, self.size = error, len(offsets)
        self.first, self.base, self.slope = _segments(offsets, error)
        guess = self._predict(np.arange(self.size))
        kind = np.int8 if error <= 127 else np.int32
        self.residuals = (offsets - guess).astype(kind)

    def _predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[at] + np.rint((ranks - self.first[at]) * self.slope[at]).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        """The offsets of the given ranks: prediction and correction."""
        ranks = np.asarray(ranks, np.int64)
        if not len(ranks):
            return np.empty(0, np.int64)
        return self._predict(ranks) + self.residuals[ranks]


def _segments(offsets: np.ndarray, error: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rank, offset there and slope of each segment."""
    n = len(offsets)
    lo, hi = np.array([0][:n], np.int64), np.array([n][:n], np.int64)  # pieces still to be tried
    firsts, slopes = [], []
    while len(lo):
        size = hi - lo
        slope = (offsets[hi - 1] - offsets[lo]) / np.maximum(size - 1, 1)
        start = np.cumsum(size) - size
        inside = np.arange(size.sum()) - np.repeat(start, size)
        points = offsets[np.repeat(lo, size) + inside]
        guess = np.repeat(offsets[lo], size) + np.rint(inside * np.repeat(slope, size)).astype(np.int64)
        held = np.maximum.reduceat(np.abs(points - guess), start) <= error
        firsts.append(lo[held])
        slopes.append(slope[held])
        lo, hi = lo[~held], hi[~held]
        middle = (lo + hi) // 2
        lo, hi = np.concatenate([lo, middle]), np.concatenate([middle, hi])
    first = np.concatenate([*firsts, np.empty(0, np.int64)])
    slope = np.concatenate([*slopes, np.empty(0)])
    order = np.argsort(first)
    first = first[order]
    return first, offsets[first], slope[order]
