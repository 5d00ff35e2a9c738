"""R-tree over count vectors. A point counts, per group of hashed shingles, how
many of a set's shingles fall into the group. Two sets share at most the sum
of the smaller counts, and a set shares with any member of a node at most the
sum of its counts' minima with the node's upper corner, so a node below the
overlap that a partner needs is left out with all below it."""

from __future__ import annotations

import numpy as np

FAN = 16
LEAST_GROUPS = 64


def groups_for(n: int) -> int:
    """Number of groups for a set of ``n`` shingles: a power of two."""
    return max(LEAST_GROUPS, 1 << max(0, (n - 1) // 2).bit_length())


def count_vector(hashes: np.ndarray) -> np.ndarray:
    """8-bit counts; where a count would not fit, there are more groups."""
    groups = groups_for(hashes.size)
    while True:
        counts = np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
        if counts.max(initial=0) < 256:
            return counts.astype(np.uint8)
        groups *= 2


def fold(counts: np.ndarray, groups: int) -> np.ndarray:
    """Counts over fewer groups (the last axis)."""
    wide = counts.astype(np.uint16)
    while wide.shape[-1] > groups:
        half = wide.shape[-1] // 2
        wide = wide[..., :half] + wide[..., half:]
    return wide


def needed(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Smallest overlap of sets of n and m with 100 * overlap >= percent *
    union."""
    return -(-percent * (n + m) // (100 + percent))


class CountRTree:
    """Points packed by size and then by their largest-variance groups."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.counts, self.sizes = counts, sizes
        spread = np.argsort(-counts.var(0), kind="stable")[:2] if len(sizes) else []
        self.order = np.lexsort((*[counts[:, g] for g in spread[::-1]], sizes)) if len(sizes) else np.arange(0)
        level = (counts[self.order], sizes[self.order], sizes[self.order])
        self.levels = [level]  # corners, smallest and largest size, from the points up
        while len(level[1]) > FAN:
            at = np.arange(0, len(level[1]), FAN)
            level = (np.maximum.reduceat(level[0], at, axis=0), np.minimum.reduceat(level[1], at),
                     np.maximum.reduceat(level[2], at))
            self.levels.append(level)

    def search(self, counts: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Points that may reach the overlap, in no order."""
        rows = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, low, high = self.levels[depth]
            fits = (100 * low[rows] <= (10000 * size) // percent) & (10000 * high[rows] >= 100 * percent * size)
            rows = rows[fits]
            bound = np.minimum(corner[rows], counts).sum(1, dtype=np.int64)
            rows = rows[bound >= needed(np.maximum(low[rows], 0), size, percent)]
            if depth:
                rows = (rows[:, None] * FAN + np.arange(FAN)).ravel()
                rows = rows[rows < len(self.levels[depth - 1][1])]
        return self.order[rows]


def may_link(a: np.ndarray, n: int, b: np.ndarray, m: int, percent: int) -> bool:
    """The bound for one pair."""
    groups = min(a.size, b.size)
    return int(np.minimum(fold(a, groups), fold(b, groups)).sum(dtype=np.int64)) >= needed(n, m, percent)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test on sorted distinct hashes."""
    if min(a.size, b.size) * 100 < percent * max(a.size, b.size):
        return False
    shared = np.intersect1d(a, b, assume_unique=True).size
    return 100 * shared >= percent * (a.size + b.size - shared)
