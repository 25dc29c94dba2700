"""Sorting suffixes of a byte array by comparing prefix hashes.

Two suffixes are compared by their longest common extension, found by binary search over prefix
hashes, so a comparison takes a logarithmic number of steps whatever they share. The sort is a
bottom-up mergesort over all ties at once: an element's place in the merged run is its place in its
own run plus the number of elements of the other run before it, found by binary search.
"""

from __future__ import annotations

import numpy as np

from netquill.llm.hashing import LaneHash


class Suffixes:
    """Suffixes ``data[start : start + limit]`` that end at ``end`` at the latest."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, limit: int):
        self.data, self.start, self.limit = data, start, limit
        self.size = np.minimum(end - start, limit)
        self.hashed = LaneHash(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes ``a`` and ``b`` (arrays of indices)."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.size[a], self.size[b])
        x, y = self.start[a], self.start[b]
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) >> 1
            same = self.hashed.slices(x, x + mid) == self.hashed.slices(y, y + mid)
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix ``a`` sorts before ``b``; equal ones count where ``or_equal``."""
        n = self.common(a, b)
        end_a, end_b = n == self.size[a], n == self.size[b]
        last = len(self.data) - 1
        byte_a = self.data[np.minimum(self.start[a] + n, last)]
        byte_b = self.data[np.minimum(self.start[b] + n, last)]
        return np.where(end_a & end_b, or_equal, np.where(end_a, True, np.where(end_b, False, byte_a < byte_b)))

    def order(self, group: np.ndarray) -> np.ndarray:
        """Indices sorted by ``group``, then by suffix."""
        n = len(self.start)
        if n < 2:
            return np.arange(n)
        # the first eight bytes settle most of the order; what ties is merged by hash comparisons
        key = np.zeros(n, np.uint64)
        for k in range(8):
            byte = self.data[np.minimum(self.start + k, len(self.data) - 1)].astype(np.uint64)
            key = key << np.uint64(8) | np.where(k < self.size, byte, np.uint64(0))
        order = np.lexsort((key, group))
        tied = (key[order][1:] == key[order][:-1]) & (group[order][1:] == group[order][:-1])
        block = np.concatenate(([0], np.cumsum(~tied)))
        first = np.flatnonzero(np.concatenate(([True], ~tied)))
        size = np.diff(np.append(first, n))
        width = 1
        while width < size.max():
            at = np.flatnonzero(size[block] > width)
            base, length = first[block[at]], size[block[at]]
            place = at - base
            run = place // width
            other = (run ^ 1) * width
            other_size = np.clip(length - other, 0, width)
            low, high = np.zeros(len(at), np.int64), other_size.copy()
            mine = order[at]
            right = (run & 1) == 1  # equal elements of the left run go first
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                theirs = order[base[open_] + other[open_] + mid]
                before = self.less(theirs, mine[open_], right[open_])
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
            merged = order.copy()
            merged[base + (run // 2) * 2 * width + place % width + low] = mine
            order = merged
            width *= 2
        return order


def repeated_windows(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray, length: int
) -> np.ndarray:
    """Whether the ``length`` bytes at each start also begin at another start of the same group.
    Matches found by hash are confirmed byte by byte."""
    repeated = np.zeros(len(start), bool)
    full = np.flatnonzero(end - start >= length)
    if len(full) < 2:
        return repeated
    suffixes = Suffixes(data, start[full], end[full], length)
    order = suffixes.order(group[full])
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(group[full][a] == group[full][b])
    near = near[suffixes.common(a[near], b[near]) >= length]
    for part in range(0, len(near), 2048):
        pick = near[part : part + 2048]
        span = np.arange(length)
        equal = data[start[full][a[pick], None] + span] == data[start[full][b[pick], None] + span]
        pick = pick[equal.all(axis=1)]
        repeated[full[a[pick]]] = True
        repeated[full[b[pick]]] = True
    return repeated
