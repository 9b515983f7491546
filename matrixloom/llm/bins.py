"""Best-fit-decreasing with a segment tree over capacities, and lower bounds by dual feasible functions."""

from __future__ import annotations

import numpy as np


class Capacities:
    """A segment tree over residual capacities: each node counts the open bins below it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, residual: int, number: int) -> None:
        self.bins[residual].append(number)
        i = residual + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin of the least residual that is at least ``size``: (residual, number)."""
        count, i = self.count, size + self.leaves
        if not count[i]:
            # Up until a right sibling holds a bin, then down to its leftmost leaf.
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        residual = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return residual, self.bins[residual].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item (in decreasing size, then as given), and how many bins."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    tree, used = Capacities(capacity), 0
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        found = tree.take(size)
        if found is None:
            found = capacity, used
            used += 1
        residual, number = found
        bins[i], offsets[i] = number, capacity - residual
        if residual > size:
            tree.add(residual - size, number)
    return bins, offsets, used


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """No packing of items of these sizes has fewer bins."""
    return bound_of(np.bincount(sizes, minlength=capacity + 1), capacity)


def bound_of(counts: np.ndarray, capacity: int, most: int = 24) -> int:
    """No packing of ``counts[s]`` items of each size s has fewer bins: the best of three families of dual feasible functions.

    Identity; the threshold functions (large items count whole, items below the threshold nothing); and rounding
    to multiples of capacity / (k + 1), which keeps exact multiples.
    """
    counts = counts.astype(np.int64)
    values = np.arange(capacity + 1)
    mass = np.cumsum(counts * values)
    number = np.cumsum(counts)
    best = -(-int(mass[-1]) // capacity)
    t = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - t]
    middle = mass[capacity - t] - mass[t - 1]
    best = max(best, int((large + -(-middle // capacity)).max(initial=0)))
    for k in range(1, most):
        scaled = (k + 1) * values
        weight = np.where(scaled % capacity == 0, values * k, scaled // capacity * capacity)  # times k * capacity
        best = max(best, -(-int((counts * weight).sum()) // (k * capacity)))
    return best
