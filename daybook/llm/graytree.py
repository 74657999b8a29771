"""A hierarchical index over 64-bit patterns in Gray order, for all patterns within a few differing bits.

Neighbours in Gray order share most bits. Runs of FAN items form a node that keeps the bits all its items agree on
(``mask`` says which, ``bits`` which way); runs of nodes form nodes above. What a node's parent already fixes is left
out of its own mask, so a search adds up differences from the top down and drops a whole group as soon as the sum
exceeds the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FAN = 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Pairs of query and node that one step of a search holds.
FRONT = 1 << 17


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each pattern in the Gray code: the code's inverse, by exclusive or of all its right shifts."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayTree:
    """Over items in Gray order: patterns, or pages of patterns given by the bits they agree on."""

    def __init__(self, bits: np.ndarray, mask: np.ndarray | None = None):
        mask = np.full(len(bits), ALL) if mask is None else mask
        levels = [(bits, mask)]
        while len(levels[-1][0]) > FAN:
            b, m = levels[-1]
            starts = np.arange(0, len(b), FAN)
            agreed = np.bitwise_and.reduceat(m, starts)
            ones, zeros = np.bitwise_and.reduceat(b, starts), np.bitwise_and.reduceat(~b, starts)
            levels.append((ones, agreed & (ones | zeros)))
        self.levels = levels[::-1]
        self.own = [self.levels[0][1]]
        for (_, above), (_, m) in zip(self.levels, self.levels[1:], strict=False):
            self.own.append(m & ~np.repeat(above, FAN)[: len(m)])

    def within(self, queries: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, item) numbers of all pairs with at most ``most`` differences in the bits that the item fixes."""
        top = len(self.levels[0][0])
        if not top:
            return
        step = max(1, FRONT // (top * FAN))
        for first in range(0, len(queries), step):
            some = np.arange(first, min(first + step, len(queries)))
            todo = [(0, np.repeat(some, top), np.tile(np.arange(top), len(some)), None)]
            while todo:
                level, q, node, sofar = todo.pop()
                if len(q) > FRONT:
                    half = len(q) // 2
                    for part in (slice(half), slice(half, None)):
                        todo.append((level, q[part], node[part], None if sofar is None else sofar[part]))
                    continue
                found = np.bitwise_count((queries[q] ^ self.levels[level][0][node]) & self.own[level][node])
                found = found if sofar is None else found + sofar
                near = found <= most
                q, node, found = q[near], node[near], found[near]
                if level + 1 == len(self.levels):
                    yield q, node
                elif len(q):
                    below = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    real = below < len(self.levels[level + 1][0])
                    todo.append((level + 1, np.repeat(q, FAN)[real], below[real], np.repeat(found, FAN)[real]))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest number connected with each of 0 .. n-1 by the links a[i], b[i]."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(up := root[root], root):
            root = up
    return root
