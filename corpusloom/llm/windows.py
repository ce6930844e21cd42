"""Query-centred windows on sorted projection arrays, as bitmaps.

The points of a block are sorted along each direction, on a grid of ``STEP``. Bitmap k of an array holds its first k points, so the
points inside a window are the exclusive or of the bitmaps at its two ends, whose places a table of the grid gives. A larger
radius only moves the ends (virtual rehashing). In how many windows each point lies is counted in bit planes by carry-save adders, 64 points an operation.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import zip_longest

import numpy as np

POINTS = 1024  # of a block
QUERIES = 512  # at a time
STEP = 1 / 128
REACH = 4.5  # projections of unit vectors on normal directions beyond it share the outermost step
GRID = int(2 * REACH / STEP)


def on_grid(h: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((h + REACH) / STEP), 0, GRID - 1).astype(np.int32)


class Bitmaps:
    """Bitmaps of one shape whose memory is used again: allocation costs more than the operations."""

    def __init__(self, shape: tuple[int, int]):
        self.shape, self.free = shape, []

    def take(self) -> np.ndarray:
        return self.free.pop() if self.free else np.empty(self.shape, np.uint64)

    def add(self, a: np.ndarray, b: np.ndarray, c: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Sum and carry of two or three bitmaps, which are used up."""
        total = np.bitwise_xor(a, b, out=self.take())
        carry = np.bitwise_and(a, b, out=a)
        if c is not None:
            np.bitwise_and(total, c, out=b)
            np.bitwise_or(carry, b, out=carry)
            np.bitwise_xor(total, c, out=total)
            self.free.append(c)
        self.free.append(b)
        return total, carry

    def count(self, bitmaps: Iterator[np.ndarray]) -> list[np.ndarray]:
        """The bits, lowest first, of the number of bitmaps that hold each point."""
        held: list[list[np.ndarray]] = [[]]
        for x in bitmaps:
            held[0].append(x)
            level = 0
            while len(held[level]) == 3:
                total, carry = self.add(*held[level])
                held[level] = [total]
                level += 1
                if level == len(held):
                    held.append([])
                held[level].append(carry)
        out, carry = [], None
        for terms in held:
            terms = terms if carry is None else [*terms, carry]
            total, carry = self.add(*terms) if len(terms) > 1 else (terms[0], None)
            out.append(total)
        return out if carry is None else [*out, carry]

    def at_least(self, planes: list[np.ndarray], least: int) -> np.ndarray:
        """Bitmap of the points whose count, given by its bits, is at least ``least``; the planes are used up."""
        wanted = [int(b) for b in f"{least:b}"[::-1]]
        greater, equal, both = self.take(), self.take(), self.take()
        greater[...], equal[...] = 0, ~np.uint64(0)
        for plane, bit in reversed(list(zip_longest(planes, wanted))):
            if plane is None:
                equal[...] = 0  # a bit that no count reaches
            elif bit:
                np.bitwise_and(equal, plane, out=equal)
            else:
                np.bitwise_and(equal, plane, out=both)
                np.bitwise_or(greater, both, out=greater)
                np.bitwise_xor(equal, both, out=equal)
        np.bitwise_or(greater, equal, out=greater)
        self.free += [equal, both, *planes]
        return greater


class SortedArrays:
    """One sorted array a direction over at most ``POINTS`` points, given by their places on the grid (directions x points)."""

    def __init__(self, grid: np.ndarray):
        m, n = grid.shape
        order = np.argsort(grid, axis=1, kind="stable")
        counts = np.bincount((grid + np.arange(m)[:, None] * GRID).ravel(), minlength=m * GRID).reshape(m, GRID)
        self.ends = np.zeros((m, GRID + 1), np.int32)  # of each step of the grid: how many points lie below it
        np.cumsum(counts, axis=1, out=self.ends[:, 1:])
        self.first = np.zeros((m, n + 1, -(-n // 64)), np.uint64)
        rows, place = np.arange(m)[:, None], np.arange(1, n + 1)[None, :]
        self.first[rows, place, order >> 6] = np.uint64(1) << (order & 63).astype(np.uint64)
        np.bitwise_or.accumulate(self.first, axis=1, out=self.first)

    def collided(self, grid: np.ndarray, half: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) of the points within ``half`` steps of a query in at least ``least`` arrays. ``grid`` is directions x queries."""
        below, above = np.maximum(grid - half, 0), np.minimum(grid + half + 1, GRID)
        queries, points = [], []
        pool = Bitmaps((0, 0))
        for at in range(0, grid.shape[1], QUERIES):
            low, high = below[:, at : at + QUERIES], above[:, at : at + QUERIES]
            if pool.shape[0] != low.shape[1]:
                pool = Bitmaps((low.shape[1], self.first.shape[2]))

            def windows() -> Iterator[np.ndarray]:
                for ends, first, a, b in zip(self.ends, self.first, low, high):
                    inside, outside = pool.take(), pool.take()
                    first.take(ends.take(b), axis=0, out=inside, mode="clip")
                    first.take(ends.take(a), axis=0, out=outside, mode="clip")
                    np.bitwise_xor(inside, outside, out=inside)
                    pool.free.append(outside)
                    yield inside

            hits = pool.at_least(pool.count(windows()), least)
            q, word = np.nonzero(hits)
            if len(q):
                bits = np.unpackbits(hits[q, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                k, bit = np.nonzero(bits)
                queries.append(q[k] + at)
                points.append(word[k] * 64 + bit)
            pool.free.append(hits)
        if not queries:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(queries), np.concatenate(points)
