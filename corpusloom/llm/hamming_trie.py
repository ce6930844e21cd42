"""Self-join of binary codes within a Hamming budget by walking pairs of trie nodes.

Sorted codes *are* a binary trie: a node at depth t is a range of codes that agree on t bits. The walk starts from (root, root) of
every group at once and goes down level by level; a pair of nodes whose paths differ in more bits than the budget allows is dropped
with all that lies below it. Pairs of small nodes are finished by counting the differing bits of their members. All steps are
array operations over the whole frontier; the frontier is halved onto a stack when it grows, so memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF_PRODUCT = 24
FRONTIER = 1 << 17
BITS = 128


def _expand(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ranges, in pieces of bounded size; of a range with itself each pair once."""
    product = (a1 - a0) * (b1 - b0)
    cuts = np.flatnonzero(np.diff(np.cumsum(product) // (FRONTIER * 8))) + 1
    for part in np.split(np.arange(len(product)), cuts):
        if not len(part):
            continue
        p = product[part]
        which = np.repeat(part, p)
        k = np.arange(len(which)) - np.repeat(np.cumsum(p) - p, p)
        width = (b1 - b0)[which]
        i, j = a0[which] + k // width, b0[which] + k % width
        keep = (a0[which] != b0[which]) | (i < j)
        yield i[keep], j[keep]


def trie_self_join(high: np.ndarray, low: np.ndarray, left: np.ndarray, right: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of codes at most ``budget`` bits apart.

    ``high``/``low`` are the halves of 128-bit codes (uint64), sorted within each range. ``left`` and ``right`` are arrays of
    ranges (n x 2); row k asks for the pairs between ``left[k]`` and ``right[k]``, within the range where they are the same.
    """
    start = (left[:, 0].astype(np.int64), left[:, 1].astype(np.int64), right[:, 0].astype(np.int64), right[:, 1].astype(np.int64), np.zeros(len(left), np.int16))
    stack = [(0, start)]
    ones: dict[int, np.ndarray] = {}
    while stack:
        depth, (a0, a1, b0, b1, err) = stack.pop()
        while len(a0):
            if len(a0) > FRONTIER:
                half = len(a0) // 2
                stack.append((depth, tuple(x[half:] for x in (a0, a1, b0, b1, err))))
                a0, a1, b0, b1, err = (x[:half] for x in (a0, a1, b0, b1, err))
                continue
            small = ((a1 - a0) * (b1 - b0) <= LEAF_PRODUCT) | (depth == BITS)
            if small.any():
                for i, j in _expand(a0[small], a1[small], b0[small], b1[small]):
                    near = np.bitwise_count(high[i] ^ high[j]).astype(np.int16) + np.bitwise_count(low[i] ^ low[j]) <= budget
                    if near.any():
                        yield i[near], j[near]
                a0, a1, b0, b1, err = (x[~small] for x in (a0, a1, b0, b1, err))
                if not len(a0):
                    break
            if depth not in ones:
                word, shift = (high, 63 - depth) if depth < 64 else (low, 127 - depth)
                ones[depth] = np.r_[0, np.cumsum((word >> np.uint64(shift)) & np.uint64(1), dtype=np.int64)]
            count = ones[depth]
            am, bm = a1 - (count[a1] - count[a0]), b1 - (count[b1] - count[b0])
            same = a0 == b0
            cross = ~same
            # both to 0, both to 1, left 0 with right 1; for two different nodes also left 1 with right 0
            a0, a1, b0, b1, err = (
                np.concatenate([a0, am, a0, am[cross]]),
                np.concatenate([am, a1, am, a1[cross]]),
                np.concatenate([b0, bm, bm, b0[cross]]),
                np.concatenate([bm, b1, b1, bm[cross]]),
                np.concatenate([err, err, err + 1, err[cross] + 1]),
            )
            depth += 1
            keep = (a0 < a1) & (b0 < b1) & (err <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
            a0, a1, b0, b1, err = (x[keep] for x in (a0, a1, b0, b1, err))
