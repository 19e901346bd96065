"""Ordinal tries as balanced parentheses.

A trie of sorted paths is written in preorder, one opening and one closing
parenthesis a node. ``excess`` is the number of open nodes after each place.
Blocks of it keep their minimum, and a binary tree over the blocks the minima of
ranges, so the closing parenthesis of a node (``findclose``) is found in its own
block or by a climb and a descent. Between both parentheses lies the subtree:
``rank`` of the pairs ``()`` counts its leaves, and cumulative arrays in preorder
give sums over it.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
SLICE = 8192  # nodes looked up at a time
NONE = np.iinfo(np.int64).max


class Parentheses:
    def __init__(self, opening: np.ndarray) -> None:
        self.opening = opening
        size = -(-max(len(opening), 1) // BLOCK) * BLOCK
        excess = np.full(size, np.iinfo(np.int32).max, np.int32)
        excess[: len(opening)] = np.cumsum(np.where(opening, 1, -1))
        self.excess = excess.reshape(-1, BLOCK)
        self.minima = [self.excess.min(1)]
        while len(self.minima[-1]) > 1:
            level = self.minima[-1]
            if len(level) % 2:
                level = np.append(level, np.iinfo(np.int32).max).astype(np.int32)
                self.minima[-1] = level
            self.minima.append(np.minimum(level[::2], level[1::2]))
        leaf = np.zeros(len(opening) + 1, np.int64)
        leaf[1:-1] = opening[:-1] & ~opening[1:]
        self._leaves = np.cumsum(leaf)

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Pairs ``()`` that begin before ``place``."""
        return self._leaves[place]

    def findclose(self, place: np.ndarray) -> np.ndarray:
        out = np.zeros(len(place), np.int64)
        for at in range(0, len(place), SLICE):
            out[at:at + SLICE] = self._findclose(place[at:at + SLICE])
        return out

    def _findclose(self, place: np.ndarray) -> np.ndarray:
        block, inside = place // BLOCK, place % BLOCK
        target = self.excess[block, inside] - 1
        hit = (self.excess[block] <= target[:, None]) & (np.arange(BLOCK) > inside[:, None])
        out = block * BLOCK + hit.argmax(1)
        far = np.flatnonzero(~hit.any(1))
        if len(far):
            found = self._next_block(block[far], target[far])
            hit = self.excess[found] <= target[far, None]
            out[far] = found * BLOCK + hit.argmax(1)
        return out

    def _next_block(self, block: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First later block whose minimum is at most ``target``."""
        node, level = block.copy(), np.full(len(block), -1)
        waiting = np.arange(len(block))
        for height, minima in enumerate(self.minima):
            right = node[waiting] + 1
            can = (right % 2 == 1) & (minima[np.minimum(right, len(minima) - 1)] <= target[waiting])
            node[waiting] = np.where(can, right, node[waiting] // 2)
            level[waiting[can]] = height
            waiting = waiting[~can]
        for height in range(len(self.minima) - 1, 0, -1):
            down = np.flatnonzero(level >= height)
            left = node[down] * 2
            node[down] = np.where(self.minima[height - 1][left] <= target[down], left, left + 1)
        return node


def common_prefixes(digests: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each path and the one before it;
    ``digests`` (rows x words) holds the paths one after another."""
    start = np.cumsum(sizes) - sizes
    path = np.repeat(np.arange(len(sizes)), sizes)
    depth = np.arange(len(digests)) - start[path]
    before = np.where(path > 0, sizes[path - 1], 0)
    same = depth < before
    at = np.flatnonzero(same)
    same[at] = (digests[at] == digests[start[path[at] - 1] + depth[at]]).all(1)
    out = sizes.copy()
    differ = np.flatnonzero(~same)
    rows, first = np.unique(path[differ], return_index=True)
    out[rows] = depth[differ[first]]
    return out


class Trie:
    """The trie of sorted paths, with the root as node 0 and the nodes in
    preorder. ``ends[i]`` is the node of path ``i``, ``source[v]`` the row of
    ``digests`` that made node ``v`` (-1: root)."""

    def __init__(self, digests: np.ndarray, sizes: np.ndarray, want_paths: bool = False) -> None:
        shared = common_prefixes(digests, sizes)
        fresh = sizes - shared
        start = np.cumsum(sizes) - sizes
        first = 1 + np.cumsum(fresh) - fresh
        n = 1 + int(fresh.sum())
        self.depth, self.source = np.zeros(n, np.int64), np.full(n, -1)
        owner = np.repeat(np.arange(len(sizes)), fresh)
        self.depth[1:] = np.arange(1, n) - first[owner] + shared[owner] + 1
        self.source[1:] = start[owner] + self.depth[1:] - 1
        self.parent = np.arange(-1, n - 1)
        self.ends = np.zeros(len(sizes), np.int64)
        stack, paths = [0], []
        for i, (keep, new, node) in enumerate(zip(shared.tolist(), fresh.tolist(), first.tolist(), strict=True)):
            del stack[keep + 1:]
            if new:
                self.parent[node] = stack[keep]
                stack.extend(range(node, node + new))
            self.ends[i] = stack[-1]
            if want_paths or i in (0, len(sizes) - 1):
                paths.append(np.array(stack))
        self.paths = paths  # nodes from the root down: of all paths, or the first and the last
        counts = np.zeros(2 * len(sizes) + 2, np.int64)  # opened and closed in turn
        counts[0] = 1
        counts[2:-1:2] = fresh
        counts[3:-1:2] = sizes[:-1] - shared[1:]
        counts[-1] = sizes[-1] + 1
        opening = np.repeat(np.arange(len(counts)) % 2 == 0, counts)
        self.tree = Parentheses(opening)
        self.open = np.flatnonzero(opening)
        self.close = self.tree.findclose(self.open)
        self.last = np.arange(n) + (self.close - self.open + 1) // 2  # end of the subtree in preorder

    def leaves(self) -> np.ndarray:
        return self.tree.rank(self.close + 1) - self.tree.rank(self.open)

    def is_leaf(self) -> np.ndarray:
        return self.last == np.arange(len(self.last)) + 1

    def below(self, weights: np.ndarray) -> np.ndarray:
        """Sum of ``weights`` over each subtree, its top included."""
        total = np.concatenate([np.zeros(1, weights.dtype), np.cumsum(weights)])
        return total[self.last] - total[:-1]

    def least(self, values: np.ndarray) -> np.ndarray:
        """Minimum of ``values`` over each subtree."""
        pairs = np.stack([np.arange(len(values)), self.last], 1).ravel()
        return np.minimum.reduceat(np.append(values, NONE), pairs)[::2]
