"""Hamming links in one shard of fingerprints, by a BK-tree.

A child hangs under its parent by its integer distance to it, and every
fingerprint is a node.  A query follows, from a node at distance d, only the
edges d - radius .. d + radius: by the triangle inequality no fingerprint below
another edge is near it.  The tree is built, and blocks of queries go down, level
by level.  What hangs below a node and is of the query's class already is left
out: it has no link to add.
"""

from __future__ import annotations

import numpy as np

QUERIES = 256  # that go down together
BITS = 64


class Classes:
    """Union-find over positions, with unions and lookups of whole arrays."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def of(self, x: np.ndarray) -> np.ndarray:
        root = self.up[x]
        while True:
            above = self.up[root]
            if np.array_equal(above, root):
                self.up[x] = root
                return root
            root = above

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            a, b = self.of(x), self.of(y)
            apart = a != b
            if not apart.any():
                return
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


class Tree:
    """The nodes are the positions of ``prints``; the first one is the root."""

    def __init__(self, prints: np.ndarray):
        n = len(prints)
        self.prints = prints
        self.parent = np.full(n, -1)
        edge = np.zeros(n, np.int64)
        self.levels = [np.zeros(min(n, 1), np.int64)]
        rest, at = np.arange(1, n), np.zeros(max(n - 1, 0), np.int64)
        while len(rest):
            far = np.bitwise_count(prints[rest] ^ prints[at]).astype(np.int64)
            _, first, place = np.unique(at * (BITS + 1) + far, return_index=True, return_inverse=True)
            nodes = rest[first]  # the first of those with one parent and distance; the others go below it
            self.parent[nodes], edge[nodes] = at[first], far[first]
            self.levels.append(nodes)
            below = np.ones(len(rest), bool)
            below[first] = False
            rest, at = rest[below], nodes[place][below]
        key = self.parent * (BITS + 2) + edge
        self.children = np.argsort(key, kind="stable")[min(n, 1):]  # without the root
        # where the children of a node with edge d or more begin, for d up to one beyond the last
        self.start = np.searchsorted(key[self.children], np.arange(n * (BITS + 2))).reshape(n, BITS + 2)

    def of_one_class(self, root: np.ndarray) -> np.ndarray:
        """The class of all that hangs at a node, or -1 where there are several."""
        one = root.copy()
        for nodes in reversed(self.levels[1:]):
            up = self.parent[nodes]
            one[up[(one[nodes] != root[up])]] = -1
        return one

    def near(self, queries: np.ndarray, radius: int, query_class: np.ndarray, one: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, int]:
        """(query, node) numbers within ``radius`` bits, and how many distances were taken."""
        found, taken = ([], []), 0
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        while len(query):
            new = one[node] != query_class[query]
            query, node = query[new], node[new]
            taken += len(query)
            far = np.bitwise_count(queries[query] ^ self.prints[node]).astype(np.int64)
            close = far <= radius
            found[0].append(query[close])
            found[1].append(node[close])
            low = self.start[node, np.maximum(far - radius, 0)]
            n = self.start[node, np.minimum(far + radius, BITS) + 1] - low
            query = np.repeat(query, n)
            node = self.children[np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
        none = np.zeros(0, np.int64)
        return np.concatenate([*found[0], none]), np.concatenate([*found[1], none]), taken


def link(tree: Tree, queries: np.ndarray, radius: int, same: Classes, offset: int) -> int:
    """Joins, in ``same``, the tree's nodes (positions from 0 on) with the queries
    (from ``offset`` on) within ``radius`` bits; returns how many distances were taken."""
    n, taken = len(tree.prints), 0
    if not n:
        return 0
    for a in range(0, len(queries), QUERIES):
        part = queries[a:a + QUERIES]
        root = same.of(np.arange(n))
        which = np.arange(offset + a, offset + a + len(part))
        query, node, more = tree.near(part, radius, same.of(which), tree.of_one_class(root))
        same.join(which[query], node)
        taken += more
    return taken


def classes(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each of the distinct ``prints`` (uint64, ascending), the position of
    the least one that it reaches over links of at most ``radius`` bits."""
    same = Classes(len(prints))
    link(Tree(prints), prints, radius, same, 0)
    return same.of(np.arange(len(prints)))
