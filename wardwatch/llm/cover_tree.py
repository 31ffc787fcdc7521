"""Cover trees over norm-augmented integer vectors, searched for inner products.

With one more component, sqrt(M^2 - |x|^2), every vector x has the length M of the
longest; a query gets 0 there, so inner products stay as they are and the nearest
vector is the one of largest inner product.  A node covers its rows within its
radius; its children's centres lie more than half of that apart and cover it at half of it.

The search goes through the nodes best first, all queries at once.  Each
query has a window of scores; a node in which no score of the window that would still enter
the query's list is possible is skipped, and rows are verified by exact products.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np

LEAF = 16                      # rows of a node that is not divided
STEP = 256                     # rows verified at once
LOW, HIGH = -(1 << 62), 1 << 62
EXACT = float(1 << 53)


class Node(NamedTuple):
    centre: int                # row of its centre
    radius: float
    rows: np.ndarray           # rows that no child holds
    children: list[int]


class Tree(NamedTuple):
    x: np.ndarray              # integers, rows in the order of their ids
    ids: np.ndarray
    longest: float
    nodes: list[Node]          # the root first


def grow(x: np.ndarray, ids: np.ndarray, k: int) -> Tree:
    """Tree over rows ``x`` for searches of up to ``k`` rows besides the query
    itself: of equal rows the ``k`` + 1 smallest ids are enough."""
    order = np.argsort(ids, kind="stable")
    _, same = np.unique(x[order], axis=0, return_inverse=True)
    by_copy = np.argsort(same.ravel(), kind="stable")
    starts = np.flatnonzero(np.diff(same.ravel()[by_copy], prepend=-1))
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    order = order[np.sort(by_copy[place <= k])]
    x, ids = x[order], ids[order]
    y = x.astype(np.float64)
    square = (y ** 2).sum(axis=1)
    lift = np.sqrt(square.max() - square)
    gap = square[:, None] + square - 2 * y @ y.T + (lift[:, None] - lift) ** 2
    np.sqrt(np.maximum(gap, 0, out=gap), out=gap)
    nodes: list[Node] = []
    todo = [(np.arange(len(x)), 0, -1)]
    while todo:
        rows, centre, parent = todo.pop()
        if parent >= 0:
            nodes[parent].children.append(len(nodes))
        radius = float(gap[centre, rows].max())
        if len(rows) <= LEAF or radius == 0:
            nodes.append(Node(centre, radius, rows, []))
            continue
        left, centres = rows[np.argsort(rows != centre, kind="stable")], []
        while len(left):                               # a net: apart by more than half, all within half
            centres.append(left[0])
            left = left[gap[left[0], left] > radius / 2]
        near = np.array(centres)[gap[np.ix_(centres, rows)].argmin(axis=0)]
        order = np.argsort(near, kind="stable")
        groups = np.split(rows[order], np.flatnonzero(np.diff(near[order])) + 1)
        alone = [g for g in groups if len(g) == 1]
        nodes.append(Node(centre, radius, np.sort(np.concatenate(alone)) if alone else np.zeros(0, np.int64), []))
        here = len(nodes) - 1
        todo += [(g, int(near[np.searchsorted(rows, g[0])]), here) for g in groups if len(g) > 1]
    return Tree(x, ids, float(np.sqrt(square.max())), nodes)


class Lists(NamedTuple):
    """The best scores and ids of each query so far, best first (LOW: none yet)."""
    score: np.ndarray
    ids: np.ndarray

    @classmethod
    def empty(cls, n: int, k: int) -> Lists:
        return cls(np.full((n, k), LOW, np.int64), np.full((n, k), HIGH, np.int64))

    def enter(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of rows ``ids`` (ascending) for ``items``; LOW: no candidate."""
        k = self.score.shape[1]
        pick = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        found = np.take_along_axis(scores, pick, axis=1)
        score = np.concatenate([self.score[items], found], axis=1)
        name = np.concatenate([self.ids[items], np.where(found > LOW, ids[pick], HIGH)], axis=1)
        order = np.lexsort((name, -score), axis=1)[:, :k]
        self.score[items] = np.take_along_axis(score, order, axis=1)
        self.ids[items] = np.take_along_axis(name, order, axis=1)


class Queries(NamedTuple):
    """Query vectors, and items: a window of scores for a query each."""
    x: np.ndarray              # integers
    own: np.ndarray            # ids, never their own answer
    at: np.ndarray             # query of each item
    lo: np.ndarray
    hi: np.ndarray


def _bounds(tree: Tree, node: Node, q: Queries, norm: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that each item can have in a node: by its centre's score
    and the radius, and by the triangle inequality on the sphere of all rows."""
    asked, back = np.unique(q.at[items], return_inverse=True)
    middle = (q.x[asked].astype(np.float64) @ tree.x[node.centre].astype(np.float64))
    size, m = norm[asked], tree.longest
    low, high = middle - size * node.radius, middle + size * node.radius
    if m > 0:
        ratio = np.where(size > 0, size, 1.0) / m
        far = np.sqrt(np.maximum(2 * m * m - 2 * middle / ratio, 0))
        near = (m * m - np.maximum(far - node.radius, 0) ** 2 / 2) * ratio
        away = (m * m - (far + node.radius) ** 2 / 2) * ratio
        some = size > 0
        low, high = np.where(some, np.maximum(low, away), low), np.where(some, np.minimum(high, near), high)
    slack = 1e-6 * size * m + 1e-6
    return (low - slack)[back], (high + slack)[back]


def search(tree: Tree, q: Queries, items: np.ndarray, best: Lists) -> int:
    """Enter the rows of ``tree`` that lie in the items' windows into ``best``;
    the number of rows verified."""
    norm = np.sqrt((q.x.astype(np.float64) ** 2).sum(axis=1))
    exact = q.x.shape[1] * np.abs(q.x).max(initial=0) * np.abs(tree.x).max(initial=0) < EXACT
    mine, rows = (q.x.astype(np.float64), tree.x.astype(np.float64)) if exact else \
        (q.x.astype(np.int64), tree.x.astype(np.int64))
    heap: list = []
    verified = 0

    def push(n: int, items: np.ndarray) -> None:
        if len(items):
            low, high = _bounds(tree, tree.nodes[n], q, norm, items)
            live = (low <= q.hi[items]) & (high >= np.maximum(q.lo, best.score[:, -1])[items])
            if live.any():
                heapq.heappush(heap, (-float(high[live].max()), n, items[live], high[live]))

    push(0, items)
    while heap:
        _, n, items, high = heapq.heappop(heap)
        items = items[high >= np.maximum(q.lo, best.score[:, -1])[items]]      # lists are fuller by now
        node = tree.nodes[n]
        for lo in range(0, len(node.rows) if len(items) else 0, STEP):
            at = node.rows[lo: lo + STEP]
            asked, back = np.unique(q.at[items], return_inverse=True)
            score = (mine[asked] @ rows[at].T).astype(np.int64)[back]
            verified += score.size
            fits = ((score <= q.hi[items][:, None]) & (tree.ids[at] != q.own[q.at[items]][:, None])
                    & (score >= np.maximum(q.lo, best.score[:, -1])[items][:, None]))
            some = fits.any(axis=1)
            if some.any():
                best.enter(items[some], np.where(fits[some], score[some], LOW), tree.ids[at])
        for child in node.children:
            push(child, items)
    return verified
