"""Cover trees over unit vectors and their dual traversal, on numpy arrays."""

from __future__ import annotations

import numpy as np

SLACK = 1e-9  # bounds decide only where rounding cannot matter; pairs in between are measured exactly
BLOCK = 1 << 15  # pairs of small nodes measured at once
ROWS = 256  # rows of a distance matrix measured at once


class CoverTree:
    """Nested balls with halving radii. The points of a node are ``order[first:last]``; a leaf holds one point.

    Each node's centre is one of its points and is the centre of one of its children. ``radius`` is the covering radius
    as measured: the largest distance of a point of the node from its centre.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.empty(0, np.int64)
        centre, radius, first, last, children = [], [], [], [], []
        order: list[int] = []

        def add(node_centre: int) -> int:
            centre.append(node_centre)
            radius.append(0.0)
            first.append(0)
            last.append(0)
            children.append(())
            return len(centre) - 1

        # A stack of nodes still to be opened; a node is closed when all points below it have their place.
        stack: list = [(add(0), np.arange(len(points)), 2.0)] if len(points) else []
        while stack:
            node, members, reach = stack.pop()
            if members is None:
                last[node] = len(order)
                continue
            first[node] = len(order)
            distances = self.distances(points[members], points[centre[node]])
            radius[node] = float(distances.max())
            if len(members) == 1:
                order.append(int(members[0]))
                last[node] = len(order)
                continue
            while radius[node] <= reach / 2 and reach > 1e-12:
                reach /= 2
            below, rest, away = [], members, distances
            own = centre[node]
            while len(rest):
                near = away <= reach / 2
                near |= rest == own
                below.append((add(own), rest[near], reach / 2))
                rest = rest[~near]
                if len(rest):
                    own = int(rest[0])
                    away = self.distances(points[rest], points[own])
            if len(below) == 1:  # points that rounding cannot tell apart become leaves
                below = [(below[0][0], members[:1], 0.0), *((add(int(m)), np.array([m]), 0.0) for m in members[1:])]
                centre[below[0][0]] = int(members[0])
            children[node] = tuple(b[0] for b in below)
            stack.append((node, None, 0.0))
            stack += below[::-1]
        self.order = np.array(order, np.int64)
        self.centre, self.radius = np.array(centre, np.int64), np.array(radius)
        self.first, self.last = np.array(first, np.int64), np.array(last, np.int64)
        sizes = np.array([len(c) for c in children], np.int64)
        self.child_count = sizes
        self.child_start = np.cumsum(sizes) - sizes
        self.child = np.array([c for own in children for c in own], np.int64)

    @staticmethod
    def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((points - centre) ** 2).sum(axis=1), 0))


class Links:
    """Weighted numbers of links of every point, and which points hang together."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.count = np.zeros(len(weights))
        self.parent = np.arange(len(weights))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, others: np.ndarray) -> None:
        root = self.root(x)
        for other in np.unique(self.parent[others]).tolist():
            own = self.root(other)
            if own != root:
                root, own = min(root, own), max(root, own)
                self.parent[own] = root

    def all_between(self, a: np.ndarray, b: np.ndarray) -> None:
        self.count[a] += self.weights[b].sum()
        self.count[b] += self.weights[a].sum()
        self.join(int(a[0]), b)
        self.join(int(b[0]), a)

    def all_within(self, a: np.ndarray) -> None:
        self.count[a] += self.weights[a].sum() - self.weights[a]
        self.join(int(a[0]), a)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.count, a, self.weights[b])
        np.add.at(self.count, b, self.weights[a])
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)


def _open(tree: CoverTree, nodes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of the nodes where ``which``, the nodes themselves elsewhere: (position in ``nodes``, node)."""
    counts = np.where(which, tree.child_count[nodes], 1)
    at = np.repeat(np.arange(len(nodes)), counts)
    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    opened = which[at]
    node = nodes[at]
    node[opened] = tree.child[tree.child_start[node[opened]] + step[opened]]
    return at, node


def traverse(left: CoverTree, right: CoverTree | None, linked, reach: float, links: Links, offset: int = 0) -> None:
    """Add every pair of points at distance at most ``reach`` to ``links``; with one tree, every pair within it.

    Node pairs whose balls are too far apart are dropped, pairs that lie within reach as a whole are counted as a whole,
    and of the others the wider node (both, if of similar width) is opened. Pairs of leaves are asked of ``linked``.
    ``offset`` is the number of the right tree's first point.
    """
    same = right is None
    other = left if same else right
    if not len(left.order) or not len(other.order):
        return
    work = [(np.array([0]), np.array([0]))]
    while work:
        a, b = work.pop()
        if len(a) == 1 and left.child_count[a[0]] * other.child_count[b[0]] > 4096:
            work += _open_large(left, other, int(a[0]), int(b[0]), reach, same)
            continue
        if len(a) > BLOCK:
            work += [(a[i : i + BLOCK], b[i : i + BLOCK]) for i in range(0, len(a), BLOCK)]
            continue
        own = a == b if same else np.zeros(len(a), bool)
        gap = np.sqrt(((left.points[left.centre[a]] - other.points[other.centre[b]]) ** 2).sum(axis=1))
        spread = left.radius[a] + other.radius[b]
        keep = own | (gap - spread <= reach + SLACK)
        a, b, own, gap, spread = (x[keep] for x in (a, b, own, gap, spread))
        leaves = (left.child_count[a] == 0) & (other.child_count[b] == 0)
        within = np.where(own, spread, gap + spread) <= reach - SLACK
        for x, y, self_pair in zip(a[within & ~leaves], b[within & ~leaves], own[within & ~leaves]):
            inside = left.order[left.first[x] : left.last[x]]
            if self_pair:
                links.all_within(inside)
            else:
                links.all_between(inside, offset + other.order[other.first[y] : other.last[y]])
        ends = leaves & ~own
        if ends.any():
            x, y = left.order[left.first[a[ends]]], other.order[other.first[b[ends]]]
            hit = linked(x, offset + y)
            links.pairs(x[hit], offset + y[hit])
        rest = ~leaves & ~within
        a, b, own = a[rest], b[rest], own[rest]
        wide = (left.child_count[a] * other.child_count[b]) > 4096
        work += [(a[i : i + 1], b[i : i + 1]) for i in np.flatnonzero(wide)]
        a, b, own = a[~wide], b[~wide], own[~wide]
        if len(a):
            open_a = (left.child_count[a] > 0) & (own | (left.radius[a] * 2 >= other.radius[b]) | (other.child_count[b] == 0))
            open_b = (other.child_count[b] > 0) & (own | (other.radius[b] * 2 >= left.radius[a]) | (left.child_count[a] == 0))
            at, node = _open(left, a, open_a)
            again, second = _open(other, b[at], open_b[at])
            first, was_own = node[again], own[at][again]
            once = ~was_own | (first <= second)
            first, second = first[once], second[once]
            work += [(first[i : i + BLOCK], second[i : i + BLOCK]) for i in range(0, len(first), BLOCK)]


def _open_large(left: CoverTree, other: CoverTree, a: int, b: int, reach: float, same: bool) -> list:
    """Child pairs of two nodes with many children that their balls do not rule out, by blocks of a distance matrix."""
    x = left.child[left.child_start[a] : left.child_start[a] + left.child_count[a]]
    y = other.child[other.child_start[b] : other.child_start[b] + other.child_count[b]]
    points = other.points[other.centre[y]]
    squares = (points**2).sum(axis=1)
    out = []
    for at in range(0, len(x), ROWS):
        rows = x[at : at + ROWS]
        own = left.points[left.centre[rows]]
        square = (own**2).sum(axis=1)[:, None] + squares - 2 * own @ points.T
        limit = left.radius[rows][:, None] + other.radius[y] + reach + 1e-6
        near = square <= limit**2
        if same and a == b:
            near &= rows[:, None] <= y
        i, j = np.nonzero(near)
        if len(i):
            out.append((rows[i], y[j]))
    return out
