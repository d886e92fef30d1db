from __future__ import annotations

import numpy as np
import pytest

from riskmart.llm import embeddings
from riskmart.llm.covertree import CoverTree, Links, traverse

TABLE = "vec_id long, embedding array<float>, label int, node string, weight string"


def clustered(seed, clusters, members, dims=8, spread=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims))
    points = np.concatenate([c / np.linalg.norm(c) + spread * rng.normal(size=(members, dims)) for c in centres])
    return points.astype(np.float32)


def by_comparing(rows, threshold=0.93):
    """Links and components from all pairs."""
    def usable(v, label):
        return v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ids = [r[0] for r in rows]
    links = {i: set() for i in range(len(rows))}
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i < j and a[0] is not None and b[0] is not None and usable(a[1], a[2]) and usable(b[1], b[2]) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    root = dict(enumerate(ids))
    for _ in rows:
        before = dict(root)
        for i, others in links.items():
            for j in others:
                root[i] = min(root[i], root[j])
        if root == before:
            break
    return sorted(((ids[i], len(links[i]), root[i], ids[i] is not None and ids[i] == root[i]) for i in links), key=str)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], TABLE)
    return sorted((tuple(r) for r in embeddings.near_duplicates(frame, **options).collect()), key=str)


@pytest.mark.parametrize("cell, levels", [(8192, 12), (25, 12), (25, 1), (25, 0)])  # small cells are split, or cut by hash
def test_equals_comparing(spark, monkeypatch, cell, levels):
    monkeypatch.setattr(embeddings, "LEVELS", levels)
    monkeypatch.setattr(embeddings, "PIVOTS", 4)
    points = np.concatenate([clustered(1, 12, 12), clustered(2, 1, 60, spread=0.03), clustered(3, 40, 1)])
    rows = [(int(i * 3 + 1), p.tolist(), int(i % 7 < 5)) for i, p in enumerate(points)]
    rows += [(5000 + i, rows[0][1], rows[0][2]) for i in range(30)]  # copies
    rows += [(6000, [2 * x for x in rows[0][1]], rows[0][2])]
    assert found(spark, rows, cell=cell) == by_comparing(rows)


def test_odd_rows(spark):
    v = [1.0, 0.0, 0.0]
    rows = [
        (1, v, 0), (2, v, 0), (2, v, 0), (3, v, None), (4, None, 0), (5, [0.0, 0.0, 0.0], 0), (6, [1.0, None, 0.0], 0), (7, [float("nan"), 0.0, 1.0], 0),
        (8, [float("inf"), 0.0, 0.0], 0), (9, [], 0), (10, [1.0, 0.0], 0), (11, [1e-30, 0.0, 0.0], 0), (None, v, 0), (12, v, 1), (13, [0.0, 1.0, 0.0], 0),
    ]
    got = found(spark, rows)
    assert got == by_comparing(rows)
    assert (None, 0, None, False) in got
    assert found(spark, []) == []


@pytest.mark.parametrize("reach", [0.05, 0.37, 1.2])
def test_traversal_equals_all_pairs(reach):
    points = clustered(4, 6, 30, spread=0.05).astype(float)
    points = np.concatenate([points / np.linalg.norm(points, axis=1)[:, None]] * 1)
    points = np.concatenate([points, points[:3]])  # points at distance zero
    weights = np.random.default_rng(1).integers(1, 5, len(points)).astype(float)
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    near = gaps <= reach
    np.fill_diagonal(near, False)

    def linked(x, y):
        return gaps[x, y] <= reach

    links = Links(weights)
    traverse(CoverTree(points), None, linked, reach, links)
    assert np.allclose(links.count, near @ weights)
    half = len(points) // 2
    links = Links(weights)
    traverse(CoverTree(points[:half]), CoverTree(points[half:]), linked, reach, links, half)
    near[:half, :half] = near[half:, half:] = False
    assert np.allclose(links.count, near @ weights)
    same = {(i, j) for i, j in zip(*np.nonzero(near))}
    assert all(links.root(i) == links.root(j) for i, j in same)


def test_tree_is_nested_with_covering_radii():
    points = clustered(5, 10, 20).astype(float)
    tree = CoverTree(points)
    assert sorted(tree.order) == list(range(len(points)))
    for node in range(len(tree.centre)):
        inside = tree.order[tree.first[node] : tree.last[node]]
        away = CoverTree.distances(points[inside], points[tree.centre[node]])
        assert np.isclose(away.max(), tree.radius[node])
        children = tree.child[tree.child_start[node] : tree.child_start[node] + tree.child_count[node]]
        if len(children):
            assert sum(tree.last[c] - tree.first[c] for c in children) == len(inside)
            assert tree.centre[node] in tree.centre[children]
