from __future__ import annotations

import random

import pytest

from riskmart.llm.components import connected_components


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(60)],  # a chain
    [(0, i) for i in range(1, 300)] + [(500, 501)],  # a star
    [(1, 1), (None, 3), (4, 5), (5, 4), (4, 5)],
    [(a, b) for r in [random.Random(1)] for a, b in [(r.randrange(80), r.randrange(80)) for _ in range(60)]],
    [],
])
def test_roots(spark, links):
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    root = {x: x for pair in links if None not in pair and pair[0] != pair[1] for x in pair}
    for _ in root:
        for a, b in links:
            if a in root and b in root and a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert found == root
