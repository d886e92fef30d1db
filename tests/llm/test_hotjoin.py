from __future__ import annotations

import pytest

from riskmart.llm.hotjoin import join_unique


@pytest.mark.parametrize("hot", [2, 10_000])
def test_equals_a_left_join(spark, hot):
    rows = [(i, "a" if i % 2 else None if i % 7 == 0 else f"k{i % 5}") for i in range(60)]
    table = [("a", 1), ("k1", 2), ("k2", None), ("unused", 4)]
    found = join_unique(spark.createDataFrame(rows, "id long, k string"), spark.createDataFrame(table, "k string, v long"), ["k"], hot)
    known = dict(table)
    assert sorted((r.id, r.k, r.v) for r in found.collect()) == [(i, k, known.get(k)) for i, k in rows]


def test_empty_sides(spark):
    none = spark.createDataFrame([], "k string, v long")
    rows = spark.createDataFrame([(1, "a")], "id long, k string")
    assert [tuple(r) for r in join_unique(rows, none, ["k"], 0).select("id", "v").collect()] == [(1, None)]
    assert join_unique(rows.limit(0), none, ["k"]).collect() == []
