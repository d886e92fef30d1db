"""Work of the shared steps follows the input."""

from __future__ import annotations

import os

import pytest

from riskmart.queries import tables
from riskmart.session import METHOD_LIMIT, compiled_methods, materialise

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_encounter_tasks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_A_TASK", 20)
    found = tables.encounters(spark, FOLDER)
    n = tables.table(spark, FOLDER, "orders").count()
    assert found.rdd.getNumPartitions() == -(-n // 20) > 3 * spark.sparkContext.defaultParallelism
    assert found.count() == n


@pytest.mark.parametrize("before", [None, "65535"])
def test_method_limit_holds_inside_only(spark, before):
    name, limit = METHOD_LIMIT
    found = spark.conf.get(name, None)
    try:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
        outside = spark.conf.get(name, None)
        with pytest.raises(ZeroDivisionError), compiled_methods(spark):
            assert spark.conf.get(name) == limit
            1 / 0
        assert spark.conf.get(name, None) == outside
        assert materialise(spark.range(3), "limited").count() == 3
        assert spark.conf.get(name, None) == outside
    finally:
        spark.conf.set(name, found) if found else spark.conf.unset(name)


def test_spread_rows_are_written_where_they_are(spark, tmp_path):
    from riskmart.sources import catalog

    rows = spark.range(0, 600, 1, 3).selectExpr("id", "concat('split', id % 4) AS split")
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    catalog.create_database(spark, "spread_checks")
    for spread, files in ((True, 3), (False, 1)):
        table, path = f"spread_checks.t{spread}", f"{tmp_path}/{spread}"
        catalog.write_partitioned(rows, table, path, spread=spread)
        assert len(list((tmp_path / str(spread) / "split=split1").glob("part-*"))) == files  # no shuffle: one of each task
        found = [tuple(r) for r in catalog.read_partition(spark, table, "split1").collect()]
        assert sorted(found) == [(i, "split1") for i in range(1, 600, 4)]
    assert spark.conf.get(name, None) == before
