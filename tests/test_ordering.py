"""Ordering blocks against brute force, on data in which one key or one score holds a third of all rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.config import DEFAULT_SPLITS
from riskmart.operators import ordering, splitting
from riskmart.operators.profiling import clipped_histogram, exact_quantiles


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    source = random.Random(3)
    rows = [(i, 0 if source.random() < 0.34 else source.randrange(400), round(source.random(), 3), source.randrange(2)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id bigint, entity bigint, x double, y int")


@pytest.mark.parametrize("cuts", [[], [0.5], [0.1, 0.2, 0.2001, 0.9], [-5.0, 7.0]])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(skewed, cuts, descending):
    rows, df = skewed
    levels = df.withColumn("g", F.col("id") % 2).groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    found = {(r["g"], r["x"]): (r["n_before"], r["n_total"]) for r in ordering.running_totals(
        levels, "x", ["n"], ["g"], descending, cuts).collect()}
    for g in (0, 1):
        xs = [r[2] for r in rows if r[0] % 2 == g]
        for x in set(xs):
            before = sum(v > x if descending else v < x for v in xs)
            assert found[(g, x)] == (before, len(xs))


@pytest.mark.parametrize("n", [0, 1, 700, 2999, 3000, 5000])
def test_sample_is_exact_and_independent_of_partitions(skewed, n):
    rows, df = skewed
    expected = sorted(sorted((r[0] for r in rows), key=lambda i: (md5(f"42:{i}"), i))[:n])
    for parts in (1, 17):
        assert sorted(r[0] for r in ordering.sample_rows(df.repartition(parts), n, "id", 42).select("id").collect()) == expected


def test_first_in_hash_order_per_group(skewed):
    rows, df = skewed
    grouped = df.withColumn("g", F.when(F.col("id") % 3 > 0, 1).otherwise(0)).withColumn("need", F.when(F.col("g") == 1, 900).otherwise(5))
    found = {}
    for r in ordering.first_in_hash_order(grouped, "id", "need", ["g"]).collect():
        found.setdefault(r["g"], set()).add(r["id"])
    for g, need in ((0, 5), (1, 900)):
        ids = [r[0] for r in rows if (r[0] % 3 > 0) == bool(g)]
        assert found[g] == set(sorted(ids, key=lambda i: (md5(str(i)), i))[:need])


@pytest.mark.parametrize("fractions", [DEFAULT_SPLITS, {"a": 0.5, "b": 0.5}, {"a": 1.0, "b": 0.0}, {"a": 0.0, "b": 0.25, "c": 0.75}])
def test_exact_split(skewed, fractions):
    rows, df = skewed
    entities = sorted({r[1] for r in rows}, key=lambda e: (md5(f"42:{e}"), e))
    bounds = np.cumsum(list(fractions.values()))
    expected = {}
    for i, e in enumerate(entities):
        expected[e] = next(n for n, b in zip(fractions, bounds) if i < int(b * len(entities)) or n == list(fractions)[-1])
    for parts in (1, 13):
        out = splitting.assign_exact_split(df.repartition(parts), "entity", 42, fractions)
        assert {(r["entity"], r["split"]) for r in out.select("entity", "split").distinct().collect()} == set(expected.items())


def test_hash_split(spark, skewed):
    rows, df = skewed
    out = splitting.assign_hash_split(df.repartition(7), "entity", 42, DEFAULT_SPLITS).select("entity", "split").distinct().collect()
    assert len(out) == len({r[1] for r in rows})
    for r in out:
        u = int(md5(f"42:{r['entity']}")[:8], 16) / 2**32
        assert r["split"] == ("train" if u < 0.4 else "validation" if u < 0.5 else "test" if u < 0.6 else "production")
    nulls = spark.createDataFrame([(None,), ("a",)], "entity string")
    for assign in (splitting.assign_hash_split, splitting.assign_exact_split):
        assert assign(nulls, "entity", 42, DEFAULT_SPLITS).where("entity is null").first()["split"] is None
    with pytest.raises(ValueError, match="sum to 1"):
        splitting.split_by_hash(F.col("entity"), 42, {"a": 0.5})


def test_quantiles(skewed):
    rows, df = skewed
    qs = [0.0, 0.1, 0.37, 0.5, 0.9, 1.0]
    found = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df.withColumn("g", F.col("id") % 2), "x", qs, ["g"]).collect()}
    for g in (0, 1):
        xs = [r[2] for r in rows if r[0] % 2 == g]
        for q in qs:
            assert found[(g, q)] == pytest.approx(np.quantile(xs, q), abs=1e-12)


def test_quantile_of_one_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert exact_quantiles(df, "x", [0.9]).first()["value"] == 5.0


def test_histogram(skewed, spark):
    rows, df = skewed
    xs = np.array([r[2] for r in rows])
    clipped = np.minimum(xs, np.quantile(xs, 0.99))
    expected, _ = np.histogram(clipped, bins=30)
    found = [r["n"] for r in clipped_histogram(df, "x").orderBy("bin").collect()]
    assert sum(found) == len(xs) and np.abs(np.array(found) - expected).max() <= 3  # edge rounding
    same = clipped_histogram(spark.createDataFrame([(2.0,)] * 4, "x double"), "x").where("n > 0").collect()
    assert [(r["bin"], r["n"]) for r in same] == [(15, 4)]
