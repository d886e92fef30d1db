from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.operators import evaluation as E, fairness, ranking, worklist


def brute_ap(y, s):
    total, ap, tp, n = sum(y), 0.0, 0, 0
    for level in sorted(set(s), reverse=True):
        here = [a for a, b in zip(y, s) if b == level]
        tp, n = tp + sum(here), n + len(here)
        ap += sum(here) / total * tp / n
    return ap


def brute_auc(y, s):
    pos, neg = [b for a, b in zip(y, s) if a], [b for a, b in zip(y, s) if not a]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def brute_precision(rows, fraction):
    k = max(1, math.ceil(len(rows) * fraction))
    ordered = sorted(rows, key=lambda r: (-r[2], hashlib.md5(str(r[0]).encode()).hexdigest(), r[0]))
    return sum(r[1] for r in ordered[:k]) / k


def cases():
    source = random.Random(11)
    yield "continuous", [(i, source.randrange(2), source.random()) for i in range(400)]
    yield "tied", [(i, source.randrange(2), source.randrange(4) / 4) for i in range(400)]
    yield "hot level", [(i, int(source.random() < 0.2), 0.5 if source.random() < 0.4 else source.random()) for i in range(600)]
    yield "constant", [(i, int(i % 7 == 0), 0.3) for i in range(300)]
    yield "three", [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.7)]


@pytest.mark.parametrize("name,rows", list(cases()))
def test_ranking_against_brute_force(spark, name, rows):
    df = spark.createDataFrame([(i, y, float(s)) for i, y, s in rows], "id bigint, y int, s double").repartition(5)
    y, s = [r[1] for r in rows], [r[2] for r in rows]
    found = ranking.ranking_metrics(df, "s", "y").first()
    assert found["pr_auc"] == pytest.approx(brute_ap(y, s))
    assert found["roc_auc"] == pytest.approx(brute_auc(y, s))
    assert found["brier_score"] == pytest.approx(np.mean((np.array(s) - np.array(y)) ** 2))
    fractions = [0.001, 0.05, 0.1, 0.2, 0.5, 1.0]
    for parts in (1, 6):
        at = {r["fraction"]: r["precision"] for r in ranking.precision_at(df.repartition(parts), "s", "y", "id", fractions).collect()}
        assert set(at) == set(fractions)
        for f in fractions:
            assert at[f] == pytest.approx(brute_precision(rows, f)), (name, f)


def test_step_wise_average_precision(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1)], "s double, y int")
    assert ranking.ranking_metrics(df, "s", "y").first()["pr_auc"] == pytest.approx(0.8333333)


def test_one_class_gives_null(spark):
    df = spark.createDataFrame([(0.9, 0), (0.8, 0)], "s double, y int")
    row = ranking.ranking_metrics(df, "s", "y").first()
    assert row["pr_auc"] is None and row["roc_auc"] is None and row["base_rate"] == 0.0


def test_full_metrics(spark):
    rows = list(cases())[2][1]
    df = spark.createDataFrame([(i, y, float(s)) for i, y, s in rows], "id bigint, y int, s double")
    found = E.full_metrics(df, "s", "y", "id", 0.5).first()
    tp = sum(1 for _, y, s in rows if y and s >= 0.5)
    fp = sum(1 for _, y, s in rows if not y and s >= 0.5)
    fn = sum(1 for _, y, s in rows if y and s < 0.5)
    assert (found["tp"], found["fp"], found["fn"], found["tn"]) == (tp, fp, fn, len(rows) - tp - fp - fn)
    assert found["precision_at_threshold"] == pytest.approx(tp / (tp + fp))
    assert found["recall_at_threshold"] == pytest.approx(tp / (tp + fn))
    assert found["precision_at_10pct"] == pytest.approx(brute_precision(rows, 0.10))
    by_group = E.full_metrics(df.withColumn("g", F.col("id") % 2), "s", "y", "id", 0.5, ["g"]).orderBy("g").collect()
    assert by_group[1]["precision_at_20pct"] == pytest.approx(brute_precision([r for r in rows if r[0] % 2], 0.20))
    assert by_group[0]["tp"] + by_group[1]["tp"] == tp


def test_nothing_flagged_gives_zero_not_error(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (2, 1, 0.2)], "id bigint, y int, s double")
    row = E.full_metrics(df, "s", "y", "id", 0.9).first()
    assert (row["precision_at_threshold"], row["recall_at_threshold"], row["tn"], row["fn"]) == (0.0, 0.0, 1, 1)


def test_threshold_flags_more_with_ties(spark):
    df = spark.createDataFrame([(0.0,)] * 67 + [(1.0,)] * 33, "s double")
    threshold = E.alert_volume_threshold(df, "s", 0.10).first()["threshold"]
    assert threshold == 1.0 and df.where(F.col("s") >= threshold).count() == 33


def test_calibration_bins_put_edges_below(spark):
    scores = [0.0, 0.1, 0.10000001, 0.3, 0.30000000000000004, 0.5, 0.6, 0.7, 1.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    assert [r[0] for r in df.select(E.calibration_bin(F.col("s"))).collect()] == [0, 0, 1, 2, 2, 4, 5, 6, 9]


def test_subgroups(spark):
    rows = [("a", 1, 0.9)] * 15 + [("a", 0, 0.1)] * 15 + [("b", 1, 0.9)] * 29 + [(None, 0, 0.4)] * 30
    df = spark.createDataFrame(rows, "g string, y int, s double")
    found = {r["value"]: r for r in E.subgroup_metrics(df, "s", "y", 0.5, ["g"]).collect()}
    assert set(found) == {"a", "Missing"}
    assert found["a"]["precision"] == 1.0 and found["a"]["brier_score"] == pytest.approx(0.01)
    assert found["Missing"]["brier_score"] is None and found["Missing"]["precision"] == 0.0


def test_f_scores(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(0, 0)] * 4, "y int, p int")
    row = E.prediction_metrics(df, "y", "p").first()
    p, r = 3 / 4, 3 / 5
    assert row["f1"] == pytest.approx(2 * p * r / (p + r)) and row["f2"] == pytest.approx(5 * p * r / (4 * p + r))
    assert row["f0_5"] == pytest.approx(1.25 * p * r / (0.25 * p + r)) and row["false_positive_rate"] == pytest.approx(0.2)


def test_bias(spark):
    rows = [("x", 1, 1)] * 20 + [("x", 0, 0)] * 20 + [("y", 0, 1)] * 10 + [("y", 1, 0)] * 30 + [(None, 0, 0)] * 20
    df = spark.createDataFrame(rows, "f string, y int, p int")
    found = {r["value"]: r for r in fairness.bias_metrics(df, {"f": None}, "y", "p").collect()}
    assert set(found) == {"x", "y"}
    x = found["x"]
    assert (x["n_facet"], x["n_other"]) == (40, 60)  # NULL facets are part of "other"
    assert x["class_imbalance"] == pytest.approx(0.2) and x["disparate_impact"] == pytest.approx(0.5 / (10 / 60))
    assert x["recall_difference"] == pytest.approx(1.0 - 0.0) and x["accuracy_other"] == pytest.approx(20 / 60)
    assert x["within_four_fifths"] == 0


def test_bias_without_selected_complement(spark):
    df = spark.createDataFrame([("x", 0, 1)] * 30 + [("y", 0, 0)] * 30, "f string, y int, p int")
    row = fairness.bias_metrics(df, {"f": ["x"]}, "y", "p").first()
    assert row["disparate_impact"] is None and row["recall_facet"] is None and row["within_four_fifths"] == 0


def test_worklist(spark):
    rows = [("a", 0.5), ("b", 0.9), ("c", 0.5), ("d", None), ("e", 0.1)]
    df = spark.createDataFrame(rows, "id string, s double").repartition(4)
    plain = worklist.worklist(df, "id", "s", 0.5).collect()
    assert [(r["id"], r["flag"]) for r in plain] == [("b", 1), ("a", 1), ("c", 1), ("e", 0), ("d", 0)]
    ranked = worklist.ranked_worklist(df, "id", "s", 0.5).collect()
    assert [(r["rank"], r["id"]) for r in ranked] == [(1, "b"), (2, "a"), (2, "c"), (4, "e"), (None, "d")]
