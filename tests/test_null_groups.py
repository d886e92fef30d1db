"""Groups that are NULL, models that are missing on one side, scores that are no numbers."""

from __future__ import annotations

import math

import pytest

from riskmart.operators import evaluation, monitoring, ordering, profiling, ranking, worklist
from riskmart.operators.joins import join_groups

ROWS = [(g, i, (i * 7 % 10) / 10, int(i % 3 == 0)) for g in ("a", "b", None) for i in range(30)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, "g string, id int, score double, label int")


def test_joins_keep_null_groups(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (2, 2, "z")], "p int, q int, v string")
    b = spark.createDataFrame([(1, None, 10), (None, None, 20), (3, 3, 30)], "p int, q int, w int")
    assert {tuple(r) for r in join_groups(a, b, ["p", "q"]).collect()} == {(1, None, "x", 10), (None, None, "y", 20)}
    full = {tuple(r) for r in join_groups(a, b, ["p", "q"], "full").collect()}
    assert full == {(1, None, "x", 10), (None, None, "y", 20), (2, 2, "z", None), (3, 3, None, 30)}


def test_every_group_has_its_metrics(scored):
    metrics = {r.g: r for r in ranking.ranking_metrics(scored, "score", "label", ["g"]).collect()}
    assert set(metrics) == {"a", "b", None} and len({(r.pr_auc, r.roc_auc) for r in metrics.values()}) == 1
    cut = ranking.precision_at(scored, "score", "label", "id", [0.05, 0.5], ["g"]).collect()
    assert len(cut) == 6 and len({(r.fraction, r.precision) for r in cut}) == 2
    quantiles = profiling.exact_quantiles(scored, "score", [0.1, 0.9], ["g"]).collect()
    assert len(quantiles) == 6 and len({(r.q, r.value) for r in quantiles}) == 2
    first = ordering.first_in_hash_order(scored.selectExpr("*", "5 AS need"), "id", "need", ["g"]).collect()
    assert {g: sum(r.g == g for r in first) for g in ("a", "b", None)} == {"a": 5, "b": 5, None: 5}


def test_models_without_a_threshold_stay(scored):
    validation = scored.where("g = 'a'").withColumnRenamed("g", "model")
    rows = {r.model: r for r in evaluation.comparison_table(validation, scored.withColumnRenamed("g", "model"), "label", "id").collect()}
    assert set(rows) == {"a", "b", None}
    assert rows["b"].recall_at_thr is None and rows["b"].pr_auc == rows["a"].pr_auc and rows["a"].recall_at_thr is not None


def test_rows_without_label_take_no_part(spark, scored):
    more = scored.unionByName(spark.createDataFrame([("a", 99, 0.95, None), ("a", 98, float("nan"), 1)], scored.schema))
    whole = [ranking.ranking_metrics(df.where("g = 'a'"), "score", "label").first() for df in (scored, more)]
    assert whole[0] == whole[1]


def test_infinities_and_nan_have_a_place(spark):
    values = [float("-inf"), 1.0, 2.0, float("inf"), float("inf"), float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None])], "id int, score double")
    ranked = [(r["rank"], r.id) for r in worklist.ranked_worklist(df, "id", "score", 1.5).collect()]
    assert ranked == [(1, 3), (1, 4), (1, 5), (4, 2), (5, 1), (6, 0), (None, 6), (None, 7)]
    finite = df.where("not isnan(score)")
    quantiles = [r.value for r in profiling.exact_quantiles(finite, "score", [0.2, 1.0]).orderBy("q").collect()]
    assert quantiles == [1.0, math.inf]


def test_clean_runs_report_zero(spark):
    none = spark.createDataFrame([], "feature string, constraint_check_type string, description string")
    assert [tuple(r) for r in monitoring.violation_counts(none).collect()] == [(None, 0)]


def test_sorted_levels(spark):
    values = ["b", "a", "abcd", "abce", "", "é", None, "a"]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "t string, n int")
    rows = {(r.column, r.position): r.level for r in profiling.sorted_levels(df, ["t", "n"]).collect()}
    wanted = sorted({v for v in values if v is not None}, key=lambda v: v.encode())
    assert rows == {**{("t", i): v for i, v in enumerate(wanted)}, ("n", 0): "0", ("n", 1): "1"}
