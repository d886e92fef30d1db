from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskmart.operators import attribution, modeling as M, search
from riskmart.operators.ranking import ranking_metrics
from riskmart.plans import evaluation as jobs, monitoring as monitor_jobs

FEATURES = ["race", "n", "m"]


@pytest.fixture(scope="module")
def data(spark):
    source, rows = random.Random(5), []
    for i in range(1200):
        race, n, m = source.choice(["a", "b", None]), source.gauss(2, 3), source.randrange(5)
        p = 1 / (1 + math.exp(-(0.8 * n - 2 + (1.0 if race == "a" else 0.0))))
        rows.append((f"id{i}", race, n, m, int(source.random() < p), m % 2, source.randrange(4), source.randrange(3)))
    df = spark.createDataFrame(rows, "encounter_id string, race string, n double, m int, readmit_30 int, gender int, number_inpatient int, number_emergency int")
    bucket = F.abs(F.xxhash64("encounter_id")) % 10
    return df.where(bucket < 6).cache(), df.where((bucket >= 6) & (bucket < 8)).cache(), df.where(bucket >= 8).cache()


def test_logistic_optimum(data):
    """Gradient of the penalised objective, computed with numpy on the scaled features, is zero at the fit."""
    train = data[0]
    schema = M.feature_schema(train, FEATURES, "readmit_30")
    assert schema.categorical == ("race",) and schema.order == FEATURES
    model = M.fit_logistic(train, schema, "readmit_30")
    rows = model.transform(train).select(vector_to_array("features").alias("x"), "readmit_30").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["readmit_30"] for r in rows])
    assert x.shape[1] == 5  # levels Missing, a, b plus two numbers
    assert np.allclose(x[:, 3:].mean(0), 0, atol=1e-9) and np.allclose(x[:, 3:].std(0), 1)
    w, b = M.coefficients(model)
    error = 1 / (1 + np.exp(-(x @ np.array(w) + b))) - y
    assert np.abs(x.T @ error + np.array(w)).max() < 1e-2 and abs(error.sum()) < 1e-2


def test_plain_logistic_and_platt_optimum(data, spark):
    model = M.fit_plain_logistic(data[0], ["n"], "readmit_30")
    scored = M.add_score(data[1], model)
    a, b = M.fit_platt(scored, "score", "readmit_30")
    rows = scored.select("score", "readmit_30").collect()
    s, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    error = 1 / (1 + np.exp(-(a * s + b))) - y
    assert abs((s * error).sum() + a) < 1e-2 and abs(error.sum()) < 1e-2


def test_unseen_and_null_levels(data, spark):
    train = data[0]
    odd = spark.createDataFrame([("z", 1.0, 1), (None, 1.0, 1), ("a", 1.0, 1)], "race string, n double, m int")
    schema = M.feature_schema(train, FEATURES, "readmit_30")
    encoded = M.encoder(schema).fit(train)
    assert M.category_levels(encoded) == {"race": ["a", "b"]}
    assert [r[0] for r in encoded.transform(odd).select("race__level").collect()] == [2.0, 2.0, 0.0]
    slots = M.fit_logistic(train, schema, "readmit_30").transform(odd).select(vector_to_array("race__slots")).collect()
    assert [list(r[0]) for r in slots] == [[0, 0, 0], [1, 0, 0], [0, 1, 0]]


def test_bundle(data, spark, tmp_path):
    train, validation, test = data
    schema = M.feature_schema(train, FEATURES, "readmit_30")
    model = M.fit_boosted(train, schema, "readmit_30", {"max_depth": 2, "num_round": 4, "eta": 0.3}, validation)
    path = str(tmp_path / "bundle")
    M.save_bundle(spark, path, model, schema, 4.0, -2.0, 0.5, 0.10, "now")
    bundle = M.load_bundle(spark, path)
    assert bundle.feature_schema["feature_order"] == FEATURES and bundle.threshold["selected_on"] == "validation"
    scored = bundle.score(test, "encounter_id", ["readmit_30"])
    assert scored.columns == ["encounter_id", "readmit_30", "probability", "prediction"] and scored.count() == test.count()
    direct = M.add_score(test, model).select("encounter_id", F.expr("1 / (1 + exp(-(4.0D * score - 2.0D)))").alias("p"))
    assert scored.join(direct, "encounter_id").where("abs(p - probability) > 1e-9").count() == 0
    assert ranking_metrics(scored, "probability", "readmit_30").first()["roc_auc"] > 0.7
    with pytest.raises(ValueError, match="model input"):
        bundle.score(test, "race")
    with pytest.raises(Exception):
        bundle.score(test.drop("n"), "encounter_id")
    report = monitor_jobs.model_quality_job(bundle, validation, test, "encounter_id", "readmit_30")
    assert report["current"].count() == 10
    with pytest.raises(FileNotFoundError, match="lacks"):
        M.load_bundle(spark, str(tmp_path / "nothing"))
    M._write_json(spark, str(tmp_path / "half/calibrator"), {"a": 1.0, "b": 0.0})
    with pytest.raises(FileNotFoundError, match="threshold"):
        M.load_bundle(spark, str(tmp_path / "half"))


def test_search_is_seeded_and_within_ranges():
    drawn = search.draw_settings(25, 42)
    assert drawn == search.draw_settings(25, 42) and drawn != search.draw_settings(25, 43)
    for settings in drawn:
        for name, (low, high, scale) in search.SEARCH_RANGES.items():
            assert low <= settings[name] <= high and (scale != "integer" or isinstance(settings[name], int))


def test_random_search(data):
    train, validation, _ = data
    schema = M.feature_schema(train, ["n", "m"], "readmit_30")
    ranges = {"max_depth": (1, 2, "integer"), "num_round": (1, 3, "integer"), "eta": (0.1, 0.3, "log")}
    trials, best = search.random_search(train, validation, schema, "readmit_30", 2, 2, ranges=ranges)
    rows = trials.orderBy(F.col("pr_auc").desc(), "trial").collect()
    assert len(rows) == 2 and best == {k: rows[0][k] for k in ranges}


def test_attribution_finds_the_signal(data):
    train, _, test = data
    schema = M.feature_schema(train, FEATURES, "readmit_30")
    linear = M.fit_logistic(train, schema, "readmit_30")
    first = attribution.linear_attribution(linear, schema, test, "encounter_id", n=100)
    assert [r["feature"] for r in first.collect()][0] == "n" and first.count() == 3
    permuted = attribution.permutation_importance(linear, schema, test, "readmit_30", "encounter_id", n=200)
    rows = permuted.collect()
    assert rows[0]["feature"] == "n" and rows[0]["pr_auc_drop"] > 0.05 and len(rows) == 3


def test_ablation(data):
    train, _, test = data
    rows = attribution.ablate(train, test, FEATURES, "race", "readmit_30", params={"max_depth": 2, "num_round": 2}).collect()
    assert {r["variant"] for r in rows} == {"with", "without"} and {r["value"] for r in rows} == {"a", "b", "Missing"}
    assert len({r["test_pr_auc"] for r in rows}) <= 2


def test_evaluation_job(data):
    train, validation, test = data
    schema = M.feature_schema(train, FEATURES, "readmit_30")
    models = jobs.fit_models(train, validation, schema, "readmit_30", {"max_depth": 2, "num_round": 3})
    scored = [jobs.score_all(df, models, "readmit_30", "encounter_id", ("race", "gender")).cache() for df in (validation, test)]
    report = jobs.evaluation_report(*scored, "readmit_30", "encounter_id", subgroup_columns=("race", "gender"))
    rows = {r["model"]: r for r in report["comparison"].collect()}
    assert set(rows) == set(jobs.MODEL_NAMES)
    base = test.agg(F.avg("readmit_30")).first()[0]
    assert rows["Majority class"]["pr_auc"] == pytest.approx(base, abs=1e-4) and rows["Majority class"]["roc_auc"] == 0.5
    assert rows["Majority class"]["recall_at_thr"] == 1.0
    assert rows["Boosted (calibrated)"]["roc_auc"] == rows["Boosted (uncalibrated)"]["roc_auc"]
    assert rows["Logistic regression"]["roc_auc"] > 0.7
    assert report["calibration"].agg(F.sum("n")).first()[0] == test.count()
    benchmark = jobs.benchmark_report(train, validation, "readmit_30")
    assert {r["model"] for r in benchmark.collect()} == {"majority_class", "heuristic", "logistic"}
