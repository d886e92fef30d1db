from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskmart.config import DEFAULT_SPLITS, Settings, load_settings
from riskmart.operators import gates
from riskmart.operators.splitting import assign_exact_split


@pytest.fixture(scope="module")
def frame(spark):
    """6,000 entities with one to three rows and an 11 % label, all from hashes."""
    entities = spark.range(6000).withColumn("n", F.element_at(F.array(*[F.lit(i) for i in (1, 1, 1, 2, 2, 3)]), (F.abs(F.xxhash64("id")) % 6 + 1).cast("int")))
    rows = entities.select(F.col("id").alias("entity"), F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    rows = rows.withColumn("id", F.col("entity") * 10 + F.col("i"))
    rows = rows.withColumn("y", (F.abs(F.xxhash64(F.lit(7), "id")) % 100 < 11).cast("int"))
    return assign_exact_split(rows, "entity", 42, DEFAULT_SPLITS).cache()


def test_gates_pass(frame):
    rows = gates.enforce(gates.split_gates(frame, "entity", "y", DEFAULT_SPLITS, floor=500)).collect()
    assert len(rows) == 8 and all(r["passed"] for r in rows)


def test_leak_fires(frame):
    leaked = frame.withColumn("split", F.when((F.col("entity") == 5) & (F.col("i") == 1), "train").when(F.col("entity") == 5, "production").otherwise(F.col("split")))
    extra = frame.where("entity = 5").withColumn("split", F.lit("test")).unionByName(leaked)
    with pytest.raises(gates.GateFailure, match="no_entity_leakage"):
        gates.enforce(gates.leakage_gate(extra, "entity"))
    assert gates.leaking_entities(extra, "entity").count() == 1


def test_entity_without_split_is_a_leak(spark):
    df = spark.createDataFrame([("a", None), ("b", "train")], "entity string, split string")
    assert [r["entity"] for r in gates.leaking_entities(df, "entity").collect()] == ["a"]


def test_drift_fires(frame):
    drifted = frame.withColumn("y", F.when(F.col("split") == "train", 1).otherwise(F.col("y")))
    with pytest.raises(gates.GateFailure, match="prevalence_spread"):
        gates.enforce(gates.prevalence_gate(drifted, "y", DEFAULT_SPLITS))


def test_empty_split_has_zero_rows(frame):
    counts = {r["split"]: r for r in gates.split_counts(frame.where("split <> 'test'"), "y", DEFAULT_SPLITS).collect()}
    assert counts["test"]["n"] == 0 and counts["test"]["share"] == 0.0
    with pytest.raises(gates.GateFailure, match=r"split_proportion\[test\]"):
        gates.enforce(gates.proportion_gate(frame.where("split <> 'test'"), "y", DEFAULT_SPLITS))


def test_class_floor(frame):
    with pytest.raises(gates.GateFailure, match=r"class_floor\[positive\]"):
        gates.enforce(gates.class_floor_gate(frame, "y", 10_000))
    row = gates.modelling_statistics(frame, "y").first()
    assert row["below_floor"] == 1 and row["n"] == row["positives"] + row["negatives"]


def test_expected_counts_and_shares(spark):
    observed = spark.createDataFrame([("rows", 5), ("people", 4)], "subject string, observed bigint")
    assert gates.count_gate(observed, {"rows": 5}).first()["passed"] is True
    with pytest.raises(gates.GateFailure, match="absent"):
        gates.enforce(gates.count_gate(observed, {"absent": 0}))
    shares = spark.createDataFrame([("a", 60.0), ("b", 40.0)], "value string, pct double")
    passed = {r["subject"]: r["passed"] for r in gates.distribution_gate(shares, {"a": 60.9, "b": 42.0, "c": 0.4}).collect()}
    assert passed == {"a": True, "b": False, "c": True}


def test_metric_gate_fails_on_missing_metric(spark):
    df = spark.createDataFrame([(None,)], "auc double")
    assert gates.metric_gate(df, "auc", 0.6).first()["passed"] is False


def test_smoke_test(spark):
    rows = spark.createDataFrame([("a", 0.2), ("b", 0.7)], "id string, s double")
    assert gates.scoring_smoke_test(rows, rows, rows, "id", "s").first()["passed"] is True
    for broken in (rows.where("id = 'a'"), rows.withColumn("s", F.col("s") + 1), rows.withColumn("s", F.lit(None).cast("double")),
                   rows.withColumn("s", F.lit(float("nan")))):
        assert gates.scoring_smoke_test(rows, broken, rows, "id", "s").first()["passed"] is False


def test_settings(tmp_path):
    path = tmp_path / "settings.yaml"
    path.write_text("project: trial\nseed: 7\nroot: /data/\nunknown: 1\n")
    settings = load_settings(str(path))
    assert settings.seed == 7 and settings.path("features", "split=train/") == "/data/features/split=train"
    assert Settings().splits == DEFAULT_SPLITS
