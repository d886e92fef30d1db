from __future__ import annotations

import pytest
from conftest import encounter
from pyspark.sql import functions as F

from riskmart import schema as S
from riskmart.operators import cleaning, decoding


def test_filter_keeps_null_and_matches_decimals(spark):
    df = spark.createDataFrame([("11",), ("11.0",), (" 13 ",), (None,), ("?",), ("1",)], "d string")
    assert [r[0] for r in cleaning.exclude_ids(df, "d", S.EXCLUDED_DISPOSITIONS).collect()] == [None, "?", "1"]


def test_target_has_no_null(spark):
    df = spark.createDataFrame([("<30",), (">30",), (None,)], "readmitted string")
    found = cleaning.binary_target(df, "readmitted", "<30", "y")
    assert found.columns == ["y"] and [r[0] for r in found.collect()] == [1, 0, 0]


def test_clean_and_transform(raw, dimensions):
    clean = cleaning.clean_and_transform(raw, dimensions)
    assert len(clean.columns) == 44
    assert not set(S.LOW_VALUE_COLUMNS) & set(clean.columns)
    assert [d for d in S.DRUG_COLUMNS if d in clean.columns] == ["metformin", "insulin"]
    rows = {r["encounter_id"]: r for r in clean.collect()}
    assert set(rows) == {"e1", "e2", "e3"}
    one, two, three = (rows[f"e{i}"] for i in (1, 2, 3))
    assert (one["diag_1_group"], one["diag_2_group"], one["diag_3_group"]) == ("Diabetes", "Circulatory", "Missing")
    assert [r["readmit_30"] for r in (one, two, three)] == [1, 0, 0]
    assert [(r["n_med_changes"], r["n_diabetes_meds"]) for r in (one, two, three)] == [(0, 1), (0, 1), (2, 3)]
    assert (one["admission_type"], two["admission_type"]) == ("late admission_type 3", "late admission_type 4")
    assert (one["discharge_disposition"], three["discharge_disposition"]) == ("late discharge_disposition 25", None)
    assert three["discharge_disposition_id"] == 3 and three["prior_visits_total"] == 5
    assert [(r["a1c_tested"], r["a1c_level"], r["glu_level"]) for r in (one, two)] == [(1, ">7", "Norm"), (0, "NotTested", "NotTested")]
    assert (one["payer_code"], one["payer_missing"], one["specialty_missing"]) == ("Unknown", 1, 0)
    assert (two["medical_specialty"], two["specialty_missing"], two["payer_missing"]) == ("Unknown", 1, 0)
    assert {r["age_ordinal"] for r in rows.values()} == {8}
    types = dict(clean.dtypes)
    assert {types[c] for c in S.COUNTER_COLUMNS} == {"bigint"} and types["encounter_id"] == "string"
    assert len(cleaning.feature_names(clean.columns)) == 41


def test_missing_counter_fails_the_job(spark, dimensions):
    bad = spark.createDataFrame([encounter(1, time_in_hospital="?")], S.ENCOUNTERS)
    with pytest.raises(Exception, match="time_in_hospital: not a number"):
        cleaning.clean_and_transform(bad, dimensions).collect()


def test_feature_checks(raw):
    with pytest.raises(ValueError, match="patient_nbr"):
        cleaning.check_features(["race", "patient_nbr"])
    with pytest.raises(ValueError):
        cleaning.check_features(["race", S.TARGET])
    with pytest.raises(Exception):
        cleaning.select_features(raw, ["race", "no_such_column"]).collect()
    with pytest.raises(ValueError, match="collide"):
        cleaning.normalise_names(raw.select(F.col("race").alias("a-b"), F.col("gender").alias("A_B")))


def test_decode_keeps_row_count_and_last_duplicate(spark):
    df = spark.createDataFrame([("1",), ("2",), ("9",), (None,)], "k string")
    dim = spark.createDataFrame([("1", "a", 0), ("1", "b", 2), ("1", "c", 1), ("2", None, 5), ("2", "x", 4)], "id string, d string, n int")
    found = {r["k"]: r["out"] for r in decoding.decode(df, "k", dim, "id", "d", "out", "n").collect()}
    assert found == {"1": "b", "2": None, "9": None, None: None}
    assert decoding.decode_all_matches(df.withColumnRenamed("k", "id"), dim, "id").count() == 7


def test_score_skew_counts_both_sides(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.1), (3, None)], "id int, s double")
    b = spark.createDataFrame([(1, 0.50005), (3, 0.2), (4, 0.3)], "id int, s double")
    row = decoding.score_skew(a, b, "id", "s").first()
    assert (row["n_matched"], row["n_only_left"], row["n_only_right"], row["no_skew"]) == (2, 1, 1, False)
    assert decoding.score_skew(a.where("id = 1"), b.where("id = 1"), "id", "s").first()["no_skew"] is True


def test_duplicates_without_an_order_fail(spark):
    dim = spark.createDataFrame([("1", "a"), ("1", "b")], "id string, d string")
    with pytest.raises(Exception, match="several values"):
        decoding.last_per_key(dim, "id", "d").collect()
    same = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", None), (None, "x")], "id string, d string")
    assert {tuple(r) for r in decoding.last_per_key(same, "id", "d").collect()} == {("1", "a"), ("2", None)}
