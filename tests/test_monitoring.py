from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskmart.operators import features, monitoring as M
from riskmart.operators.profiling import constant_columns, missing_share, repeated_entity_share, value_counts


@pytest.fixture(scope="module")
def halves(spark):
    base = [("250.83", "x", "1")] * 60 + [("V27", "y", "2")] * 40
    now = [("250.83", "x", "1")] * 50 + [("V27", "z", "2")] * 49 + [("V27", None, "2")]
    schema = "code string, cat string, n string"
    return spark.createDataFrame(base, schema), spark.createDataFrame(now, schema)


def test_violations(halves):
    found = {(r["feature"], r["constraint_check_type"]) for r in M.data_quality_violations(*halves, ["code", "cat", "n"], ["cat", "n"]).collect()}
    assert found == {("cat", "completeness_check"), ("code", "data_type_check"), ("cat", "categorical_values_check")}


def test_no_violations_against_itself(halves):
    assert M.data_quality_violations(halves[0], halves[0], ["code", "cat", "n"], ["cat", "n"]).count() == 0


def test_missing_column_values_are_a_violation(halves):
    empty = halves[1].withColumn("cat", F.lit(None).cast("string"))
    found = M.data_quality_violations(halves[0], empty, ["cat"], ["cat"]).collect()
    assert [r["constraint_check_type"] for r in found] == ["completeness_check"]


def test_profile(halves):
    rows = {r["column"]: r for r in M.column_profile(value_counts(halves[1], ["code", "cat", "n"])).collect()}
    assert (rows["cat"]["n_null"], rows["cat"]["n_distinct"], rows["cat"]["completeness"]) == (1, 2, 0.99)
    assert rows["code"]["share_fractional"] == 0.5 and rows["n"]["share_integral"] == 1.0


def test_unseen_values(halves):
    base, now = (value_counts(h, ["cat"]) for h in halves)
    assert [(r["value"], r["n"]) for r in M.unseen_categories(base, now, ["cat"]).collect()] == [("z", 49)]
    assert M.category_matches(base, now, ["cat"]).first()["match_share"] == pytest.approx(50 / 99)


def test_model_quality_directions(spark):
    metric = lambda **v: spark.createDataFrame(list(v.items()), "metric string, value double")
    base = metric(auc=0.65, accuracy=0.84, false_positive_rate=0.085, true_negative_rate=0.915, recall=0.2)
    now = metric(auc=0.67, accuracy=0.836, false_positive_rate=0.087, true_negative_rate=0.913, recall=0.2)
    assert {r["metric"] for r in M.model_quality_violations(base, now).collect()} == {"accuracy", "false_positive_rate", "true_negative_rate"}
    gone = now.where("metric <> 'recall'")
    assert "recall" in {r["metric"] for r in M.model_quality_violations(base, gone).collect()}


def test_metric_points(spark, halves):
    violations = M.data_quality_violations(*halves, ["code", "cat"], ["cat"])
    points = {(r["name"], r["dimension"]): r["value"] for r in M.metric_rows(violations).collect()}
    assert points[("DataQualityViolationCount", None)] == 3.0
    assert points[("DataQualityViolationCount", "data_type_check")] == 1.0


def test_exploratory_aggregates(spark):
    df = spark.createDataFrame([("a", None, "k", 1), ("a", "v", "k", 0), ("b", None, "k", 1), (None, "w", None, 1)], "e string, x string, c string, y int")
    assert [(r["column"], r["pct_null"]) for r in missing_share(df).collect()] == [("x", 50.0), ("c", 25.0), ("e", 25.0)]
    assert {r["column"]: r["is_constant"] for r in constant_columns(df, ["e", "c"]).collect()} == {"e": 0, "c": 1}
    row = repeated_entity_share(df, "e", "y").first()
    assert (row["n_entities"], row["n_repeated"], row["positives"], row["positives_of_repeated"]) == (2, 1, 2, 1)


def test_feature_coercion(spark):
    df = spark.createDataFrame([(True, None, 1, 1.5, None)], "b boolean, s string, i int, d double, missing double")
    out = features.coerce_for_feature_table(df, 12.5)
    assert dict(out.dtypes) == {"b": "bigint", "s": "string", "i": "bigint", "d": "double", "missing": "double", "event_time": "double"}
    assert tuple(out.first()) == (1, "Missing", 1, 1.5, None, 12.5)
    kinds = {r["feature_name"]: r["feature_type"] for r in features.feature_definitions(out).collect()}
    assert kinds == {"b": "Integral", "s": "String", "i": "Integral", "d": "Fractional", "missing": "Fractional", "event_time": "Fractional"}
    for bad in ("1x", "_x", "a.b"):
        with pytest.raises(ValueError, match="not valid"):
            features.check_feature_names([bad])
