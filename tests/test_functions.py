from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskmart import functions as fn
from riskmart.functions.coding import with_diagnosis_groups
from riskmart.functions.numeric import trimmed

GROUPS = [
    ("250.83", "Diabetes"), ("428.0", "Circulatory"), ("V58.49", "Other"), ("E885.9", "Other"), (None, "Missing"),
    ("abc", "Other"), ("459", "Circulatory"), ("459.81", "Other"), ("785.2", "Circulatory"), ("786.5", "Respiratory"),
    ("787.0", "Digestive"), ("788.3", "Genitourinary"), ("251", "Other"), ("999", "Injury"), ("999.1", "Other"),
    ("250d", "Other"), ("inf", "Other"), ("nan", "Other"), ("", "Other"), (" 428 ", "Circulatory"), ("\t428\n", "Circulatory"),
    ("519.8", "Other"), ("579.9", "Other"), ("629.9", "Other"), ("739.5", "Other"), ("239.2", "Other"), ("239", "Neoplasms"),
    ("710", "Musculoskeletal"), ("v58", "Other"), ("250", "Diabetes"), ("4.28e2", "Circulatory"), ("-5", "Other"),
]


def test_diagnosis_groups(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(GROUPS)], "i int, code string")
    found = {r["i"]: (r["code_group"], r["again"]) for r in with_diagnosis_groups(df, ["code"]).withColumn(
        "again", fn.diagnosis_group("code")).collect()}
    for i, (_, expected) in enumerate(GROUPS):
        assert found[i] == (expected, expected), GROUPS[i]


def _values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").orderBy("i").select(column).collect()]


def test_age(spark):
    assert _values(spark, fn.age_ordinal("a"), [("[0-10)",), ("[90-100)",), ("[100-110)",), (None,)], "a string") == [0, 9, None, None]


def test_counts_and_nulls(spark):
    rows = [("Up", "No", None), ("Down", "Up", "Steady"), ("No", "No", "No")]
    assert _values(spark, fn.count_in(["a", "b", "c"], ["Up", "Down"]), rows, "a string, b string, c string") == [1, 2, 0]
    assert _values(spark, fn.count_not_equal(["a", "b", "c"], "No"), rows, "a string, b string, c string") == [2, 3, 0]


def test_null_tokens_are_exact_and_case_sensitive(spark):
    texts = ["NA", "None", "none", "Na", " NA", "?", "", "NULL", "x", None]
    df = spark.createDataFrame([(t, "a-b") for t in texts], "`odd-name` string, other string")
    assert [r[0] for r in fn.null_tokens(df).collect()] == [None, None, "none", "Na", " NA", "?", None, None, "x", None]
    assert [r[0] for r in fn.null_markers(df).collect()][5] is None


def test_lenient_numbers(spark):
    rows = [("12",), (" 3.5 ",), ("1e3",), (".5",), ("250d",), ("inf",), ("1_0",), ("0x10",), ("",), (None,)]
    assert _values(spark, fn.lenient_double("a"), rows, "a string") == [12.0, 3.5, 1000.0, 0.5, None, None, None, None, None, None]


def test_strict_integers(spark):
    rows = [("3",), ("3.0",), (" 7 ",), ("9007199254740993",), ("-2",)]
    assert _values(spark, fn.strict_bigint("a", "a"), rows, "a string") == [3, 3, 7, 9007199254740993, -2]


@pytest.mark.parametrize("bad", ["x", "", None, "inf"])
def test_strict_integers_fail_on_bad_text_and_null(spark, bad):
    with pytest.raises(Exception, match="not a number"):
        _values(spark, fn.strict_bigint("a", "a"), [(bad,)], "a string")


def test_null_safe_arithmetic(spark):
    assert _values(spark, fn.null_safe_sum(["a", "b"]), [("1", None), ("x", "2.5"), (None, None)], "a string, b string") == [1.0, 2.5, 0.0]
    assert _values(spark, fn.clip_upper("a", 5), [(7,), (3,), (None,)], "a int") == [5, 3, None]


def test_recodes(spark):
    rows = [("?",), ("None",), (None,), (">8",)]
    assert _values(spark, fn.recode("a", ["?", "None"], "NotTested"), rows, "a string") == ["NotTested"] * 3 + [">8"]
    assert _values(spark, fn.or_else("a", "Unknown"), rows, "a string") == ["?", "None", "Unknown", ">8"]
    assert _values(spark, fn.presence_flag("a"), rows, "a string") == [1, 1, 0, 1]
    assert _values(spark, trimmed("a"), [("\t x y \n",)], "a string") == ["x y"]


def test_score_expressions(spark):
    rows = [(0.5,), (0.2,)]
    assert _values(spark, fn.flag_at(F.col("a"), 0.5), rows, "a double") == [1, 0]
    assert _values(spark, fn.platt(F.col("a"), 2.0, -1.0), [(0.5,)], "a double") == [0.5]
    assert _values(spark, fn.alert_count(F.col("n"), 0.1), [(0,), (1,), (10,), (11,)], "n bigint") == [1, 1, 1, 2]
    assert _values(spark, fn.fixed_decimals(F.col("a")), [(0.090647284,)], "a double") == ["0.090647"]
    assert _values(spark, fn.nan_to_null(F.col("a")), [(float("nan"),), (1.0,)], "a double") == [None, 1.0]
