"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from riskmart import schema as S
from riskmart.config import DEFAULT_SPLITS
from riskmart.operators import cleaning, ranking, splitting
from riskmart.operators.profiling import missing_share, rate_by_groups
from riskmart.sources import stacked

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{FOLDER}/orders.parquet")


def test_hash_split_needs_no_shuffle(orders):
    assert "Exchange" not in plan(splitting.assign_hash_split(orders, "o_custkey", 42, DEFAULT_SPLITS))


def test_exact_split_never_shuffles_rows(orders):
    labelled = splitting.assign_exact_split(orders, "o_custkey", 42, DEFAULT_SPLITS)
    top = plan(labelled).split("Subquery subquery")[0]
    assert "Exchange" not in top and "Join" not in top


def test_filters_and_columns_reach_the_scan(orders):
    text = plan(orders.where("o_orderstatus <> 'P'").select("o_custkey"))
    assert "Not(EqualTo(o_orderstatus,P))" in text and "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in text
    assert plan(missing_share(orders, ["o_orderpriority"])).count("FileScan") == 1


def test_all_subgroup_columns_share_one_scan(orders):
    df = orders.withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))
    assert plan(rate_by_groups(df, "y", ["o_orderpriority", "o_orderstatus", "o_custkey"])).count("FileScan") == 1


def test_cleaning_has_no_python(raw, dimensions):
    text = plan(cleaning.clean_and_transform(raw, dimensions))
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_dictionaries_from_a_file_are_broadcast(spark, raw, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text("\n,\n".join(f"{key},description\n3,three\n4,four\n" for key in S.DIMENSIONS.values()))
    dims = stacked.read_stacked(spark, str(path), {n: [k, "description"] for n, k in S.DIMENSIONS.items()})
    clean = cleaning.clean_and_transform(raw, dims)
    assert clean.count() == 3
    clean.collect()
    final = clean._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in final


@pytest.mark.parametrize("name", ["w2_precision_at_k", "e6_full_metrics", "e10_model_comparison", "f2_posttraining_bias", "q12_monitoring_run",
                                  "a12_clipped_histogram", "j4_entity_split_assignment", "w8_seeded_sample", "q5_all_gates"])
def test_no_nested_loops(spark, name):
    text = plan(entry_points.queries()[name](spark, FOLDER))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_cut_level_is_broadcast_to_the_scored_rows(spark, orders):
    df = orders.select(F.col("o_orderkey").alias("id"), F.lit(0.5).alias("s"), F.lit(1).alias("y"))
    assert "BroadcastHashJoin" in plan(ranking.precision_at(df, "s", "y", "id", [0.1]))


def test_quality_job_scores_each_row_once(spark):
    from riskmart.operators.modeling import Bundle
    from riskmart.plans.monitoring import model_quality_job

    scored = spark.sparkContext.accumulator(0)

    class Model:
        def add_score(self, df, output):
            def count(batches):
                for batch in batches:
                    scored.add(batch.num_rows)
                    yield batch

            df = df.withColumn(output, F.col("x"))
            return df.mapInArrow(count, df.schema)

    rows = [(i, i / 40, int(i % 3 == 0)) for i in range(40)]
    base, now = (spark.createDataFrame(part, "id int, x double, y int") for part in (rows[:25], rows[25:]))
    bundle = Bundle(Model(), {"a": 1.0, "b": 0.0}, {"threshold": 0.6}, {"feature_order": ["x"]})
    report = model_quality_job(bundle, base, now, "id", "y")
    found = {name: {r.metric: r[-1] for r in report[name].collect()} for name in ("baseline", "current")}
    assert set(report["violations"].select("metric").toPandas()["metric"]) <= set(found["current"])
    assert scored.value == 40 and 0 < found["baseline"]["auc"] < 1
