"""Projections, predicates, scalar functions and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..config import DEFAULT_SEED, DEFAULT_SPLITS
from ..functions import (
    absence_flag, age_ordinal, alert_count, clip_upper, count_in, count_not_equal, fixed_decimals,
    flag_at, lenient_double, null_markers, null_safe_sum, null_tokens, or_else, platt, presence_flag, recode,
    strict_bigint, with_diagnosis_groups,
)
from ..functions.nulls import name
from ..operators import cleaning, decoding, features, gates
from ..operators.profiling import exact_quantiles
from ..operators.splitting import assign_exact_split, modelling_rows
from ..plans.evaluation import heuristic
from .registry import query
from .sql import LOOKUP, NUMBER, age_case, check, group_case, split_case
from .tables import clean, dimension, encounters, records, split_records, table

ROUND = 6


# --- projections and predicates -----------------------------------------------------------------------------------

@query("p1_missing_markers", check("""
SELECT encounter_id, nullif(race, '?') AS race, nullif(weight, '?') AS weight, nullif(payer_code, '?') AS payer_code,
       nullif(medical_specialty, '?') AS medical_specialty, nullif(diag_1, '?') AS diag_1 FROM encounters"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return null_markers(encounters(spark, folder)).select(
        "encounter_id", "race", "weight", "payer_code", "medical_specialty", "diag_1")


@query("p2_exclude_ids", check("""
SELECT encounter_id, discharge_disposition_id FROM encounters
WHERE NOT coalesce(try_cast(discharge_disposition_id AS DOUBLE) IN (11, 13, 14, 19, 20, 21), false)"""))
def _(spark, folder):
    kept = cleaning.exclude_ids(encounters(spark, folder), "discharge_disposition_id", S.EXCLUDED_DISPOSITIONS)
    return kept.select("encounter_id", "discharge_disposition_id")


@query("p2_exclude_ids_keeps_unparseable", check("""
SELECT encounter_id, diag_1 FROM encounters
WHERE diag_1 = '?' OR NOT regexp_matches(trim(diag_1), """ + NUMBER + """)
   OR CAST(CASE WHEN regexp_matches(trim(diag_1), """ + NUMBER + """) THEN trim(diag_1) END AS DOUBLE) NOT IN (428, 250.83)"""))
def _(spark, folder):
    return cleaning.exclude_ids(null_markers(encounters(spark, folder)), "diag_1", [428, 250.83]).select(
        "encounter_id", F.coalesce("diag_1", F.lit("?")).alias("diag_1"))


@query("p3_binary_target", check("""
SELECT id, CAST(CASE WHEN priority = '1-URGENT' THEN 1 ELSE 0 END AS INT) AS target FROM records"""))
def _(spark, folder):
    df = records(spark, folder).select("id", "priority")
    return cleaning.binary_target(df, "priority", "1-URGENT", "target")


@query("p4_drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, folder):
    return cleaning.drop_columns(table(spark, folder, "orders"),
                                 ["o_orderstatus", "o_orderdate", "o_orderpriority", "no_such_column"])


@query("p5_feature_order", "SELECT c_mktsegment, c_nationkey, c_acctbal FROM customer")
def _(spark, folder):
    return cleaning.select_features(table(spark, folder, "customer"), ["c_mktsegment", "c_nationkey", "c_acctbal"])


@query("p6_features_and_target", check("""
SELECT status, priority, price, score, coarse_score, counter, label FROM split_records"""))
def _(spark, folder):
    return cleaning.features_and_target(split_records(spark, folder), "label", ["id", "entity", "split"])


@query("p7_modelling_rows", check("SELECT id, split FROM split_records WHERE split <> 'production'"))
def _(spark, folder):
    return modelling_rows(split_records(spark, folder)).select("id", "split")


@query("p8_flag_at_threshold", check("""
SELECT id, coarse_score, CAST(coarse_score >= CAST(0.6 AS DOUBLE) AS INT) AS flag FROM records"""))
def _(spark, folder):
    return records(spark, folder).select("id", "coarse_score", flag_at(F.col("coarse_score"), 0.6).alias("flag"))


@query("p9_heuristic_rule", check("SELECT id, CAST(counter >= 1 AS INT) AS heuristic FROM records"))
def _(spark, folder):
    return heuristic(records(spark, folder), "counter", 1).select("id", "heuristic")


@query("p10_normalise_names", check("""
SELECT encounter_id, "A1Cresult" AS a1cresult, "glyburide-metformin" AS glyburide_metformin,
       "diabetesMed" AS diabetesmed FROM encounters"""))
def _(spark, folder):
    return cleaning.normalise_names(encounters(spark, folder)).select(
        "encounter_id", "a1cresult", "glyburide_metformin", "diabetesmed")


@query("p11_facet_predicate", check("""
SELECT id, CAST(coalesce(priority = '2-HIGH', false) AS INT) AS in_facet,
       CAST(NOT coalesce(priority = '2-HIGH', false) AS INT) AS in_complement FROM records"""))
def _(spark, folder):
    facet = F.col("priority").eqNullSafe(F.lit("2-HIGH"))
    return records(spark, folder).select("id", facet.cast("int").alias("in_facet"), (~facet).cast("int").alias("in_complement"))


@query("p12_scores_in_range", check("""
SELECT label, CAST(bool_and(coalesce(score BETWEEN 0 AND 1, false)) AS INT) AS in_range,
       CAST(bool_and(coalesce(CASE WHEN priority IS NOT NULL THEN score END BETWEEN 0 AND 1, false)) AS INT) AS in_range_with_nulls
FROM records GROUP BY label"""))
def _(spark, folder):
    df = records(spark, folder).withColumn("holed", F.when(F.col("priority").isNotNull(), F.col("score")))
    return df.groupBy("label").agg(gates.scores_in_range(df, "score").cast("int").alias("in_range"),
                                   gates.scores_in_range(df, "holed").cast("int").alias("in_range_with_nulls"))


@query("p13_rows_of_repeated_entities", check("""
SELECT count(*) AS n, CAST(sum(label) AS BIGINT) AS positives FROM records
WHERE entity IN (SELECT entity FROM records GROUP BY entity HAVING count(*) > 9)"""))
def _(spark, folder):
    df = records(spark, folder)
    keys = df.groupBy("entity").count().where("count > 9").select("entity")
    return df.join(keys, "entity", "left_semi").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"))


# --- scalar functions ---------------------------------------------------------------------------------------------

@query("c1_diagnosis_group", check(f"""
SELECT encounter_id, {group_case("nullif(diag_1, '?')")} AS diag_1_group, {group_case("nullif(diag_2, '?')")} AS diag_2_group,
       {group_case("nullif(diag_3, '?')")} AS diag_3_group FROM encounters"""))
def _(spark, folder):
    coded = with_diagnosis_groups(null_markers(encounters(spark, folder)), S.DIAGNOSIS_COLUMNS)
    return coded.select("encounter_id", *[f"{c}_group" for c in S.DIAGNOSIS_COLUMNS])


@query("c2_age_ordinal", check(f"""
SELECT encounter_id, {age_case("CASE WHEN gender = 'Unknown/Invalid' THEN 'unknown' ELSE age END")} AS age_ordinal FROM encounters"""))
def _(spark, folder):
    odd = "CASE WHEN gender = 'Unknown/Invalid' THEN 'unknown' ELSE age END"
    return encounters(spark, folder).select("encounter_id", age_ordinal(f"({odd})").alias("age_ordinal"))


_DRUG_TEXT = [f'"{d}"' for d in S.DRUG_COLUMNS]


@query("c3_count_in_set", check(f"""
SELECT encounter_id, CAST({' + '.join(f"CASE WHEN {d} IN ('Up', 'Down') THEN 1 ELSE 0 END" for d in _DRUG_TEXT)} AS INT) AS n_changes
FROM encounters"""))
def _(spark, folder):
    return null_markers(encounters(spark, folder)).select(
        "encounter_id", count_in([name(d) for d in S.DRUG_COLUMNS], ["Up", "Down"]).alias("n_changes"))


@query("c4_count_not_equal", check(f"""
SELECT encounter_id, CAST({' + '.join(f"CASE WHEN {d} = 'No' THEN 0 ELSE 1 END" for d in _DRUG_TEXT)} AS INT) AS n_meds
FROM encounters"""))
def _(spark, folder):
    return null_markers(encounters(spark, folder)).select(
        "encounter_id", count_not_equal([name(d) for d in S.DRUG_COLUMNS], "No").alias("n_meds"))


@query("c5_presence_flags", check("""
SELECT encounter_id, CAST("A1Cresult" <> '?' AS INT) AS a1c_tested, CAST(max_glu_serum <> '?' AS INT) AS glu_tested,
       CAST(medical_specialty = '?' AS INT) AS specialty_missing, CAST(payer_code = '?' AS INT) AS payer_missing FROM encounters"""))
def _(spark, folder):
    return null_markers(encounters(spark, folder)).select(
        "encounter_id", presence_flag("A1Cresult").alias("a1c_tested"),
        presence_flag("max_glu_serum").alias("glu_tested"),
        absence_flag("medical_specialty").alias("specialty_missing"),
        absence_flag("payer_code").alias("payer_missing"))


@query("c6_sentinel_fill", check("SELECT id, coalesce(priority, 'Unknown') AS priority FROM records"))
def _(spark, folder):
    return records(spark, folder).select("id", or_else("priority", "Unknown").alias("priority"))


@query("c7_multi_value_recode", check("""
SELECT encounter_id, CASE WHEN "A1Cresult" IN ('?', 'None') THEN 'NotTested' ELSE "A1Cresult" END AS a1c_level FROM encounters"""))
def _(spark, folder):
    return encounters(spark, folder).select(
        "encounter_id", recode("A1Cresult", ["?", "None"], "NotTested").alias("a1c_level"))


@query("c8_lenient_number", check(f"""
SELECT encounter_id, CAST(CASE WHEN regexp_matches(trim(diag_1), {NUMBER}) THEN trim(diag_1) END AS DOUBLE) AS number FROM encounters"""))
def _(spark, folder):
    return encounters(spark, folder).select("encounter_id", lenient_double("diag_1").alias("number"))


@query("c9_strict_integers", check(f"""
SELECT encounter_id, {', '.join(f'CAST(CAST({c} AS DOUBLE) AS BIGINT) AS {c}' for c in S.COUNTER_COLUMNS)} FROM encounters"""))
def _(spark, folder):
    return encounters(spark, folder).select(
        "encounter_id", *[strict_bigint(f"({c} || '.0')", c).alias(c) for c in S.COUNTER_COLUMNS])


@query("c10_null_safe_sum", check(f"""
SELECT encounter_id, CAST(coalesce(CAST(CASE WHEN regexp_matches(trim(diag_1), {NUMBER}) THEN trim(diag_1) END AS DOUBLE), 0) AS DOUBLE)
       + CAST(number_inpatient AS DOUBLE) + CAST(number_emergency AS DOUBLE) AS total FROM encounters"""))
def _(spark, folder):
    return encounters(spark, folder).select(
        "encounter_id", null_safe_sum(["diag_1", "number_inpatient", "number_emergency"]).alias("total"))


@query("c11_feature_table_coercion", check("""
SELECT id, entity, status, CAST(label AS BIGINT) AS label, coalesce(priority, 'Missing') AS priority, price,
       CASE WHEN priority IS NOT NULL THEN CAST(counter AS BIGINT) END AS counter,
       CAST(label = 1 AS BIGINT) AS is_positive, CAST(1700000000.5 AS DOUBLE) AS event_time FROM records"""))
def _(spark, folder):
    df = records(spark, folder).select(
        "id", "entity", "status", "label", "priority", "price",
        F.when(F.col("priority").isNotNull(), F.col("counter")).alias("counter"), (F.col("label") == 1).alias("is_positive"))
    return features.coerce_for_feature_table(df, 1700000000.5)


@query("c12_feature_names", check("SELECT id AS encounter_id, score AS \"risk-score_1\" FROM records"))
def _(spark, folder):
    df = records(spark, folder).select(F.col("id").alias("encounter_id"), F.col("score").alias("risk-score_1"))
    features.check_feature_names(df.columns)
    return df


@query("c13_feature_types", check("""
SELECT 'Integral' AS feature_type, 'counter' AS feature_name, count(counter) AS n FROM records
UNION ALL SELECT 'Integral', 'entity', count(entity) FROM records UNION ALL SELECT 'Fractional', 'price', count(price) FROM records
UNION ALL SELECT 'String', 'priority', count(priority) FROM records"""))
def _(spark, folder):
    df = records(spark, folder).select("entity", "price", "priority", "counter")
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "feature_name", "n")
    return features.feature_definitions(df).join(counted, "feature_name")


@query("c14_constant_event_time", check("""
SELECT count(DISTINCT 1700000000.25) AS n_times, CAST(1700000000.25 AS DOUBLE) AS event_time, count(*) AS n FROM records"""))
def _(spark, folder):
    stamped = features.coerce_for_feature_table(records(spark, folder).select("id"), 1700000000.25)
    return stamped.agg(F.countDistinct("event_time").alias("n_times"), F.max("event_time").alias("event_time"),
                       F.count(F.lit(1)).alias("n"))


@query("c15_platt_sigmoid", check("""
SELECT id, round(1 / (1 + exp(-(CAST(2.5 AS DOUBLE) * score - CAST(1.25 AS DOUBLE)))), 6) AS calibrated FROM records"""))
def _(spark, folder):
    return records(spark, folder).select("id", F.round(platt(F.col("score"), 2.5, -1.25), ROUND).alias("calibrated"))


@query("c16_upper_clip", check("""
SELECT id, CASE WHEN priority IS NOT NULL THEN least(counter, 5) END AS clipped FROM records"""))
def _(spark, folder):
    holed = "(CASE WHEN priority IS NOT NULL THEN counter END)"
    return records(spark, folder).select("id", clip_upper(holed, 5).alias("clipped"))


@query("c17_rounding", check("SELECT id, round(price / 7, 4) AS rounded, printf('%.6f', price / 8) AS text FROM records"))
def _(spark, folder):
    return records(spark, folder).select(
        "id", F.round(F.col("price") / 7, 4).alias("rounded"), fixed_decimals(F.col("price") / 8).alias("text"))


@query("c18_alert_count", check("""
SELECT entity, greatest(CAST(1 AS BIGINT), CAST(ceil(CAST(count(*) AS DOUBLE) * CAST(0.1 AS DOUBLE)) AS BIGINT)) AS k10,
       greatest(CAST(1 AS BIGINT), CAST(ceil(CAST(count(*) AS DOUBLE) * CAST(0.2 AS DOUBLE)) AS BIGINT)) AS k20
FROM records GROUP BY entity"""))
def _(spark, folder):
    counts = records(spark, folder).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("entity", alert_count(F.col("n"), 0.1).alias("k10"), alert_count(F.col("n"), 0.2).alias("k20"))


@query("c19_trim_and_prefix", check("""
SELECT encounter_id, trim(diag_1) AS code, CAST(substr(trim(diag_1), 1, 1) IN ('V', 'E') AS INT) AS is_lettered FROM encounters"""))
def _(spark, folder):
    from ..functions.numeric import trimmed

    code = trimmed("diag_1")
    return encounters(spark, folder).select(
        "encounter_id", code.alias("code"), (code.startswith("V") | code.startswith("E")).cast("int").alias("is_lettered"))


@query("c20_model_numbers", check("SELECT id, CAST(counter AS DOUBLE) AS counter, CAST(label AS DOUBLE) AS label FROM records"))
def _(spark, folder):
    return records(spark, folder).select("id", F.col("counter").cast("double").alias("counter"), F.col("label").cast("double").alias("label"))


@query("c21_checksum", "SELECT doc_id, sha256(text) AS checksum FROM documents")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("checksum"))


# --- joins --------------------------------------------------------------------------------------------------------

@query("j1_decode_last_wins", check(f"""
SELECT c_custkey, description FROM customer LEFT JOIN ({LOOKUP}) d ON d.dim_id = CAST(c_nationkey + 3 AS VARCHAR)"""))
def _(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", (F.col("c_nationkey") + 3).alias("key"))
    decoded = decoding.decode(df, "key", dimension(spark, folder), "dim_id", "description", "description", "line_no")
    return decoded.drop("key")


@query("j2_decode_all_matches", check("""
SELECT c_custkey, description FROM customer LEFT JOIN dimension d ON d.dim_id = CAST(c_nationkey AS VARCHAR)"""))
def _(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("dim_id"))
    return decoding.decode_all_matches(df, dimension(spark, folder), "dim_id").select("c_custkey", "description")


@query("j3_semi_join_on_aggregate", check("""
SELECT id, entity FROM records WHERE entity IN (SELECT entity FROM records GROUP BY entity HAVING count(*) > 1)"""))
def _(spark, folder):
    return decoding.rows_of_repeated(records(spark, folder), "entity").select("id", "entity")


@query("j4_entity_split_assignment", check("""
WITH ordered AS (SELECT entity, row_number() OVER (ORDER BY md5('42:' || CAST(entity AS VARCHAR)), entity) - 1 AS i,
                        count(*) OVER () AS n FROM (SELECT DISTINCT entity FROM records)),
assigned AS (SELECT entity, CASE WHEN i < floor(CAST(0.4 AS DOUBLE) * n) THEN 'train' WHEN i < floor(CAST(0.5 AS DOUBLE) * n) THEN 'validation'
                        WHEN i < floor(CAST(0.6 AS DOUBLE) * n) THEN 'test' ELSE 'production' END AS split FROM ordered)
SELECT id, records.entity, split FROM records JOIN assigned ON records.entity = assigned.entity"""))
def _(spark, folder):
    return assign_exact_split(records(spark, folder), "entity", DEFAULT_SEED, DEFAULT_SPLITS).select("id", "entity", "split")


@query("j6_aligned_columns", check("""
SELECT id, label, score, CAST(score >= CAST(0.5 AS DOUBLE) AS INT) AS prediction, priority FROM records"""))
def _(spark, folder):
    # Everything stands in one row, so aligning by position is a projection and no join.
    return records(spark, folder).select("id", "label", "score", flag_at(F.col("score"), 0.5).alias("prediction"), "priority")


@query("j7_score_skew", check("""
WITH a AS (SELECT id, coarse_score AS s FROM records WHERE id % 11 <> 0),
b AS (SELECT id, coarse_score + CASE WHEN id % 1000 = 1 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS s FROM records WHERE id % 13 <> 0)
SELECT count(*) FILTER (a.id IS NOT NULL AND b.id IS NOT NULL) AS n_matched, count(*) FILTER (b.id IS NULL) AS n_only_left,
       count(*) FILTER (a.id IS NULL) AS n_only_right, round(max(abs(a.s - b.s)), 6) AS max_difference,
       CAST(bool_and(coalesce(abs(a.s - b.s) < 1e-4, false)) AS INT) AS no_skew FROM a FULL JOIN b ON a.id = b.id"""))
def _(spark, folder):
    df = records(spark, folder).select("id", F.col("coarse_score").alias("s"))
    moved = F.col("s") + F.when(F.col("id") % 1000 == 1, 0.25).otherwise(0.0)
    result = decoding.score_skew(df.where("id % 11 <> 0"), df.where("id % 13 <> 0").withColumn("s", moved), "id", "s")
    return result.withColumn("no_skew", F.col("no_skew").cast("int")).withColumn("max_difference", F.round("max_difference", ROUND))


@query("j8_compare_by_name", check("""
WITH b AS (SELECT status AS metric, avg(price) AS value FROM split_records WHERE split = 'train' GROUP BY 1),
c AS (SELECT status AS metric, avg(price) AS value FROM split_records WHERE split = 'production' AND status <> 'P' GROUP BY 1)
SELECT coalesce(b.metric, c.metric) AS metric, round(b.value, 4) AS baseline, round(c.value, 4) AS current
FROM b FULL JOIN c ON b.metric = c.metric"""))
def _(spark, folder):
    df = split_records(spark, folder)
    means = lambda part: part.groupBy(F.col("status").alias("metric")).agg(F.avg("price").alias("value"))
    both = decoding.compare_profiles(means(df.where("split = 'train'")),
                                     means(df.where("split = 'production' AND status <> 'P'")), ["metric"], "value")
    return both.select("metric", F.round("baseline", 4).alias("baseline"), F.round("current", 4).alias("current"))


@query("j2_star_decode", """
SELECT r_name, n_name, c_mktsegment, count(*) AS n, round(avg(o_totalprice), 2) AS mean_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL""")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_totalprice")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    joined = orders.join(customers, "o_custkey").join(nations, "c_nationkey")
    return joined.groupBy("r_name", "n_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 2).alias("mean_price"))
