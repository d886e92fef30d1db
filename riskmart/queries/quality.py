"""Gates, monitors, event rules and composite jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..config import DEFAULT_SEED, DEFAULT_SPLITS, Settings
from ..functions import flag_at, null_markers
from ..operators import fairness, gates, monitoring as M, ranking
from ..operators.cleaning import binary_target, clean_and_transform
from ..operators.profiling import group_counts, numeric_statistics, value_counts, value_share
from ..operators.splitting import assign_hash_split
from ..plans import features as jobs, monitoring as monitor_jobs
from ..session import materialise, work_path
from ..streaming.alerts import EventRule, job_failure_rules, route_events, threshold_alarms
from .aggregates import _BIAS, rounded
from .registry import query
from .sql import check, split_case
from .storage import _table
from .tables import clean, dimensions, encounters, records, split_records, table

_SPLIT_VALUES = "(VALUES ('train', 0.4), ('validation', 0.1), ('test', 0.1), ('production', 0.4)) t(split, target)"


def _shown(gate_rows: DataFrame) -> DataFrame:
    return rounded(gate_rows.withColumn("passed", F.col("passed").cast("int")))


# --- gates --------------------------------------------------------------------------------------------------------

_Q1 = """SELECT 'no_entity_leakage' AS "check", 'entity' AS subject, CAST(count(*) AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS bound, CAST(count(*) = 0 AS INT) AS passed
FROM (SELECT entity FROM {source} GROUP BY entity HAVING count(DISTINCT split) <> 1)"""
_COUNTS = f"""counts AS (SELECT t.split, CAST(t.target AS DOUBLE) AS target, CAST(count(r.id) AS DOUBLE) / (SELECT count(*) FROM split_records) AS share, avg(r.label) AS prevalence
FROM {_SPLIT_VALUES} LEFT JOIN split_records r ON r.split = t.split GROUP BY t.split, t.target)"""
_Q2 = """SELECT 'split_proportion' AS "check", split AS subject, round(abs(share - target), 6) AS observed, CAST(0.02 AS DOUBLE) AS bound, CAST(abs(share - target) < 0.02 AS INT) AS passed FROM counts"""
_Q3 = """SELECT 'class_floor' AS "check", 'positive' AS subject, CAST(sum(label) AS DOUBLE) AS observed, CAST(6000 AS DOUBLE) AS bound, CAST(sum(label) >= 6000 AS INT) AS passed FROM split_records
UNION ALL SELECT 'class_floor', 'negative', CAST(count(*) - sum(label) AS DOUBLE), CAST(6000 AS DOUBLE), CAST(count(*) - sum(label) >= 6000 AS INT) FROM split_records"""
_Q4 = """SELECT 'prevalence_spread' AS "check", 'label' AS subject, round(max(prevalence) - min(prevalence), 6) AS observed, CAST(0.02 AS DOUBLE) AS bound,
CAST(max(prevalence) - min(prevalence) < 0.02 AS INT) AS passed FROM counts"""


@query("q1_leakage_gate", check("WITH tampered AS (SELECT id, entity, CASE WHEN id % 97 = 0 THEN 'test' ELSE split END AS split FROM split_records) " + _Q1.format(source="tampered")))
def _(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.when(F.col("id") % 97 == 0, "test").otherwise(F.col("split"))
    return _shown(gates.leakage_gate(split_records(spark, folder).withColumn("split", tampered), "entity"))


@query("q2_proportion_gate", check(f"WITH {_COUNTS} {_Q2}"))
def _(spark, folder):
    return _shown(gates.proportion_gate(split_records(spark, folder), "label", DEFAULT_SPLITS))


@query("q3_class_floor_gate", check(_Q3))
def _(spark, folder):
    return _shown(gates.class_floor_gate(split_records(spark, folder), "label", 6000))


@query("q4_prevalence_gate", check(f"WITH {_COUNTS} {_Q4}"))
def _(spark, folder):
    return _shown(gates.prevalence_gate(split_records(spark, folder), "label", DEFAULT_SPLITS))


@query("q5_all_gates", check(f"WITH {_COUNTS} {_Q1.format(source='split_records')} UNION ALL {_Q2} UNION ALL {_Q3} UNION ALL {_Q4}"))
def _(spark, folder):
    return _shown(gates.split_gates(split_records(spark, folder), "entity", "label", DEFAULT_SPLITS, 6000))


@query("q6_expected_counts", """
SELECT 'expected_count' AS "check", s AS subject, CAST(n AS DOUBLE) AS observed, CAST(b AS DOUBLE) AS bound, CAST(n = b AS INT) AS passed FROM (
  SELECT 'F' AS s, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n, 4933 AS b
  UNION ALL SELECT 'O', (SELECT count(*) FROM orders WHERE o_orderstatus = 'O'), 1 UNION ALL SELECT 'X', NULL, 0) t
""".replace("CAST(n = b AS INT)", "CAST(coalesce(n = b, false) AS INT)"))
def _(spark, folder):
    observed = group_counts(table(spark, folder, "orders"), "o_orderstatus").select(
        F.col("o_orderstatus").alias("subject"), F.col("n").alias("observed"))
    return _shown(gates.count_gate(observed, {"F": 4933, "O": 1, "X": 0}))


@query("q7_distribution_acceptance", check("""
WITH shares AS (SELECT diag_1_group AS value, 100.0 * count(*) / sum(count(*)) OVER () AS pct FROM clean GROUP BY 1),
expected AS (SELECT * FROM (VALUES ('Other', 40.0), ('Diabetes', 7.0), ('Circulatory', 25.0), ('Unheard of', 0.5)) v(value, pct))
SELECT 'group_share' AS "check", e.value AS subject, round(abs(coalesce(s.pct, 0) - e.pct), 6) AS observed, CAST(1 AS DOUBLE) AS bound,
  CAST(abs(coalesce(s.pct, 0) - e.pct) <= 1 AS INT) AS passed FROM expected e LEFT JOIN shares s ON s.value = e.value"""))
def _(spark, folder):
    shares = value_share(clean(spark, folder).withColumnRenamed("diag_1_group", "value"), "value")
    return _shown(gates.distribution_gate(shares, {"Other": 40.0, "Diabetes": 7.0, "Circulatory": 25.0, "Unheard of": 0.5}))


_AUC = """levels AS (SELECT score AS s, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS q FROM {source} GROUP BY score),
running AS (SELECT *, coalesce(sum(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM levels),
auc AS (SELECT sum(p * (below + CAST(0.5 AS DOUBLE) * q)) / (sum(p) * sum(q)) AS auc FROM running)"""


@query("q16_metric_gate", check("WITH test AS (SELECT * FROM split_records WHERE split = 'test'), " + _AUC.format(source="test") + """
SELECT 'metric_floor' AS "check", 'roc_auc' AS subject, round(auc, 6) AS observed, CAST(0.75 AS DOUBLE) AS bound, CAST(auc >= 0.75 AS INT) AS passed FROM auc"""))
def _(spark, folder):
    metrics = ranking.ranking_metrics(split_records(spark, folder).where("split = 'test'"), "score", "label")
    return _shown(gates.metric_gate(metrics, "roc_auc", 0.75))


@query("q17_scoring_smoke_test", check("""
SELECT count(*) AS n_in, count(*) AS n_out, 1 AS row_count_matches, CAST(bool_and(score BETWEEN 0 AND 1) AS INT) AS scores_in_range, 1 AS no_skew,
  CAST(bool_and(score BETWEEN 0 AND 1) AS INT) AS passed FROM records"""))
def _(spark, folder):
    inputs = records(spark, folder).select("id", "price")
    logit = lambda price: (F.lit(1.0) / (F.lit(1.0) + F.exp(-(price / F.lit(100000.0) - F.lit(3.0))))).alias("score")
    scored = materialise(inputs.select("id", logit(F.col("price").cast("double"))), "scored")  # as the batch job leaves it
    again = inputs.repartition("id").select("id", logit(F.col("price").cast("double") + F.lit(1e-4)))  # by another path
    result = gates.scoring_smoke_test(inputs, scored, again, "id", "score")
    flags = ["row_count_matches", "scores_in_range", "no_skew", "passed"]
    return result.select("n_in", "n_out", *[F.col(c).cast("int").alias(c) for c in flags])


# --- data-quality monitor -----------------------------------------------------------------------------------------

_DQ = [c for c in S.ENCOUNTER_COLUMNS if c not in ("encounter_id", "patient_nbr", "readmitted")]
_DQ_CATEGORICAL = [c for c in _DQ if c not in S.COUNTER_COLUMNS]
def _dq_sql(rows: str, columns: list[str], categorical: list[str]) -> str:
    """Profiles and checks of ``rows`` (with a split column) as common table expressions."""
    long = " UNION ALL ".join(f"SELECT split, '{c}' AS \"column\", nullif(CAST(\"{c}\" AS VARCHAR), '?') AS value FROM enc" for c in columns)
    return f"""enc AS ({rows}),
long AS ({long}),
typed AS (SELECT *, CASE WHEN regexp_matches(trim(value), '^[+-]?[0-9]+$') THEN 'integral'
  WHEN regexp_matches(trim(value), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN 'fractional' WHEN value IS NOT NULL THEN 'text' END AS t FROM long),
profile AS (SELECT split, "column", count(*) AS n, count(*) - count(value) AS n_null, count(value) / CAST(count(*) AS DOUBLE) AS completeness, count(DISTINCT value) AS n_distinct,
  coalesce(count(*) FILTER (t = 'integral') / CAST(nullif(count(value), 0) AS DOUBLE), 0) AS share_integral,
  coalesce(count(*) FILTER (t = 'fractional') / CAST(nullif(count(value), 0) AS DOUBLE), 0) AS share_fractional,
  coalesce(count(*) FILTER (t = 'text') / CAST(nullif(count(value), 0) AS DOUBLE), 0) AS share_text FROM typed GROUP BY 1, 2),
b AS (SELECT * FROM profile WHERE split = 'train'), c AS (SELECT * FROM profile WHERE split = 'production'),
tops AS (SELECT "column", greatest(share_integral, share_fractional, share_text) AS top, CASE greatest(share_integral, share_fractional, share_text)
  WHEN share_integral THEN 'integral' WHEN share_fractional THEN 'fractional' ELSE 'text' END AS t FROM b WHERE n > n_null),
match AS (SELECT p."column", count(*) AS n, CAST(sum(CASE WHEN k.value IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_known, count(DISTINCT CASE WHEN k.value IS NULL THEN p.value END) AS n_unseen_values
  FROM long p LEFT JOIN (SELECT DISTINCT "column", value FROM long WHERE split = 'train' AND value IS NOT NULL) k ON k."column" = p."column" AND k.value = p.value
  WHERE p.split = 'production' AND p.value IS NOT NULL AND p."column" IN ({', '.join(f"'{x}'" for x in categorical)}) GROUP BY 1),
completeness AS (SELECT c."column" AS feature, 'completeness_check' AS constraint_check_type, printf('completeness %.6f below baseline %.6f', c.completeness, b.completeness) AS description
  FROM b JOIN c USING ("column") WHERE c.completeness < b.completeness),
types AS (SELECT c."column" AS feature, 'data_type_check' AS constraint_check_type, printf('share of %s values %.6f below baseline %.6f', t,
    CASE t WHEN 'integral' THEN c.share_integral WHEN 'fractional' THEN c.share_fractional ELSE c.share_text END, top) AS description
  FROM tops JOIN c USING ("column") WHERE c.n > c.n_null AND CASE t WHEN 'integral' THEN c.share_integral WHEN 'fractional' THEN c.share_fractional ELSE c.share_text END < top),
categories AS (SELECT "column" AS feature, 'categorical_values_check' AS constraint_check_type, printf('%.6f of values match the baseline domain', n_known / CAST(n AS DOUBLE)) AS description
  FROM match WHERE n_known < n)"""


_DQ_SQL = _dq_sql("""SELECT * REPLACE (CASE WHEN CAST(encounter_id AS BIGINT) % 10 = 1 THEN num_procedures || ' times' ELSE num_procedures END AS num_procedures),
  CASE WHEN CAST(encounter_id AS BIGINT) % 2 = 0 THEN 'train' ELSE 'production' END AS split FROM encounters""", _DQ, _DQ_CATEGORICAL)


def _halves(spark, folder):
    """Even ids against odd ones, where a counter has begun to arrive as text."""
    df = null_markers(encounters(spark, folder))
    number = F.col("encounter_id").cast("bigint")
    worded = F.when(number % 10 == 1, F.concat("num_procedures", F.lit(" times"))).otherwise(F.col("num_procedures"))
    df, even = df.withColumn("num_procedures", worded), number % 2 == 0
    return df.where(even), df.where(~even)


@query("q8_baseline_profile", check(f"""WITH {_DQ_SQL} SELECT "column", n, n_null, round(completeness, 6) AS completeness, n_distinct,
  round(share_integral, 6) AS share_integral, round(share_fractional, 6) AS share_fractional, round(share_text, 6) AS share_text FROM b"""))
def _(spark, folder):
    return rounded(M.column_profile(value_counts(_halves(spark, folder)[0], _DQ)))


@query("q8_numeric_statistics", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS n_present, count(*) - count({c}) AS n_null, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std FROM lineitem""" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")))
def _(spark, folder):
    stats = numeric_statistics(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])
    return rounded(stats, 4)


@query("q9_completeness_check", check(f"WITH {_DQ_SQL} SELECT * FROM completeness"))
def _(spark, folder):
    base, now = (M.column_profile(value_counts(half, _DQ)) for half in _halves(spark, folder))
    return M.completeness_check(base, now)


@query("q10_data_type_check", check(f"WITH {_DQ_SQL} SELECT * FROM types"))
def _(spark, folder):
    base, now = (M.column_profile(value_counts(half, _DQ)) for half in _halves(spark, folder))
    return M.data_type_check(base, now)


@query("q11_categorical_values_check", check(f"""WITH {_DQ_SQL} SELECT "column", n, n_known, n_unseen_values, round(n_known / CAST(n AS DOUBLE), 6) AS match_share FROM match"""))
def _(spark, folder):
    base, now = (value_counts(half, _DQ) for half in _halves(spark, folder))
    return rounded(M.category_matches(base, now, _DQ_CATEGORICAL))


@query("q11_unseen_categories", check(f"""WITH {_DQ_SQL} SELECT p."column", p.value, count(*) AS n FROM long p
WHERE p.split = 'production' AND p.value IS NOT NULL AND p."column" IN ({', '.join(f"'{x}'" for x in _DQ_CATEGORICAL)})
  AND NOT EXISTS (SELECT 1 FROM long k WHERE k.split = 'train' AND k."column" = p."column" AND k.value = p.value) GROUP BY 1, 2"""))
def _(spark, folder):
    base, now = (value_counts(half, _DQ) for half in _halves(spark, folder))
    return M.unseen_categories(base, now, _DQ_CATEGORICAL)


_VIOLATIONS = "violations AS (SELECT * FROM completeness UNION ALL SELECT * FROM types UNION ALL SELECT * FROM categories)"


def _violations(spark, folder):
    return M.data_quality_violations(*_halves(spark, folder), _DQ, _DQ_CATEGORICAL)


@query("q12_monitoring_run", check(f"WITH {_DQ_SQL}, {_VIOLATIONS} SELECT * FROM violations"))
def _(spark, folder):
    return _violations(spark, folder)


@query("a19_violation_counts", check(f"WITH {_DQ_SQL}, {_VIOLATIONS} SELECT constraint_check_type AS check_type, count(*) AS n FROM violations GROUP BY ROLLUP (1)"))
def _(spark, folder):
    return M.violation_counts(_violations(spark, folder))


# --- model-quality monitor ----------------------------------------------------------------------------------------

_MQ = """{s}_rows AS (SELECT * FROM split_records WHERE split = '{s}'),
{s}_levels AS (SELECT coarse_score AS s, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS q FROM {s}_rows GROUP BY 1),
{s}_running AS (SELECT *, coalesce(sum(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM {s}_levels),
{s}_cells AS (SELECT CAST(count(*) FILTER (label = 0 AND coarse_score < CAST(0.7 AS DOUBLE)) AS DOUBLE) AS tn, CAST(count(*) FILTER (label = 0 AND coarse_score >= CAST(0.7 AS DOUBLE)) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (label = 1 AND coarse_score < CAST(0.7 AS DOUBLE)) AS DOUBLE) AS fn, CAST(count(*) FILTER (label = 1 AND coarse_score >= CAST(0.7 AS DOUBLE)) AS DOUBLE) AS tp FROM {s}_rows),
{s}_pr AS (SELECT *, tp / (tp + fp) AS pr, tp / (tp + fn) AS re FROM {s}_cells),
{s} AS (SELECT 'auc' AS metric, (SELECT sum(p * (below + CAST(0.5 AS DOUBLE) * q)) / (sum(p) * sum(q)) FROM {s}_running) AS value
  UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn) FROM {s}_pr UNION ALL SELECT 'precision', pr FROM {s}_pr UNION ALL SELECT 'recall', re FROM {s}_pr
  UNION ALL SELECT 'f1', 2 * pr * re / (pr + re) FROM {s}_pr UNION ALL SELECT 'f0_5', CAST(1.25 AS DOUBLE) * pr * re / (CAST(0.25 AS DOUBLE) * pr + re) FROM {s}_pr
  UNION ALL SELECT 'f2', 5 * pr * re / (4 * pr + re) FROM {s}_pr UNION ALL SELECT 'true_positive_rate', re FROM {s}_pr
  UNION ALL SELECT 'true_negative_rate', tn / (tn + fp) FROM {s}_pr UNION ALL SELECT 'false_positive_rate', fp / (tn + fp) FROM {s}_pr)"""


def _statistics(spark, folder, split):
    part = split_records(spark, folder).where(F.col("split") == split)
    return M.model_quality_statistics(part, "coarse_score", "label", 0.7)


@query("q13_model_quality_statistics", check(f"WITH {_MQ.format(s='validation')} SELECT metric, round(value, 6) AS value FROM validation"))
def _(spark, folder):
    return rounded(_statistics(spark, folder, "validation"))


@query("q14_model_quality_violations", check(f"""WITH {_MQ.format(s='validation')}, {_MQ.format(s='production')}
SELECT metric, round(p.value, 6) AS current, round(v.value, 6) AS baseline FROM validation v JOIN production p USING (metric)
WHERE CASE metric WHEN 'false_positive_rate' THEN p.value > v.value ELSE p.value < v.value END"""))
def _(spark, folder):
    return rounded(M.model_quality_violations(_statistics(spark, folder, "validation"), _statistics(spark, folder, "production")))


_POINTS = f"""{_DQ_SQL}, {_VIOLATIONS}, {_MQ.format(s='validation')}, {_BIAS.strip()},
points AS (SELECT 'DataQualityViolationCount' AS name, constraint_check_type AS dimension_, CAST(count(*) AS DOUBLE) AS value FROM violations GROUP BY ROLLUP (2)
UNION ALL SELECT 'ModelQuality_' || metric, NULL, value FROM validation WHERE metric <> 'true_negative_rate'
UNION ALL SELECT 'DisparateImpact', bb."column" || '=' || bb.value, disparate_impact FROM bb UNION ALL SELECT 'AccuracyDifference', bb."column" || '=' || bb.value, accuracy_difference FROM bb
UNION ALL SELECT 'RecallDifference', bb."column" || '=' || bb.value, recall_difference FROM bb)"""
# Both texts name intermediate tables g, t, o, b and long; the bias ones are renamed here.
for _old, _new in (("flagged AS", "bflagged AS"), ("FROM flagged", "FROM bflagged")):
    _POINTS = _POINTS.replace(_old, _new)
_POINTS = _POINTS.replace(_BIAS.strip().replace("flagged AS", "bflagged AS").replace("FROM flagged", "FROM bflagged"),
                          _BIAS.strip().replace("flagged AS", "bflagged AS").replace("FROM flagged", "FROM bflagged")
                          .replace("long AS", "blong AS").replace("FROM long", "FROM blong").replace("\nb AS", "\nbb AS"))
_SHOW_POINTS = "SELECT 'riskmart/monitoring' AS namespace, name, dimension_ AS \"dimension\", round(value, 6) AS value FROM points"


def _points(spark, folder):
    df = records(spark, folder).withColumn("p", flag_at(F.col("score"), 0.7))
    bias = fairness.bias_metrics(df, {"priority": None, "status": None}, "label", "p")
    return monitor_jobs.monitoring_points(_violations(spark, folder), _statistics(spark, folder, "validation"), bias)


@query("q15_metric_points", check(f"WITH {_POINTS} {_SHOW_POINTS}"))
def _(spark, folder):
    return rounded(_points(spark, folder))


# --- event rules and alarms ---------------------------------------------------------------------------------------

_RULES = [
    EventRule("failures", {"event_type": ["error"]}, {"k": list(range(0, 20))}),
    EventRule("purchases", {"event_type": ["purchase", "click"]}, {"k": [7, 42, 99]}),
    EventRule("everything_ten", {}, {"k": [10]}),
]


@query("t1_event_rules", """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
SELECT event_id, 'failures' AS rule FROM e WHERE event_type = 'error' AND k BETWEEN 0 AND 19
UNION ALL SELECT event_id, 'purchases' FROM e WHERE event_type IN ('purchase', 'click') AND k IN (7, 42, 99)
UNION ALL SELECT event_id, 'everything_ten' FROM e WHERE k = 10""")
def _(spark, folder):
    return route_events(table(spark, folder, "events"), _RULES, "props").select("event_id", "rule")


@query("t1_job_failures", """
SELECT event_id, 'job-failure-' || lower(CASE event_type WHEN 'click' THEN 'ClickStatus' ELSE 'ViewStatus' END) AS rule FROM events
WHERE event_type IN ('click', 'view') AND CAST(json_extract_string(props, '$.k') AS INT) % 5 IN (0, 1)""")
def _(spark, folder):
    """State changes as a bus delivers them: a source, a detail type, and the status inside a JSON detail."""
    k = F.get_json_object("props", "$.k").cast("int") % 5
    state = F.when(k == 0, "Failed").when(k == 1, "Stopped").otherwise("Completed")
    kind = F.initcap("event_type")
    detail = F.to_json(F.map_from_arrays(F.array(F.concat(kind, F.lit("Status")), F.lit("nested")), F.array(state, F.col("props"))))
    events = table(spark, folder, "events").select(
        "event_id", F.lit("jobs").alias("source"), F.concat(kind, F.lit(" Job State Change")).alias("detail_type"), detail.alias("detail"))
    rules = job_failure_rules("jobs", {"Click Job State Change": "ClickStatus", "View Job State Change": "ViewStatus"})
    return route_events(events, rules, "detail").select("event_id", "rule")


_ALARMS = """SELECT time_bucket(INTERVAL '60 seconds', ts) AS period_start, event_type, round(avg(value), 6) AS average, count(*) AS n
FROM events GROUP BY 1, 2 HAVING avg(value) > 20"""


@query("t2_threshold_alarms", _ALARMS)
def _(spark, folder):
    return rounded(threshold_alarms(table(spark, folder, "events"), "ts", "event_type", "value", 20.0))


@query("t2_threshold_alarms_streamed", _ALARMS)
def _(spark, folder):
    source = table(spark, folder, "events")
    sink, state = work_path(spark, "alarms"), work_path(spark, "alarms-state")
    copy = work_path(spark, "events")
    # Shuffled over many files, one per trigger, so rows are late by up to the span of the table: the watermark allows for
    # that. An event far ahead then closes the last period.
    source.repartition(8, F.xxhash64("event_id")).write.parquet(copy)
    latest = source.agg(F.max("ts").alias("ts")).select((F.col("ts") + F.expr("INTERVAL 400 DAYS")).alias("ts"))
    closing = latest.select(F.lit(-1).cast("bigint").alias("event_id"), "ts", F.lit(-1).cast("bigint").alias("user_id"),
                            F.lit("closing").alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"))

    def run() -> None:
        stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(copy)
        alarms = threshold_alarms(stream, "ts", "event_type", "value", 20.0, watermark="365 days")
        query_ = (alarms.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state)
                  .outputMode("append").trigger(availableNow=True).start())
        query_.awaitTermination()

    run()
    closing.write.mode("append").parquet(copy)
    run()
    return rounded(spark.read.parquet(sink))


@query("t1_event_rules_streamed", """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
SELECT rule, count(*) AS n FROM (SELECT 'failures' AS rule FROM e WHERE event_type = 'error' AND k BETWEEN 0 AND 19
UNION ALL SELECT 'purchases' FROM e WHERE event_type IN ('purchase', 'click') AND k IN (7, 42, 99)
UNION ALL SELECT 'everything_ten' FROM e WHERE k = 10) GROUP BY rule""")
def _(spark, folder):
    source = table(spark, folder, "events")
    sink, state, copy = (work_path(spark, n) for n in ("routed", "routed-state", "events"))
    source.write.parquet(copy)
    routed = route_events(spark.readStream.schema(source.schema).parquet(copy), _RULES, "props")
    query_ = (routed.select("event_id", "rule").writeStream.format("parquet").option("path", sink)
              .option("checkpointLocation", state).trigger(availableNow=True).start())
    query_.awaitTermination()
    return spark.read.parquet(sink).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


# --- composite jobs -----------------------------------------------------------------------------------------------

_FEATURES = ["encounter_id", "patient_nbr", "race", "gender", "age", *S.COUNTER_COLUMNS, "payer_code", "medical_specialty",
             "diag_1", "diag_2", "diag_3", "max_glu_serum", "A1Cresult", "insulin", "metformin", "change", "diabetesMed",
             "readmit_30", "diag_1_group", "diag_2_group", "diag_3_group", "age_ordinal", "n_med_changes", "n_diabetes_meds",
             "a1c_tested", "a1c_level", "glu_tested", "glu_level", "specialty_missing", "payer_missing", "admission_type",
             "discharge_disposition", "admission_source", "prior_visits_total"]


@query("z1_clean_and_transform", check(f"SELECT {', '.join(_FEATURES)} FROM clean"))
def _(spark, folder):
    return clean_and_transform(encounters(spark, folder), dimensions(spark, folder)).select(*_FEATURES)


_EXACT = """ordered AS (SELECT patient_nbr, row_number() OVER (ORDER BY md5('42:' || patient_nbr), patient_nbr) - 1 AS i,
  count(*) OVER () AS n FROM (SELECT DISTINCT patient_nbr FROM clean)),
assigned AS (SELECT patient_nbr, CASE WHEN i < floor(CAST(0.4 AS DOUBLE) * n) THEN 'train' WHEN i < floor(CAST(0.5 AS DOUBLE) * n) THEN 'validation'
  WHEN i < floor(CAST(0.6 AS DOUBLE) * n) THEN 'test' ELSE 'production' END AS part FROM ordered)"""


@query("z2_split_job", check(f"""WITH {_EXACT}
SELECT t.split, CAST(t.target AS DOUBLE) AS target, count(c.encounter_id) AS n, CAST(sum(c.readmit_30) AS BIGINT) AS positives,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM clean), 6) AS share, round(avg(c.readmit_30), 6) AS prevalence
FROM {_SPLIT_VALUES} JOIN assigned a ON a.part = t.split JOIN clean c ON c.patient_nbr = a.patient_nbr GROUP BY t.split, t.target"""))
def _(spark, folder):
    name, path = _table(spark, "model_features")
    # The given tables are samples with down to a hundred rows per split: lower floor, wider tolerances than the defaults.
    reports_ = jobs.run_split_job(
        spark, encounters(spark, folder), dimensions(spark, folder), Settings(), name, path, exact=True, floor=100,
        proportion_tolerance=0.25, prevalence_tolerance=0.25)
    return rounded(reports_["splits"])


@query("z2_positive_rate_per_split", """
WITH kept AS (SELECT o_orderkey, o_custkey, CAST(o_orderstatus = 'F' AS INT) AS label, """ + split_case("o_custkey") + """ AS split FROM orders WHERE o_orderstatus <> 'P')
SELECT split, count(*) AS n, count(DISTINCT o_custkey) AS n_entities, round(avg(label), 6) AS positive_rate FROM kept GROUP BY split""")
def _(spark, folder):
    df = table(spark, folder, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_orderstatus")
    labelled = assign_hash_split(binary_target(df, "o_orderstatus", "F", "label"), "o_custkey", DEFAULT_SEED, DEFAULT_SPLITS)
    return rounded(labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("n_entities"), F.avg("label").alias("positive_rate")))


@query("z3_feature_job", check("""
SELECT CAST('2023-11-14' AS DATE) AS event_date, count(*) AS n, count(DISTINCT patient_nbr) AS n_patients,
  CAST(sum(CASE WHEN race IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_race_missing, CAST(sum(prior_visits_total) AS BIGINT) AS visits FROM clean"""))
def _(spark, folder):
    name, path = _table(spark, "encounter_features")
    jobs.run_feature_job(spark, clean(spark, folder).drop("split"), name, path, 1700000000.0)
    return spark.table(name).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("patient_nbr").alias("n_patients"),
        F.count(F.when(F.col("race") == "Missing", 1)).alias("n_race_missing"), F.sum("prior_visits_total").alias("visits"))


_MONITORED = [c for c in _FEATURES if c not in ("encounter_id", "patient_nbr", "readmit_30")]


@query("z6_data_quality_job", check(f"WITH {_dq_sql('SELECT * FROM clean', _MONITORED, _MONITORED)}, {_VIOLATIONS} SELECT * FROM violations"))
def _(spark, folder):
    df = clean(spark, folder)
    return monitor_jobs.data_quality_job(df.where("split = 'train'"), df.where("split = 'production'"), _MONITORED, _MONITORED)


@query("a19_clean_run_total", "SELECT CAST(NULL AS VARCHAR) AS check_type, CAST(0 AS BIGINT) AS n FROM region LIMIT 1")
def _(spark, folder):
    """A data set against itself breaks no constraint; the total says so."""
    half = _halves(spark, folder)[0]
    return M.violation_counts(M.data_quality_violations(half, half, _DQ, _DQ_CATEGORICAL))


@query("z8_publish_metrics", check(f"WITH {_POINTS} SELECT name, count(*) AS n, round(sum(value), 5) AS total FROM points GROUP BY name"))
def _(spark, folder):
    name, path = _table(spark, "metrics")
    monitor_jobs.publish_metrics(_points(spark, folder), name, path, 1700000000.0)
    return spark.table(name).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 5).alias("total"))
