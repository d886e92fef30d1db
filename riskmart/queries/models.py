"""Encoders, learners, calibration, the bundle, and the jobs built on them.

Small linear fits are checked against Newton's method written in SQL. Larger learners have no SQL twin; their numbers
are tested against independent arithmetic on fixtures. Iteration counts are small because these are checks, not tuned models.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..functions import platt
from ..operators import attribution, evaluation as E, modeling as M, search
from ..operators.cleaning import feature_names
from ..operators.fairness import bias_metrics, fairness_report, long_report
from ..operators.ranking import ranking_metrics
from ..plans import evaluation as jobs, monitoring as monitor_jobs
from ..session import materialise, work_path
from ..sources.catalog import read_partition, write_partitioned
from ..sources.csv import union_by_name
from .aggregates import rounded
from .registry import query
from .sql import check
from .storage import _table
from .tables import clean, records

SMALL = {"max_depth": 3, "num_round": 5, "eta": 0.3}
_written: dict[tuple[str, str], str] = {}


def features(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """One split of the feature table, written once per session; its rows come spread, so they are not shuffled for that."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _written:
        name, path = _table(spark, "modelling")
        write_partitioned(clean(spark, folder), name, path, spread=True)
        _written[key] = name
    return read_partition(spark, _written[key], split)


def _schema(df: DataFrame, names: list[str] | None = None) -> M.FeatureSchema:
    return M.feature_schema(df, names or feature_names(df.columns), S.TARGET)


_LEVEL_COLUMNS = ["race", "payer_code", "diag_1", "admission_source"]


def _level_sql(c: str) -> str:
    return (f"coalesce((SELECT i FROM levels l WHERE l.c = '{c}' AND l.v = p.{c}), (SELECT count(*) FROM levels l WHERE l.c = '{c}'))")


@query("m1_category_levels", check("WITH levels AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT {c} AS v FROM clean WHERE split = 'train' AND {c} IS NOT NULL)" for c in _LEVEL_COLUMNS)
    + ") SELECT encounter_id, " + ", ".join(f"CAST({_level_sql(c)} AS DOUBLE) AS {c}" for c in _LEVEL_COLUMNS) + " FROM clean p WHERE split = 'production'"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    train = features(spark, folder, "train")
    model = M.encoder(_schema(train, [*_LEVEL_COLUMNS, "time_in_hospital"])).fit(train)
    encoded = model.transform(features(spark, folder, "production"))
    return encoded.select("encounter_id", *[F.col(f"{c}__level").alias(c) for c in _LEVEL_COLUMNS])


@query("m2_one_hot_and_scaling", check("""
WITH s AS (SELECT avg(time_in_hospital) AS m1, stddev_pop(time_in_hospital) AS d1, avg(number_inpatient) AS m2, stddev_pop(number_inpatient) AS d2 FROM clean WHERE split = 'train'),
known AS (SELECT DISTINCT coalesce(medical_specialty, 'Missing') AS v FROM clean WHERE split = 'train')
SELECT encounter_id, round((time_in_hospital - m1) / d1, 6) AS time_in_hospital, round((number_inpatient - m2) / d2, 6) AS number_inpatient,
  CAST(CASE WHEN coalesce(medical_specialty, 'Missing') IN (SELECT v FROM known) THEN 1 ELSE 0 END AS DOUBLE) AS hot FROM clean, s WHERE split = 'production'"""))
def _(spark, folder):
    train = features(spark, folder, "train")
    model = M.fit_logistic(train, _schema(train, ["medical_specialty", "time_in_hospital", "number_inpatient"]), S.TARGET)
    prepared = PipelineModel(stages=model.stages[:-1]).transform(features(spark, folder, "production"))
    numbers, slots = vector_to_array("standardised"), vector_to_array("medical_specialty__slots")
    return prepared.select("encounter_id", F.round(numbers[0], 6).alias("time_in_hospital"), F.round(numbers[1], 6).alias("number_inpatient"),
                           F.aggregate(slots, F.lit(0.0), lambda a, b: a + b).alias("hot"))


@query("m3_full_logistic")
def _(spark, folder):
    train, test = features(spark, folder, "train"), features(spark, folder, "test")
    model = M.fit_logistic(train, _schema(train), S.TARGET)
    return rounded(ranking_metrics(M.add_score(test, model), "score", S.TARGET))


# Newton's method for the same penalised objective, over cells of equal features.
_FIT_2 = """
WITH RECURSIVE cells AS (SELECT CAST(number_inpatient AS DOUBLE) AS x1, CAST(number_emergency AS DOUBLE) AS x2, CAST(count(*) AS DOUBLE) AS n,
  CAST(sum(readmit_30) AS DOUBLE) AS pos FROM clean WHERE split = 'train' GROUP BY 1, 2),
fit AS (SELECT 0 AS i, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2, CAST(0 AS DOUBLE) AS b
UNION ALL
SELECT i + 1, w1 - ((h22 * h33 - h23 * h23) * g1 + (h13 * h23 - h12 * h33) * g2 + (h12 * h23 - h13 * h22) * g3) / det,
  w2 - ((h13 * h23 - h12 * h33) * g1 + (h11 * h33 - h13 * h13) * g2 + (h12 * h13 - h11 * h23) * g3) / det,
  b - ((h12 * h23 - h13 * h22) * g1 + (h12 * h13 - h11 * h23) * g2 + (h11 * h22 - h12 * h12) * g3) / det
FROM (SELECT *, h11 * (h22 * h33 - h23 * h23) - h12 * (h12 * h33 - h13 * h23) + h13 * (h12 * h23 - h13 * h22) AS det FROM (
  SELECT i, w1, w2, b, sum(x1 * (n * p - pos)) + w1 AS g1, sum(x2 * (n * p - pos)) + w2 AS g2, sum(n * p - pos) AS g3,
    sum(n * p * (1 - p) * x1 * x1) + 1 AS h11, sum(n * p * (1 - p) * x1 * x2) AS h12, sum(n * p * (1 - p) * x1) AS h13,
    sum(n * p * (1 - p) * x2 * x2) + 1 AS h22, sum(n * p * (1 - p) * x2) AS h23, sum(n * p * (1 - p)) AS h33
  FROM (SELECT *, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p FROM fit, cells WHERE i < 15) GROUP BY i, w1, w2, b)))
SELECT * FROM fit WHERE i = 15"""
_NEWTON_2 = f"SELECT round(w1, 4) AS w1, round(w2, 4) AS w2, round(b, 4) AS intercept FROM ({_FIT_2})"
_SCORED_2 = f"""scored AS (SELECT c.*, 1 / (1 + exp(-(w1 * number_inpatient + w2 * number_emergency + b))) AS s FROM clean c, ({_FIT_2}) f)"""
_CELLS_2 = """count(*) FILTER (p = 0 AND y = 0) AS tn, count(*) FILTER (p = 1 AND y = 0) AS fp, count(*) FILTER (p = 0 AND y = 1) AS fn, count(*) FILTER (p = 1 AND y = 1) AS tp"""


@query("m4_two_feature_logistic", check(_NEWTON_2))
def _(spark, folder):
    train = features(spark, folder, "train")
    weights, intercept = M.coefficients(M.fit_plain_logistic(train, jobs.BENCHMARK_FEATURES, S.TARGET))
    return spark.createDataFrame([(round(weights[0], 4), round(weights[1], 4), round(intercept, 4))], "w1 double, w2 double, intercept double")


@query("m4_two_feature_logistic_metrics", check(f"""WITH {_SCORED_2},
cells AS (SELECT {_CELLS_2} FROM (SELECT readmit_30 AS y, CAST(s >= 0.5 AS INT) AS p FROM scored WHERE split = 'validation')),
r AS (SELECT *, coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS pr, coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) AS re FROM cells)
SELECT tn, fp, fn, tp, round((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS accuracy, round(pr, 6) AS precision, round(re, 6) AS recall,
  round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 6) AS f1, round(coalesce(1.25 * pr * re / nullif(0.25 * pr + re, 0), 0), 6) AS f0_5,
  round(coalesce(5 * pr * re / nullif(4 * pr + re, 0), 0), 6) AS f2, round(re, 6) AS true_positive_rate,
  round(coalesce(fp / CAST(nullif(fp + tn, 0) AS DOUBLE), 0), 6) AS false_positive_rate, round(coalesce(tn / CAST(nullif(fp + tn, 0) AS DOUBLE), 0), 6) AS true_negative_rate FROM r"""))
def _(spark, folder):
    train, validation = features(spark, folder, "train"), features(spark, folder, "validation")
    model = M.fit_plain_logistic(train, jobs.BENCHMARK_FEATURES, S.TARGET)
    scored = M.add_score(validation, model).withColumn("p", (F.col("score") >= 0.5).cast("int"))
    return rounded(E.prediction_metrics(scored, S.TARGET, "p"))


@query("m5_majority_class", check("""
SELECT split, round(avg(1 - label), 6) AS accuracy, CAST(0 AS DOUBLE) AS recall, CAST(0 AS DOUBLE) AS precision, round(avg(label), 6) AS pr_auc, round(avg(label), 6) AS base_rate
FROM split_records GROUP BY split"""))
def _(spark, folder):
    from .tables import split_records

    return rounded(E.majority_class_metrics(split_records(spark, folder), "label", ["split"]))


@query("m6_heuristic_metrics", check("""
WITH c AS (SELECT split, count(*) FILTER (h = 1 AND y = 1) AS tp, count(*) FILTER (h = 1 AND y = 0) AS fp, count(*) FILTER (h = 0 AND y = 1) AS fn, count(*) FILTER (h = 0 AND y = 0) AS tn
  FROM (SELECT split, CAST(number_inpatient >= 1 AS INT) AS h, readmit_30 AS y FROM clean) GROUP BY split)
SELECT split, round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision,
  round((tp / CAST(tp + fn AS DOUBLE)) * (tp / CAST(tp + fp AS DOUBLE)) + (fn / CAST(tp + fn AS DOUBLE)) * ((tp + fn) / CAST(tp + fp + fn + tn AS DOUBLE)), 6) AS pr_auc,
  round((tp / CAST(tp + fn AS DOUBLE)) * (tn / CAST(tn + fp AS DOUBLE)) + 0.5 * ((tp / CAST(tp + fn AS DOUBLE)) * (fp / CAST(tn + fp AS DOUBLE)) + (fn / CAST(tp + fn AS DOUBLE)) * (tn / CAST(tn + fp AS DOUBLE))), 6) AS roc_auc FROM c"""))
def _(spark, folder):
    df = jobs.heuristic(clean(spark, folder))
    at = E.prediction_metrics(df, S.TARGET, "heuristic", ["split"]).select("split", "accuracy", "recall", "precision")
    ranked = ranking_metrics(df, "heuristic", S.TARGET, ["split"]).select("split", "pr_auc", "roc_auc")
    return rounded(at.join(ranked, "split"))


@query("m7_boosted_trees")
def _(spark, folder):
    train, validation = features(spark, folder, "train"), features(spark, folder, "validation")
    model = M.fit_boosted(train, _schema(train), S.TARGET, SMALL, validation)
    return rounded(ranking_metrics(M.add_score(validation, model), "score", S.TARGET))


@query("m8_random_search")
def _(spark, folder):
    train, validation = features(spark, folder, "train"), features(spark, folder, "validation")
    ranges = {**search.SEARCH_RANGES, "max_depth": (2, 3, "integer"), "num_round": (2, 3, "integer")}
    trials, _best = search.random_search(train, validation, _schema(train), S.TARGET, trials=2, parallelism=2, ranges=ranges)
    return trials


_NEWTON_1 = """
SELECT round(w, 4) AS slope, round(b, 4) AS intercept FROM (
WITH RECURSIVE cells AS (SELECT coarse_score AS x, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS pos FROM records GROUP BY 1),
fit AS (SELECT 0 AS i, CAST(0 AS DOUBLE) AS w, CAST(0 AS DOUBLE) AS b
UNION ALL
SELECT i + 1, w - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), b - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
FROM (SELECT i, w, b, sum(x * (n * p - pos)) + w AS g1, sum(n * p - pos) AS g2, sum(n * p * (1 - p) * x * x) + 1 AS h11,
    sum(n * p * (1 - p) * x) AS h12, sum(n * p * (1 - p)) AS h22
  FROM (SELECT *, 1 / (1 + exp(-(w * x + b))) AS p FROM fit, cells WHERE i < 15) GROUP BY i, w, b))
SELECT * FROM fit WHERE i = 15)"""


@query("m9_platt_fit", check(_NEWTON_1))
def _(spark, folder):
    a, b = M.fit_platt(records(spark, folder).select("coarse_score", "label"), "coarse_score", "label")
    return spark.createDataFrame([(round(a, 4), round(b, 4))], "slope double, intercept double")


@query("m9_calibrated_scores")
def _(spark, folder):
    train, validation = features(spark, folder, "train"), features(spark, folder, "validation")
    model = M.fit_boosted(train, _schema(train), S.TARGET, SMALL)
    a, b = M.fit_platt(M.add_score(validation, model), "score", S.TARGET)
    calibrated = M.add_score(features(spark, folder, "test"), model).withColumn("calibrated", platt(F.col("score"), a, b))
    return calibrated.select("encounter_id", "score", "calibrated")


_CAL_LEVELS = """WITH two AS (SELECT 'uncalibrated' AS stage, coarse_score AS s, label FROM records
  UNION ALL SELECT 'calibrated', 1 / (1 + exp(-(CAST(3 AS DOUBLE) * coarse_score - CAST(2 AS DOUBLE)))), label FROM records),
levels AS (SELECT stage, round(s, 9) AS s, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS q FROM two GROUP BY stage, round(s, 9)),
running AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY stage ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM levels)"""


@query("m10_calibration_report", check(_CAL_LEVELS + """
SELECT r.stage, round(sum(p * (below + CAST(0.5 AS DOUBLE) * q)) / (sum(p) * sum(q)), 6) AS roc_auc, max(b.brier) AS brier_score
FROM running r JOIN (SELECT stage, round(avg(pow(s - label, 2)), 6) AS brier FROM two GROUP BY stage) b ON b.stage = r.stage GROUP BY r.stage"""))
def _(spark, folder):
    df = records(spark, folder).withColumn("calibrated", platt(F.col("coarse_score"), 3.0, -2.0))
    return rounded(M.calibration_report(df, "coarse_score", "calibrated", "label"))


def _bundle(spark: SparkSession, folder: str) -> M.Bundle:
    """Fit on train, calibrate and freeze on validation, save, load again."""
    train, validation = features(spark, folder, "train"), features(spark, folder, "validation")
    schema = _schema(train)
    model = M.fit_boosted(train, schema, S.TARGET, SMALL)
    # Calibration and threshold read the scores several times, so the model runs once.
    scored = materialise(M.add_score(validation.select(*schema.order, S.TARGET), model).select("score", S.TARGET), "scored")
    a, b = M.fit_platt(scored, "score", S.TARGET)
    calibrated = scored.withColumn("probability", platt(F.col("score"), a, b))
    threshold = E.alert_volume_threshold(calibrated, "probability", 0.10).first()["threshold"]
    path = work_path(spark, "bundle")
    M.save_bundle(spark, path, model, schema, a, b, threshold, 0.10, "2024-01-01T00:00:00Z")
    return M.load_bundle(spark, path)


@query("m11_m12_score_through_bundle")
def _(spark, folder):
    bundle = _bundle(spark, folder)
    return bundle.score(features(spark, folder, "production"), "encounter_id", [S.TARGET])


@query("j5_scores_stay_with_their_rows", check("""
SELECT number_inpatient, number_emergency, count(DISTINCT encounter_id) AS n, CAST(1 AS BIGINT) AS n_scores FROM clean WHERE split = 'production' GROUP BY 1, 2"""))
def _(spark, folder):
    # The model reads two counters only, so rows with equal counters must get one score whatever their identifier.
    model = M.fit_plain_logistic(features(spark, folder, "train"), jobs.BENCHMARK_FEATURES, S.TARGET)
    production = features(spark, folder, "production")
    scored = M.add_score(production, model).select("encounter_id", "score")
    return production.join(scored, "encounter_id").groupBy(*jobs.BENCHMARK_FEATURES).agg(
        F.countDistinct("encounter_id").alias("n"), F.countDistinct("score").alias("n_scores"))


@query("j5_identifier_rides_along", check(f"WITH {_SCORED_2} SELECT encounter_id, round(s, 4) AS score FROM scored WHERE split = 'production'"))
def _(spark, folder):
    train = features(spark, folder, "train")
    model = M.fit_plain_logistic(train, jobs.BENCHMARK_FEATURES, S.TARGET)
    return M.add_score(features(spark, folder, "production"), model).select("encounter_id", F.round("score", 4).alias("score"))


@query("m13_column_ablation")
def _(spark, folder):
    train, test = features(spark, folder, "train"), features(spark, folder, "test")
    return rounded(attribution.ablate(train, test, feature_names(train.columns), "race", S.TARGET, params=SMALL))


@query("m14_linear_attribution")
def _(spark, folder):
    train = features(spark, folder, "train")
    schema = _schema(train)
    model = M.fit_logistic(train, schema, S.TARGET)
    return rounded(attribution.linear_attribution(model, schema, features(spark, folder, "production"), "encounter_id"))


@query("m14_permutation_importance")
def _(spark, folder):
    train = features(spark, folder, "train")
    schema = _schema(train)
    model = M.fit_boosted(train, schema, S.TARGET, SMALL)
    return rounded(attribution.permutation_importance(model, schema, features(spark, folder, "production"), S.TARGET, "encounter_id"))


@query("f5_fairness_report")
def _(spark, folder):
    train, production = features(spark, folder, "train"), features(spark, folder, "production")
    schema = _schema(train)
    model = M.fit_logistic(train, schema, S.TARGET)
    flagged = M.add_score(production, model).withColumn("p", (F.col("score") >= 0.35).cast("int"))
    bias = bias_metrics(flagged, {"race": None, "gender": ["Female"]}, S.TARGET, "p")
    return rounded(fairness_report(bias, attribution.linear_attribution(model, schema, production, "encounter_id")))


@query("z4_benchmark_report", check(f"""WITH {_SCORED_2},
b AS (SELECT split, readmit_30 AS y, CAST(number_inpatient >= 1 AS INT) AS h, s FROM scored WHERE split IN ('train', 'validation')),
m AS (SELECT 'heuristic' AS model, split, y, CAST(h AS DOUBLE) AS s, h AS p FROM b UNION ALL SELECT 'logistic', split, y, s, CAST(s >= 0.5 AS INT) FROM b),
cells AS (SELECT model, split, {_CELLS_2} FROM m GROUP BY 1, 2),
levels AS (SELECT model, split, round(s, 12) AS s, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg FROM m GROUP BY ALL),
running AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM levels WINDOW w AS (PARTITION BY model, split ORDER BY s DESC)),
ranked AS (SELECT model, split, sum(pos * cp / (cp + cn)) / sum(pos) AS pr_auc, 1 - sum(pos * (cn - neg / 2)) / (sum(pos) * sum(neg)) AS roc_auc FROM running GROUP BY 1, 2),
wide AS (SELECT model, split, (tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE) AS accuracy, coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) AS recall,
  coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS precision, pr_auc, roc_auc FROM cells JOIN ranked USING (model, split)),
base AS (SELECT split, CAST(1 - avg(y) AS DOUBLE) AS accuracy, CAST(0 AS DOUBLE) AS recall, CAST(0 AS DOUBLE) AS precision, CAST(avg(y) AS DOUBLE) AS pr_auc, CAST(avg(y) AS DOUBLE) AS base_rate FROM b GROUP BY 1)
SELECT model, split, metric, round(value, 6) AS value FROM (UNPIVOT wide ON accuracy, recall, precision, pr_auc, roc_auc INTO NAME metric VALUE value)
UNION ALL SELECT 'majority_class', split, metric, round(value, 6) FROM (UNPIVOT base ON accuracy, recall, precision, pr_auc, base_rate INTO NAME metric VALUE value)"""))
def _(spark, folder):
    return rounded(jobs.benchmark_report(features(spark, folder, "train"), features(spark, folder, "validation"), S.TARGET))


@query("z5_evaluation_job")
def _(spark, folder):
    parts = {name: features(spark, folder, name) for name in ("train", "validation", "test")}
    models = jobs.fit_models(parts["train"], parts["validation"], _schema(parts["train"]), S.TARGET, SMALL)
    scored = {}
    for name in ("validation", "test"):
        # Written once: the evaluation reads every scored frame several times.
        path = work_path(spark, f"scored-{name}")
        jobs.score_all(parts[name], models, S.TARGET, "encounter_id", ("race", "gender", "age_ordinal")).write.parquet(path)
        scored[name] = spark.read.parquet(path)
    ablation = attribution.ablate(parts["train"], parts["test"], feature_names(parts["train"].columns), "race", S.TARGET, params=SMALL)
    report = jobs.evaluation_report(scored["validation"], scored["test"], S.TARGET, "encounter_id", ablation=ablation)
    keys = {"comparison": ["model"], "metrics": ["model"], "subgroups": ["column", "value"], "calibration": ["bin"], "ablation": ["variant", "column", "value"]}
    return rounded(union_by_name([long_report(report[name], own, name) for name, own in keys.items()]))


@query("z7_model_quality_job")
def _(spark, folder):
    report = monitor_jobs.model_quality_job(
        _bundle(spark, folder), features(spark, folder, "validation"), features(spark, folder, "production"), "encounter_id", S.TARGET)
    sides = [report[name].select(F.lit(name).alias("report"), "metric", "value") for name in ("baseline", "current")]
    worse = report["violations"].select(F.lit("violations").alias("report"), "metric", F.col("current").alias("value"))
    return rounded(union_by_name([*sides, worse]))
