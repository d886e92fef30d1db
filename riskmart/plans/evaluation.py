"""Benchmarks, model comparison and the frozen bundle."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..functions import platt
from ..operators.boosting import BoostedTrees, fit_second_order
from ..operators.evaluation import (
    alert_volume_threshold, calibration_curve, full_metrics, headline, majority_class_metrics, prediction_metrics,
    score_columns_to_rows, subgroup_metrics,
)
from ..operators.fairness import long_report
from ..operators.modeling import FeatureSchema, add_score, fit_boosted, fit_logistic, fit_platt, fit_plain_logistic
from ..operators.ranking import ranking_metrics
from ..session import materialise

# The two counters and the rule of the benchmark, its decision threshold, the subgroup columns.
BENCHMARK_FEATURES = ["number_inpatient", "number_emergency"]
HEURISTIC_COUNTER, HEURISTIC_MINIMUM = "number_inpatient", 1
BENCHMARK_THRESHOLD = 0.5
SUBGROUP_COLUMNS = ["race", "gender", "age_ordinal"]


def heuristic(df: DataFrame, counter: str = HEURISTIC_COUNTER, minimum: int = HEURISTIC_MINIMUM,
              output: str = "heuristic") -> DataFrame:
    """0/1 rule: the counter reaches the minimum."""
    return df.withColumn(output, F.coalesce((F.col(counter) >= minimum).cast("int"), F.lit(0)))


def benchmark_report(train: DataFrame, validation: DataFrame, target: str) -> DataFrame:
    """Long table ``model, split, metric, value`` for the three benchmarks."""
    parts = []
    both = train.withColumn("split", F.lit("train")).unionByName(validation.withColumn("split", F.lit("validation")))
    majority = majority_class_metrics(both, target, ["split"])
    parts.append(long_report(majority, ["split"], "majority_class"))

    model = fit_plain_logistic(train, BENCHMARK_FEATURES, target)
    scored = add_score(heuristic(both), model, "logistic").withColumn(
        "logistic_flag", (F.col("logistic") >= BENCHMARK_THRESHOLD).cast("int"))
    for name, score, flag in (("heuristic", "heuristic", "heuristic"), ("logistic", "logistic", "logistic_flag")):
        at = prediction_metrics(scored, target, flag, ["split"]).select("split", "accuracy", "recall", "precision")
        ranked = ranking_metrics(scored, score, target, ["split"]).select("split", "pr_auc", "roc_auc")
        parts.append(long_report(at.join(ranked, "split"), ["split"], name))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(F.col("section").alias("model"), F.col("subject").alias("split"), "metric", "value")


@dataclass(frozen=True)
class FittedModels:
    logistic: PipelineModel
    boosted: PipelineModel | BoostedTrees
    calibration: tuple[float, float]
    base_rate: float


def fit_models(
    train: DataFrame, validation: DataFrame, schema: FeatureSchema, target: str,
    boosting: Mapping[str, float] | None = None, id_column: str | None = None,
) -> FittedModels:
    """The logistic baseline, the boosted model and its calibration (fitted on validation scores).

    With ``id_column`` (rows are sampled by it) the boosted model is the second-order one, stopped by validation PR-AUC;
    without, MLlib's.
    """
    logistic = fit_logistic(train, schema, target)
    if id_column:
        boosted = fit_second_order(train, schema, target, id_column, boosting, validation).model()
    else:
        boosted = fit_boosted(train, schema, target, boosting, validation)
    calibration = fit_platt(add_score(validation, boosted, "_raw"), "_raw", target)
    base_rate = train.agg(F.avg(F.col(target).cast("double"))).first()[0]
    return FittedModels(logistic, boosted, calibration, base_rate)


def score_all(df: DataFrame, models: FittedModels, target: str, id_column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One score column per compared model."""
    scored = add_score(add_score(heuristic(df), models.logistic, "logistic"), models.boosted, "boosted")
    return scored.select(
        id_column, target, *keep, F.lit(models.base_rate).alias("majority"),
        F.col("heuristic").cast("double").alias("heuristic"), "logistic", "boosted",
        platt(F.col("boosted"), *models.calibration).alias("boosted_calibrated"),
    )


MODEL_NAMES = {
    "Majority class": "majority", "Heuristic": "heuristic", "Logistic regression": "logistic",
    "Boosted (uncalibrated)": "boosted", "Boosted (calibrated)": "boosted_calibrated",
}


FINAL_MODEL = "Boosted (calibrated)"


def evaluation_report(
    validation: DataFrame, test: DataFrame, target: str, id_column: str, alert_fraction: float = 0.10,
    subgroup_columns: tuple[str, ...] = tuple(SUBGROUP_COLUMNS), ablation: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Comparison, full metrics, subgroups and calibration curve from two scored frames (see ``score_all``).

    Persist the inputs first: every table reads them. Thresholds come from validation only. ``ablation`` is the table of a
    refit without one column (see ``attribution.ablate``), whose thresholds come from its own test scores; with it the
    report is whole.
    """
    keep = [target, id_column]
    val_long = score_columns_to_rows(validation, MODEL_NAMES, keep)
    test_long = score_columns_to_rows(test, MODEL_NAMES, keep)
    # One row per model each, written once: the tables below read them.
    thresholds = materialise(alert_volume_threshold(val_long, "score", alert_fraction, ["model"]), "thresholds")
    metrics = materialise(full_metrics(test_long, "score", target, id_column, thresholds, ["model"]), "metrics")
    final = thresholds.where(F.col("model") == FINAL_MODEL).select("threshold").scalar()
    at_final = test.withColumn("_threshold", final)
    report = {
        "comparison": headline(metrics),
        "metrics": metrics,
        "subgroups": subgroup_metrics(
            at_final, "boosted_calibrated", target, F.col("_threshold"), list(subgroup_columns)),
        "calibration": calibration_curve(test, "boosted_calibrated", target),
    }
    return report if ablation is None else {**report, "ablation": ablation}
