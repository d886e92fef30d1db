"""Metric tables at a threshold, per group and per model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .joins import join_groups
from .profiling import column_values, exact_quantiles
from .ranking import cut_levels, level_metrics, level_sums, precision_from_cuts, score_levels

METRIC_FRACTIONS = {"precision_at_5pct": 0.05, "precision_at_10pct": 0.10, "precision_at_20pct": 0.20}


def _share(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if empty is None else F.coalesce(value, F.lit(empty))


def _known(value: Column) -> Column:
    return F.when(F.col("threshold").isNotNull(), value)


def confusion_sums(label: Column, prediction: Column) -> list[Column]:
    """The four cells as aggregates, zero when a cell is empty."""
    def cell(y: int, p: int) -> Column:
        return F.count(F.when((label == y) & (prediction == p), 1))

    return [cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")]


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F scores and rates from confusion cells, kept beside the other columns."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall = _share(tp, tp + fp), _share(tp, tp + fn)

    def f_beta(beta: float) -> Column:
        weight = beta * beta
        return F.coalesce(F.try_divide((1 + weight) * precision * recall, weight * precision + recall), F.lit(0.0))

    return counts.select(
        "*",
        _share(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        f_beta(1.0).alias("f1"), f_beta(0.5).alias("f0_5"), f_beta(2.0).alias("f2"),
        recall.alias("true_positive_rate"),
        _share(fp, fp + tn).alias("false_positive_rate"),
        _share(tn, fp + tn).alias("true_negative_rate"),
    )


def prediction_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion cells and their metrics for 0/1 predictions."""
    return classification_metrics(df.groupBy(*by).agg(*confusion_sums(F.col(label), F.col(prediction))))


def majority_class_metrics(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """What always answering 0 scores; its PR-AUC is the base rate."""
    y = F.col(label).cast("double")
    return df.groupBy(*by).agg(F.avg(1 - y).alias("accuracy"), F.avg(y).alias("base_rate")).select(
        *by, "accuracy", F.lit(0.0).alias("recall"), F.lit(0.0).alias("precision"),
        F.col("base_rate").alias("pr_auc"), "base_rate",
    )


def brier_score(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier_score"))


def alert_volume_threshold(df: DataFrame, score: str, fraction: float, by: Sequence[str] = ()) -> DataFrame:
    """Score at the (1 - fraction) quantile, exact and interpolated: ``by..., threshold``."""
    return exact_quantiles(df, score, [1 - fraction], by).select(*by, F.col("value").alias("threshold"))


def full_metrics(
    df: DataFrame, score: str, label: str, id_column: str, thresholds: DataFrame | float, by: Sequence[str] = ()
) -> DataFrame:
    """All evaluation numbers, one row per group.

    ``thresholds`` is a number, or a table ``by..., threshold``. A group without a threshold keeps its ranking metrics;
    its threshold, its rates at the threshold and its confusion cells are NULL. One aggregate over the score levels yields every
    metric except the tie-breaking of precision@k.
    """
    by = list(by)
    levels = score_levels(df, score, label, by)
    if isinstance(thresholds, DataFrame):
        at = join_groups(levels, thresholds, by, "left") if by else levels.withColumn("threshold", thresholds.scalar())
    else:
        at = levels.withColumn("threshold", F.lit(float(thresholds)))
    flagged = F.col("score") >= F.col("threshold")
    neg = F.col("n") - F.col("pos")

    def total(c: Column, when: Column) -> Column:
        return F.when(F.max("threshold").isNotNull(), F.coalesce(F.sum(F.when(when, c)), F.lit(0)))

    # One row per group, written once: three tables below read it, the levels behind it are computed once.
    summary = materialise(at.groupBy(*by).agg(
        F.max("threshold").alias("threshold"),
        total(neg, ~flagged).alias("tn"), total(neg, flagged).alias("fp"),
        total(F.col("pos"), ~flagged).alias("fn"), total(F.col("pos"), flagged).alias("tp"),
        *level_sums(), cut_levels(list(METRIC_FRACTIONS.values())).alias("_cuts"),
    ), "summary")
    cuts = summary.select(*by, F.inline("_cuts")).where("k is not null")
    at_k = precision_from_cuts(cuts, df, score, label, id_column, by).groupBy(*by).agg(*[
        F.max(F.when(F.col("fraction") == F.lit(f), F.col("precision"))).alias(name)
        for name, f in METRIC_FRACTIONS.items()
    ])
    ranked = summary.select(*by, *level_metrics(), "threshold", "tn", "fp", "fn", "tp")
    if by:
        joined = join_groups(ranked, at_k, by, "left")
    else:  # one row each
        joined = ranked.withColumn("_k", at_k.select(F.struct(*METRIC_FRACTIONS)).scalar()).select("*", "_k.*")
    return joined.select(
        *by, "pr_auc", "roc_auc", "brier_score", *METRIC_FRACTIONS, "base_rate",
        _known(_share(F.col("tp"), F.col("tp") + F.col("fp"))).alias("precision_at_threshold"),
        _known(_share(F.col("tp"), F.col("tp") + F.col("fn"))).alias("recall_at_threshold"),
        "threshold", "tn", "fp", "fn", "tp",
    )


def calibration_bin(score: Column, bins: int = 10) -> Column:
    """Uniform bin of a probability; an inner edge belongs to the bin below it."""
    edges = [i * (1.0 / bins) for i in range(1, bins)]
    bin_id = F.lit(0)
    for edge in edges:
        bin_id = bin_id + (score > F.lit(edge)).cast("int")
    return bin_id


def calibration_curve(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score and observed rate per non-empty uniform bin."""
    return df.groupBy(calibration_bin(F.col(score), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("fraction_positive"),
    )


def subgroup_metrics(
    df: DataFrame, score: str, label: str, threshold: float | Column, columns: Sequence[str],
    min_rows: int = 30, by: Sequence[str] = (),
) -> DataFrame:
    """Metrics for every value of every column; NULL is the group ``Missing``; small groups are left out."""
    y, s = F.col("_y"), F.col("_s")
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    carry = [*[F.col(c) for c in by], F.col(label).cast("int").alias("_y"), F.col(score).alias("_s"),
             (F.col(score) >= cut).cast("int").alias("_p")]
    long = column_values(df, columns, carry).withColumn("value", F.coalesce("value", F.lit("Missing")))
    grouped = long.groupBy(*by, "column", "value").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("base_rate"), F.avg("_p").alias("selection_rate"),
        *confusion_sums(y, F.col("_p")), F.avg(F.pow(s - y, 2)).alias("_brier"),
        F.min("_y").alias("_low"), F.max("_y").alias("_high"),
    ).where(F.col("n") >= min_rows)
    return grouped.select(
        *by, "column", "value", "n", "base_rate", "selection_rate",
        _share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _share(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        F.when(F.col("_low") < F.col("_high"), F.col("_brier")).alias("brier_score"),
    )


def score_columns_to_rows(df: DataFrame, scores: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per (model, input row) from a frame with one score column per model."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(column).cast("double").alias("score"))
        for name, column in scores.items()
    ])
    return df.select(*keep, F.explode(pairs).alias("_m")).select("_m.model", *keep, "_m.score")


def comparison_table(
    validation: DataFrame, test: DataFrame, label: str, id_column: str, alert_fraction: float = 0.10
) -> DataFrame:
    """Five headline metrics per model on test, each at the model's own validation threshold.

    Both inputs are long: ``model, score, label, id``.
    """
    thresholds = alert_volume_threshold(validation, "score", alert_fraction, ["model"])
    return headline(full_metrics(test, "score", label, id_column, thresholds, ["model"]))


def headline(metrics: DataFrame) -> DataFrame:
    """The comparison's five numbers from the full metrics of the models."""
    return metrics.select(
        "model", F.round("pr_auc", 4).alias("pr_auc"), F.round("roc_auc", 4).alias("roc_auc"),
        F.round("precision_at_10pct", 4).alias("precision_at_10pct"),
        F.round("recall_at_threshold", 4).alias("recall_at_thr"), F.round("brier_score", 4).alias("brier"),
    )
