"""Constraint monitors: learn a baseline, compare a later data set, list the violations.

All data-quality checks read the ``(column, value, n)`` count tables of the two data sets, so each side is scanned
and shuffled once, and cells that share a value are counted before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import INTEGER_PATTERN, NUMBER_PATTERN, trimmed
from .decoding import compare_profiles
from .evaluation import confusion_sums, classification_metrics
from .ranking import ranking_metrics
from .profiling import value_counts

TYPES = ["integral", "fractional", "text"]

# Which movement of a metric is a violation.
LOWER_IS_BAD = [
    "auc", "accuracy", "precision", "recall", "f1", "f0_5", "f2", "true_positive_rate", "true_negative_rate",
]
HIGHER_IS_BAD = ["false_positive_rate"]
PUBLISHED_METRICS = [
    "auc", "accuracy", "precision", "recall", "f1", "f0_5", "f2", "true_positive_rate", "false_positive_rate",
]


def value_type(operand: str) -> Column:
    text = trimmed(operand)
    return F.when(text.rlike(INTEGER_PATTERN), "integral").when(text.rlike(NUMBER_PATTERN), "fractional").otherwise("text")


def column_profile(counts: DataFrame) -> DataFrame:
    """Per column: rows, NULLs, completeness, distinct values and the share of each inferred type."""
    typed = counts.withColumn("_type", F.when(F.col("value").isNotNull(), value_type("value")))
    present = F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
    sums = typed.groupBy("column").agg(
        F.sum("n").alias("n"), present.alias("n_present"), F.count("value").alias("n_distinct"),
        *[F.coalesce(F.sum(F.when(F.col("_type") == t, F.col("n"))), F.lit(0)).alias(f"_{t}") for t in TYPES],
    )
    return sums.select(
        "column", "n", (F.col("n") - F.col("n_present")).alias("n_null"),
        (F.col("n_present") / F.col("n").cast("double")).alias("completeness"), "n_distinct",
        *[F.coalesce(F.try_divide(F.col(f"_{t}").cast("double"), "n_present"), F.lit(0.0)).alias(f"share_{t}")
          for t in TYPES],
    )


def _violations(df: DataFrame, check: str, description: Column) -> DataFrame:
    return df.select(F.col("column").alias("feature"), F.lit(check).alias("constraint_check_type"),
                     description.alias("description"))


def completeness_check(baseline: DataFrame, current: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Columns whose share of present values fell below the baseline."""
    both = compare_profiles(baseline, current, ["column"], "completeness")
    fell = both.where(F.coalesce("current", F.lit(0.0)) < F.col("baseline") - F.lit(tolerance))
    return _violations(fell, "completeness_check", F.format_string(
        "completeness %.6f below baseline %.6f", F.coalesce("current", F.lit(0.0)), F.col("baseline")))


def data_type_check(baseline: DataFrame, current: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Columns in which the baseline's dominant type lost share."""
    shares = [F.col(f"share_{t}") for t in TYPES]
    top = F.greatest(*shares)
    dominant = reduce(lambda chain, t: chain.when(F.col(f"share_{t}") == top, t), TYPES[1:],
                      F.when(F.col(f"share_{TYPES[0]}") == top, TYPES[0]))
    base = baseline.where("n > n_null").select("column", dominant.alias("type"), top.alias("baseline"))
    seen = current.where("n > n_null").unpivot(["column"], [f"share_{t}" for t in TYPES], "_share", "current")
    seen = seen.select("column", F.substring_index("_share", "_", -1).alias("type"), "current")
    fell = base.join(seen, ["column", "type"]).where(F.col("current") < F.col("baseline") - F.lit(tolerance))
    return _violations(fell, "data_type_check", F.format_string(
        "share of %s values %.6f below baseline %.6f", F.col("type"), F.col("current"), F.col("baseline")))


def category_matches(
    baseline_counts: DataFrame, current_counts: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Per column: present rows, rows whose value the baseline knew, unseen values and the match share."""
    known = baseline_counts.where(F.col("value").isNotNull()).select("column", "value", F.lit(1).alias("_known"))
    present = current_counts.where(F.col("value").isNotNull() & F.col("column").isin(list(columns)))
    return present.join(known, ["column", "value"], "left").groupBy("column").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("_known") == 1, F.col("n"))), F.lit(0)).alias("n_known"),
        F.count(F.when(F.col("_known").isNull(), 1)).alias("n_unseen_values"),
    ).withColumn("match_share", F.col("n_known") / F.col("n").cast("double"))


def unseen_categories(baseline_counts: DataFrame, current_counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values themselves: ``column, value, n`` not present in the baseline."""
    known = baseline_counts.where(F.col("value").isNotNull()).select("column", "value")
    present = current_counts.where(F.col("value").isNotNull() & F.col("column").isin(list(columns)))
    return present.join(known, ["column", "value"], "left_anti")


def categorical_values_check(matches: DataFrame, threshold: float = 1.0) -> DataFrame:
    low = matches.where(F.col("match_share") < F.lit(threshold))
    return _violations(low, "categorical_values_check", F.format_string(
        "%.6f of values match the baseline domain", F.col("match_share")))


def data_quality_violations(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], categorical: Sequence[str],
    tolerance: float = 0.0,
) -> DataFrame:
    """Completeness, type and category violations of ``current`` against ``baseline``."""
    return violations_from_counts(value_counts(baseline, columns), value_counts(current, columns), categorical, tolerance)


def violations_from_counts(base_counts: DataFrame, now_counts: DataFrame, categorical: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """The same from two ``column, value, n`` tables."""
    base, now = column_profile(base_counts), column_profile(now_counts)
    return (
        completeness_check(base, now, tolerance)
        .unionByName(data_type_check(base, now, tolerance))
        .unionByName(categorical_values_check(category_matches(base_counts, now_counts, categorical)))
    )


def model_quality_statistics(df: DataFrame, score: str, label: str, threshold: float | Column) -> DataFrame:
    """Long ``(metric, value)`` table at the frozen threshold."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    flagged = df.select(F.col(score), F.col(label), (F.col(score) >= cut).cast("int").alias("_p"))
    wide = classification_metrics(flagged.agg(*confusion_sums(F.col(label), F.col("_p"))))
    auc = ranking_metrics(df, score, label).select("roc_auc").scalar()
    names = [*LOWER_IS_BAD, *HIGHER_IS_BAD]
    return wide.withColumn("auc", auc).select(*names).unpivot([], names, "metric", "value")


def model_quality_violations(baseline: DataFrame, current: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Metrics that moved in their bad direction."""
    both = compare_profiles(baseline, current, ["metric"], "value")
    worse = F.when(F.col("metric").isin(HIGHER_IS_BAD), F.col("current") > F.col("baseline") + F.lit(tolerance))
    worse = worse.otherwise(F.coalesce(F.col("current") < F.col("baseline") - F.lit(tolerance),
                                       F.col("current").isNull() & F.col("baseline").isNotNull()))
    return both.where(worse).select("metric", "current", "baseline")


def violation_counts(violations: DataFrame) -> DataFrame:
    """Violations per check type and in total (``check_type`` NULL); a clean run has a total of zero."""
    n = F.count(F.lit(1)).alias("n")
    by_type = violations.groupBy(F.col("constraint_check_type").alias("check_type")).agg(n)
    total = by_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit(None).cast("string").alias("check_type"), "n")
    return by_type.unionByName(total)


def metric_rows(
    violations: DataFrame | None = None, statistics: DataFrame | None = None, bias: DataFrame | None = None,
    namespace: str = "riskmart/monitoring",
) -> DataFrame:
    """Long metric points ``namespace, name, dimension, value`` ready to append to the metric table."""
    parts = []
    if violations is not None:
        parts.append(violation_counts(violations).select(
            F.lit("DataQualityViolationCount").alias("name"), F.col("check_type").alias("dimension"),
            F.col("n").cast("double").alias("value")))
    if statistics is not None:
        kept = statistics.where(F.col("metric").isin(PUBLISHED_METRICS))
        parts.append(kept.select(F.concat(F.lit("ModelQuality_"), "metric").alias("name"),
                                 F.lit(None).cast("string").alias("dimension"), "value"))
    if bias is not None:
        facet = F.concat_ws("=", "column", "value").alias("dimension")
        wide = bias.select(facet, "disparate_impact", "accuracy_difference", "recall_difference")
        names: Mapping[str, str] = {"disparate_impact": "DisparateImpact", "accuracy_difference": "AccuracyDifference",
                                    "recall_difference": "RecallDifference"}
        renamed = wide.withColumnsRenamed(names)
        parts.append(renamed.unpivot(["dimension"], list(names.values()), "name", "value")
                     .select("name", "dimension", "value"))
    return reduce(DataFrame.unionByName, parts).select(F.lit(namespace).alias("namespace"), "name", "dimension", "value")
