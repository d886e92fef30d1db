"""Data-quality, model-quality and publication jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import flag_at
from ..functions.nulls import quoted
from ..operators.cleaning import feature_names
from ..operators.modeling import Bundle
from ..operators.monitoring import (
    data_quality_violations, metric_rows, model_quality_statistics, model_quality_violations,
)
from ..session import materialise


def feature_input(df: DataFrame) -> DataFrame:
    """What the data-quality monitor sees: the feature columns alone."""
    return df.select(*[quoted(c) for c in feature_names(df.columns)])


def scored_input(df: DataFrame, score: str, label: str, threshold: float | Column) -> DataFrame:
    """What the model-quality monitor sees: probability, 0/1 prediction and label."""
    return df.select(F.col(score).alias("probability"), flag_at(F.col(score), threshold).alias("prediction"), label)


def bias_input(df: DataFrame, facets: Sequence[str], label: str, score: str, threshold: float | Column) -> DataFrame:
    """What the bias monitor sees: the facets, the label and the 0/1 prediction."""
    return df.select(*[quoted(c) for c in facets], label, flag_at(F.col(score), threshold).alias("prediction"))


def data_quality_job(
    train: DataFrame, production: DataFrame, columns: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """Violations of production against constraints learned on train, over the same columns."""
    return data_quality_violations(train, production, columns, categorical)


def model_quality_job(
    bundle: Bundle, validation: DataFrame, production: DataFrame, id_column: str, target: str
) -> dict[str, DataFrame]:
    """Statistics of both splits through the frozen bundle, and what got worse.

    Every table reads the scores several times, so each split is scored and written once.
    """
    cut = bundle.threshold["threshold"]
    base, now = (
        materialise(model_quality_statistics(materialise(
            bundle.score(df, id_column, [target]).select("probability", target), name), "probability", target, cut), f"{name}-statistics")
        for name, df in (("baseline", validation), ("current", production))
    )
    return {"baseline": base, "current": now, "violations": model_quality_violations(base, now)}


def publish_metrics(points: DataFrame, table: str, path: str, ts: float) -> None:
    """Append metric points to the long metric table."""
    stamped = points.select(F.timestamp_micros(F.lit(int(ts * 1_000_000))).alias("ts"), "*")
    stamped.write.mode("append").format("parquet").option("path", path).saveAsTable(table)


def monitoring_points(
    violations: DataFrame | None = None, statistics: DataFrame | None = None, bias: DataFrame | None = None
) -> DataFrame:
    return metric_rows(violations, statistics, bias)
