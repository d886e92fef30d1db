"""Event rules and threshold alarms. Every function takes a batch or a streaming frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Alarm period in seconds, alarm threshold in percent, states that raise an alert.
ALARM_PERIOD_SECONDS = 60
ALARM_THRESHOLD = 90.0
FAILURE_STATES = ["Failed", "Stopped"]


@dataclass(frozen=True)
class EventRule:
    """An event matches when every listed field holds one of its allowed values."""

    name: str
    fields: Mapping[str, Sequence]
    details: Mapping[str, Sequence]

    def matches(self, detail: Column) -> Column:
        condition = F.lit(True)
        for column, allowed in self.fields.items():
            condition = condition & F.col(column).isin(list(allowed))
        for key, allowed in self.details.items():
            condition = condition & F.try_element_at(detail, F.lit(key)).isin([str(v) for v in allowed])
        return F.coalesce(condition, F.lit(False))


def job_failure_rules(
    source: str, status_fields: Mapping[str, str], states: Sequence[str] = tuple(FAILURE_STATES),
    source_column: str = "source", type_column: str = "detail_type",
) -> list[EventRule]:
    """One rule per kind of event (its full detail type) whose status field, inside the detail, reaches a failure state."""
    return [
        EventRule(f"job-failure-{field.lower()}", {source_column: [source], type_column: [kind]}, {field: list(states)})
        for kind, field in status_fields.items()
    ]


def route_events(df: DataFrame, rules: Sequence[EventRule], detail: str) -> DataFrame:
    """Events with the name of each rule they match; ``detail`` is a JSON object of scalar fields."""
    parsed = F.from_json(F.col(detail), T.MapType(T.StringType(), T.StringType()))
    hits = F.filter(
        F.array(*[F.when(rule.matches(F.col("_detail")), F.lit(rule.name)) for rule in rules]),
        lambda name: name.isNotNull(),
    )
    return df.withColumn("_detail", parsed).withColumn("rule", F.explode(hits)).drop("_detail")


def threshold_alarms(
    df: DataFrame, time: str, dimension: str, value: str, threshold: float = ALARM_THRESHOLD,
    period_seconds: int = ALARM_PERIOD_SECONDS, watermark: str | None = None,
) -> DataFrame:
    """Tumbling periods whose average exceeds the threshold, per dimension; a period without data never alarms.

    On a stream, ``watermark`` bounds the state and lets periods be emitted once in append mode.
    """
    events = df.select(F.col(time).cast("timestamp").alias("_ts"), dimension, value)
    if watermark:
        events = events.withWatermark("_ts", watermark)
    windows = events.groupBy(F.window("_ts", f"{period_seconds} seconds"), dimension).agg(
        F.avg(value).alias("average"), F.count(value).alias("n"))
    return windows.where(F.col("average") > F.lit(float(threshold))).select(
        F.col("window.start").cast("timestamp_ntz").alias("period_start"), dimension, "average", "n")
