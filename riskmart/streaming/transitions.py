"""Alarm states per dimension: one row when a dimension goes into alarm and one when it is well again.

A period is in alarm if the average of its values exceeds the threshold; a period without data is not. The stream keeps,
per dimension, the sums of the periods that may still change and the last state, and settles a period once the watermark
has passed its end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .alerts import ALARM_PERIOD_SECONDS, ALARM_THRESHOLD

ALARM, OK = "ALARM", "OK"


def _period(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(time.cast("timestamp")) / (seconds * 1_000_000)).cast("bigint")


def _start(period: Column, seconds: int) -> Column:
    return F.timestamp_micros(period * seconds * 1_000_000).cast("timestamp_ntz")


def alarm_transitions(
    df: DataFrame, time: str, dimension: str, value: str, event_id: str, threshold: float = ALARM_THRESHOLD,
    period_seconds: int = ALARM_PERIOD_SECONDS, until: Column | None = None,
) -> DataFrame:
    """``period_start, dimension, state`` of every change, from a batch; repeated events count once.

    Only periods that end by ``until`` (all, if it is not given) are settled. Sums are made before any window, which then
    reads the breaching periods alone.
    """
    events = df.select(F.col(event_id), _period(F.col(time), period_seconds).alias("p"), dimension, value).dropDuplicates([event_id])
    periods = events.groupBy("p", dimension).agg(F.avg(value).alias("average"))
    last = None if until is None else F.floor(F.unix_micros(until.cast("timestamp")) / (period_seconds * 1_000_000)).cast("bigint")

    def settled(period: Column) -> Column:
        return F.lit(True) if last is None else period + 1 <= last

    breaching = periods.where((F.col("average") > F.lit(float(threshold))) & settled(F.col("p"))).select("p", dimension)
    order = Window.partitionBy(dimension).orderBy("p")
    edges = breaching.select("p", dimension, F.lag("p").over(order).alias("before"), F.lead("p").over(order).alias("after"))
    begins = edges.where(F.col("before").isNull() | (F.col("before") < F.col("p") - 1)).select("p", dimension, F.lit(ALARM).alias("state"))
    ends = edges.where((F.col("after").isNull() | (F.col("after") > F.col("p") + 1)) & settled(F.col("p") + 1))
    changes = begins.unionByName(ends.select((F.col("p") + 1).alias("p"), dimension, F.lit(OK).alias("state")))
    return changes.select(_start(F.col("p"), period_seconds).alias("period_start"), dimension, "state")


def streamed_transitions(
    stream: DataFrame, time: str, dimension: str, value: str, event_id: str, delay: str, threshold: float = ALARM_THRESHOLD,
    period_seconds: int = ALARM_PERIOD_SECONDS,
) -> DataFrame:
    """The same changes from a stream, each once, as the watermark (``delay`` behind the newest event) passes.

    Later events are dropped and repeated ones within the delay count once, so the result is the batch's up to the
    watermark. State per dimension: the sums of open periods and the last settled state.
    """
    kind = stream.schema[dimension].dataType.simpleString()
    length = period_seconds * 1000

    def settle(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        alarmed, previous, saved = state.get if state.exists else (False, 0, "{}")
        open_periods = {int(p): v for p, v in json.loads(saved).items()}
        passed = state.getCurrentWatermarkMs() // length  # periods below this one are over
        for frame in frames:
            for p, total, n in frame.groupby("p")["v"].agg(["sum", "count"]).itertuples():
                if p >= passed and n:
                    own = open_periods.setdefault(int(p), [0.0, 0])
                    own[0] += float(total)
                    own[1] += int(n)
        changes: list[tuple[int, str]] = []
        for p in sorted(p for p in open_periods if p < passed):
            total, n = open_periods.pop(p)
            if alarmed and p > previous + 1:
                changes.append((previous + 1, OK))
                alarmed = False
            if (total / n > threshold) != alarmed:
                alarmed = not alarmed
                changes.append((p, ALARM if alarmed else OK))
            previous = p
        if alarmed and previous + 1 < passed:
            changes.append((previous + 1, OK))
            alarmed = False
        waiting = [*open_periods, *([previous + 1] if alarmed else [])]
        if waiting:
            state.update((alarmed, previous, json.dumps(open_periods)))
            state.setTimeoutTimestamp(max((min(waiting) + 1) * length, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"p": [p for p, _ in changes], "dimension": [key[0]] * len(changes), "state": [s for _, s in changes]})

    events = stream.select(F.col(time).cast("timestamp").alias("ts"), F.col(dimension).alias("dimension"), F.col(value).cast("double").alias("v"), F.col(event_id).alias("id"))
    events = events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id"]).withColumn("p", _period(F.col("ts"), period_seconds))
    changes = events.groupBy("dimension").applyInPandasWithState(
        settle, f"p bigint, dimension {kind}, state string", "alarmed boolean, previous bigint, open string", "append", GroupStateTimeout.EventTimeTimeout
    )
    return changes.select(_start(F.col("p"), period_seconds).alias("period_start"), F.col("dimension").alias(dimension), "state")
