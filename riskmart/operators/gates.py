"""Quality gates: rows ``(check, subject, observed, bound, passed)``, and one function that raises on failures."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .decoding import score_skew
from .splitting import modelling_rows

# Class floor, proportion tolerance, prevalence tolerance.
CLASS_FLOOR = 10_000
PROPORTION_TOLERANCE = 0.02
PREVALENCE_TOLERANCE = 0.02


class GateFailure(AssertionError):
    """At least one gate row did not pass."""


def _gate(check: str, subject: Column, observed: Column, bound: Column, passed: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"), subject.cast("string").alias("subject"), observed.cast("double").alias("observed"),
        bound.cast("double").alias("bound"), F.coalesce(passed, F.lit(False)).alias("passed"),
    ]


def expected_rows(df: DataFrame, expected: Mapping[str, float], key: str, value: str) -> DataFrame:
    """A literal table of expectations, one row per mapping entry."""
    rows = F.array(*[F.struct(F.lit(k).alias(key), F.lit(float(v)).alias(value)) for k, v in expected.items()])
    return df.sparkSession.range(1).select(F.inline(rows))


def leaking_entities(df: DataFrame, entity: str) -> DataFrame:
    """Entities not in exactly one split (an entity without any split counts as leaking)."""
    pairs = df.groupBy(entity, "split").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(entity).agg(F.count("split").alias("n_splits")).where("n_splits <> 1")


def leakage_gate(df: DataFrame, entity: str) -> DataFrame:
    leaks = leaking_entities(df, entity).agg(F.count(F.lit(1)).alias("n"))
    return leaks.select(*_gate("no_entity_leakage", F.lit(entity), F.col("n"), F.lit(0), F.col("n") == 0))


def split_counts(df: DataFrame, target: str, splits: Mapping[str, float]) -> DataFrame:
    """Rows, positives, share and prevalence per configured split; an empty split has zero rows."""
    counts = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("pos"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    wanted = expected_rows(df, splits, "split", "target")
    joined = wanted.join(counts, "split", "left").withColumn("_total", total)
    n = F.coalesce("n", F.lit(0))
    return joined.select(
        "split", "target", n.alias("n"), F.coalesce("pos", F.lit(0)).alias("positives"),
        F.coalesce(F.try_divide(n.cast("double"), "_total"), F.lit(0.0)).alias("share"),
        F.try_divide(F.col("pos").cast("double"), "n").alias("prevalence"),
    )


def proportion_gate(
    df: DataFrame, target: str, splits: Mapping[str, float], tolerance: float = PROPORTION_TOLERANCE,
    counts: DataFrame | None = None,
) -> DataFrame:
    counts = split_counts(df, target, splits) if counts is None else counts
    off = F.abs(F.col("share") - F.col("target"))
    return counts.select(*_gate("split_proportion", F.col("split"), off, F.lit(tolerance), off < tolerance))


def class_floor_gate(df: DataFrame, target: str, floor: int = CLASS_FLOOR) -> DataFrame:
    """Both classes of the full data reach the floor."""
    sums = df.agg(F.coalesce(F.sum(F.col(target).cast("bigint")), F.lit(0)).alias("positive"),
                  F.count(F.lit(1)).alias("n"))
    both = sums.select("positive", (F.col("n") - F.col("positive")).alias("negative"))
    long = both.unpivot([], ["positive", "negative"], "class", "n")
    return long.select(*_gate("class_floor", F.col("class"), F.col("n"), F.lit(floor), F.col("n") >= floor))


def prevalence_gate(
    df: DataFrame, target: str, splits: Mapping[str, float], tolerance: float = PREVALENCE_TOLERANCE,
    counts: DataFrame | None = None,
) -> DataFrame:
    counts = split_counts(df, target, splits) if counts is None else counts
    spread = counts.agg((F.max("prevalence") - F.min("prevalence")).alias("spread"))
    return spread.select(
        *_gate("prevalence_spread", F.lit(target), F.col("spread"), F.lit(tolerance), F.col("spread") < tolerance)
    )


def modelling_statistics(df: DataFrame, target: str, floor: int = CLASS_FLOOR) -> DataFrame:
    """Size and classes of everything but the production holdout; reported, not gated."""
    sums = modelling_rows(df).agg(F.count(F.lit(1)).alias("n"),
                                  F.coalesce(F.sum(F.col(target).cast("bigint")), F.lit(0)).alias("positives"))
    return sums.select(
        "n", "positives", (F.col("n") - F.col("positives")).alias("negatives"),
        (F.col("positives") < floor).cast("int").alias("below_floor"),
    )


def split_gates(
    df: DataFrame, entity: str, target: str, splits: Mapping[str, float], floor: int = CLASS_FLOOR,
    proportion_tolerance: float = PROPORTION_TOLERANCE, prevalence_tolerance: float = PREVALENCE_TOLERANCE,
) -> DataFrame:
    """All gates of a split frame in one table."""
    counts = split_counts(df, target, splits)
    parts = [
        leakage_gate(df, entity), proportion_gate(df, target, splits, proportion_tolerance, counts),
        class_floor_gate(df, target, floor), prevalence_gate(df, target, splits, prevalence_tolerance, counts),
    ]
    return reduce(DataFrame.unionByName, parts)


def count_gate(observed: DataFrame, expected: Mapping[str, float], check: str = "expected_count") -> DataFrame:
    """Named observed values (``subject, observed``) against exact expectations; a missing one fails."""
    wanted = expected_rows(observed, expected, "subject", "bound")
    joined = wanted.join(observed.select("subject", F.col("observed")), "subject", "left")
    return joined.select(*_gate(check, F.col("subject"), F.col("observed"), F.col("bound"),
                                F.col("observed") == F.col("bound")))


def distribution_gate(shares: DataFrame, expected: Mapping[str, float], tolerance: float = 1.0) -> DataFrame:
    """Group shares (``value, pct``) within ``tolerance`` points of the expected ones; a missing group is 0 %."""
    wanted = expected_rows(shares, expected, "value", "expected_pct")
    gap = F.abs(F.coalesce("pct", F.lit(0.0)) - F.col("expected_pct"))
    joined = wanted.join(shares.select("value", "pct"), "value", "left")
    return joined.select(*_gate("group_share", F.col("value"), gap, F.lit(tolerance), gap <= tolerance))


def metric_gate(metrics: DataFrame, metric: str, minimum: float) -> DataFrame:
    """One metric of a one-row table reaches its minimum."""
    return metrics.select(*_gate("metric_floor", F.lit(metric), F.col(metric), F.lit(minimum), F.col(metric) >= minimum))


def scores_in_range(df: DataFrame, score: str) -> Column:
    """Aggregate: every score lies in [0, 1]; NULL and NaN do not."""
    return F.coalesce(F.bool_and(F.coalesce(F.col(score).between(0, 1), F.lit(False))), F.lit(False))


def scoring_smoke_test(inputs: DataFrame, scored: DataFrame, rescored: DataFrame, key: str, score: str) -> DataFrame:
    """Row counts agree, scores lie in [0, 1] and a second scoring gives the same values, for all rows."""
    n_in = inputs.agg(F.count(F.lit(1)).alias("n")).scalar()
    output = scored.agg(F.count(F.lit(1)).alias("n_out"), scores_in_range(scored, score).alias("scores_in_range"))
    skew = score_skew(scored, rescored, key, score).select("no_skew").scalar()
    checks = output.withColumn("n_in", n_in).withColumn("no_skew", skew)
    same = F.col("n_in") == F.col("n_out")
    return checks.select(
        "n_in", "n_out", same.alias("row_count_matches"), "scores_in_range", "no_skew",
        (same & F.col("scores_in_range") & F.col("no_skew")).alias("passed"),
    )


def enforce(gates: DataFrame) -> DataFrame:
    """Run the gates and raise when a row failed; returns the gate rows."""
    failed = [r.asDict() for r in gates.where(~F.col("passed")).collect()]
    if failed:
        raise GateFailure("; ".join(
            f"{r['check']}[{r['subject']}]: {r['observed']} against {r['bound']}" for r in failed
        ))
    return gates
