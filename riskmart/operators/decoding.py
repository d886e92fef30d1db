"""Joins that decode, filter or compare. No broadcast hints: Catalyst and AQE decide on measured sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def last_per_key(dimension: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """One row per key; the last duplicate by ``order`` wins.

    Without an order there is no last one: keys must then be unique (equal duplicates are), or the job fails.
    """
    if order:
        chosen = F.max_by(F.struct(value), F.col(order))[value]
    else:
        several = ~F.min(value).eqNullSafe(F.max(value)) | ((F.count(value) > 0) & (F.count(value) < F.count(F.lit(1))))
        message = F.concat(F.lit(f"{key} has several values of {value} and no order: "), F.max(F.col(key).cast("string")))
        chosen = F.when(several, F.raise_error(message)).otherwise(F.max(value))
    return dimension.where(F.col(key).isNotNull()).groupBy(key).agg(chosen.alias(value))


def decode(
    df: DataFrame, column: str, dimension: DataFrame, key: str, value: str, output: str, order: str | None = None
) -> DataFrame:
    """Look ``column`` up as text and keep every row exactly once; a miss is NULL."""
    lookup = last_per_key(dimension, key, value, order).select(
        F.col(key).cast("string").alias("_key"), F.col(value).alias(output)
    )
    return df.join(lookup, F.col(column).cast("string") == F.col("_key"), "left").drop("_key")


def decode_all_matches(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Plain left join on an equally named key; duplicate keys fan out."""
    return df.join(dimension, key, "left")


def rows_of_repeated(df: DataFrame, entity: str) -> DataFrame:
    """Rows whose entity occurs more than once."""
    repeated = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(entity)
    return df.join(repeated, entity, "left_semi")


def score_skew(left: DataFrame, right: DataFrame, key: str, score: str, tolerance: float = 1e-4) -> DataFrame:
    """Compare two scorings of the same ids: largest difference, and ids present on one side only."""
    a = left.select(F.col(key), F.col(score).alias("_a"), F.lit(1).alias("_in_a"))
    b = right.select(F.col(key), F.col(score).alias("_b"), F.lit(1).alias("_in_b"))
    both = a.join(b, key, "full")
    gap = F.abs(F.col("_a") - F.col("_b"))
    return both.agg(
        F.count(F.when(F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull(), 1)).alias("n_matched"),
        F.count(F.when(F.col("_in_b").isNull(), 1)).alias("n_only_left"),
        F.count(F.when(F.col("_in_a").isNull(), 1)).alias("n_only_right"),
        F.max(gap).alias("max_difference"),
        F.coalesce(F.bool_and(F.coalesce(gap < tolerance, F.lit(False))), F.lit(False)).alias("no_skew"),
    )


def compare_profiles(baseline: DataFrame, current: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Two long metric tables side by side, matched by name; a metric missing on one side stays as NULL."""
    keys = list(keys)
    return baseline.select(*keys, F.col(value).alias("baseline")).join(
        current.select(*keys, F.col(value).alias("current")), keys, "full"
    )
