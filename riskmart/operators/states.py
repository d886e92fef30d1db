"""Monitoring states per day: what a profile or a check needs, stored once and merged without reading the rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.nulls import quoted
from .monitoring import violations_from_counts
from .profiling import value_counts

COUNTS = "`column` string, value string, n bigint, day string"
MOMENTS = "`column` string, n bigint, n_null bigint, mean double, m2 double, min double, max double, day string"


def save_day(df: DataFrame, day: str, path: str, columns: Sequence[str], numeric: Sequence[str] = ()) -> None:
    """Write the states of one day's rows; writing a day again replaces it and no other.

    Two tables, partitioned by day: counts per (column, value), NULL a value like any other, and for numeric columns count,
    mean, squared deviations, least and largest value. Both are reduced before any shuffle.
    """
    def write(state: DataFrame, name: str) -> None:
        dated = state.withColumn("day", F.lit(day))
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{path}/{name}")

    write(value_counts(df, columns), "counts")
    if numeric:
        long = df.select(*[quoted(c).cast("double").alias(c) for c in numeric]).unpivot([], [quoted(c) for c in numeric], "column", "v")
        moments = long.groupBy("column").agg(
            F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("n_null"), F.avg("v").alias("mean"),
            (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("min"), F.max("v").alias("max"))
        write(moments, "moments")


def _days(spark: SparkSession, path: str, schema: str, days: Sequence[str] | None) -> DataFrame:
    states = spark.read.schema(schema).parquet(path)
    return states if days is None else states.where(F.col("day").isin(list(days)))


def merged_counts(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """``column, value, n`` over the given days (all, if none are), as ``value_counts`` of their rows would give."""
    return _days(spark, f"{path}/counts", COUNTS, days).groupBy("column", "value").agg(F.sum("n").alias("n"))


def merged_statistics(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """``column, n_present, n_null, min, max, mean, std`` over the given days; deviations are merged around the common mean."""
    states = _days(spark, f"{path}/moments", MOMENTS, days)
    whole = Window.partitionBy("column")  # a row a day
    common = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(whole), F.sum("n").over(whole))
    around = states.withColumn("_common", common).withColumn("_m2", F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_common"), 2))
    return around.groupBy("column").agg(
        F.sum("n").alias("n_present"), F.sum("n_null").alias("n_null"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.max("_common").alias("mean"), F.sqrt(F.try_divide(F.sum("_m2"), F.sum("n"))).alias("std"))


def violations_from_states(
    spark: SparkSession, baseline: str, current: str, categorical: Sequence[str], baseline_days: Sequence[str] | None = None,
    current_days: Sequence[str] | None = None, tolerance: float = 0.0,
) -> DataFrame:
    """The data-quality checks of one set of days against another, from their states alone."""
    return violations_from_counts(
        merged_counts(spark, baseline, baseline_days), merged_counts(spark, current, current_days), categorical, tolerance)
