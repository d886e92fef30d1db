"""Category levels as a table: fitted, saved and applied without bringing a label to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.nulls import quoted
from ..session import materialise

# Levels of a column up to this count are broadcast; they are counted first.
FEW_LEVELS = 100_000


def fit_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, level``: the distinct non-null values of each text column, numbered from 0 in alphabetical order.

    Values are counted before the shuffle, so a value held by a third of all rows is one row. They are sorted by range;
    a range is numbered on its own and a window over the sizes of the ranges gives the offsets, so a column may have
    millions of levels.
    """
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], "`column` string, value string, level bigint")
    long = df.select(*[quoted(c).cast("string").alias(c) for c in columns]).unpivot([], [quoted(c) for c in columns], "column", "value")
    values = long.where("value IS NOT NULL").distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = materialise(values.repartitionByRange(parts, "column", "value").withColumn("_piece", F.spark_partition_id()), "levels")
    before = Window.partitionBy("column").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy("column", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")  # a row per range and column
    inside = F.row_number().over(Window.partitionBy("column", "_piece").orderBy("value"))
    numbered = pieces.withColumn("_inside", inside).join(offsets, ["column", "_piece"])
    return materialise(numbered.select("column", "value", (F.col("_before") + F.col("_inside") - 1).alias("level")), "dictionary")


def level_counts(dictionary: DataFrame) -> dict[str, int]:
    """Number of levels of each column."""
    return {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}


def encode_levels(df: DataFrame, dictionary: DataFrame, outputs: dict[str, str]) -> DataFrame:
    """``df`` with the level of each column in ``outputs`` under its new name; NULL for NULL and unseen values.

    One left join a column: by broadcast where the levels are few, else by shuffle, where a frequent value is split by the
    skew-join rule.
    """
    counts = level_counts(dictionary)
    for column, output in outputs.items():
        levels = dictionary.where(F.col("column") == column).select(F.col("value").alias(f"_{output}_value"), F.col("level").alias(output))
        if counts.get(column, 0) <= FEW_LEVELS:
            levels = F.broadcast(levels)
        df = df.join(levels, quoted(column).cast("string") == F.col(f"_{output}_value"), "left").drop(f"_{output}_value")
    return df


def save_dictionary(dictionary: DataFrame, path: str) -> None:
    dictionary.write.mode("overwrite").partitionBy("column").parquet(path)


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, level bigint, `column` string").parquet(path).select("column", "value", "level")
