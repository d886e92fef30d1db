"""Session-catalog tables: all-string CSV tables, partitioned Parquet, append-only feature rows, metric points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.nulls import quoted
from ..session import METHOD_LIMIT, compiled_methods, settings


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def create_csv_table(spark: SparkSession, database: str, table: str, path: str, columns: Sequence[str]) -> None:
    """(Re)register a folder of CSV files as an all-string table; one header line per file is skipped."""
    declared = ", ".join(f"`{c.lower().replace('-', '_')}` STRING" for c in columns)
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    spark.sql(
        f"CREATE TABLE `{database}`.`{table}` ({declared}) USING csv "
        f"OPTIONS (header 'true', sep ',', quote '\"', escape '\\\\', enforceSchema 'true') LOCATION '{path}'"
    )


def create_csv_tables(spark: SparkSession, database: str, tables: Mapping[str, tuple[str, Sequence[str]]]) -> None:
    create_database(spark, database)
    for table, (path, columns) in tables.items():
        create_csv_table(spark, database, table, path, columns)


# A task keeps so many files open, one for each partition it meets; only rows of further partitions are sorted first.
OPEN_FILES = ("spark.sql.maxConcurrentOutputFileWriters", "16")


def write_partitioned(df: DataFrame, table: str, path: str, partition: str = "split", spread: bool = False) -> None:
    """Overwrite a partitioned Parquet table and register it; partitions not written disappear.

    The rebalance hint lets AQE cut a large split over many tasks and merge small ones, so file sizes stay even. Wide rows
    that are ``spread`` evenly over tasks already are written where they are, without that shuffle and without a sort.
    """
    balanced = df if spread else df.hint("rebalance", F.col(partition))
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition)
    with settings(df.sparkSession, METHOD_LIMIT, *([OPEN_FILES] if spread else [])):
        writer.format("parquet").option("path", path).saveAsTable(table)


def read_partition(spark: SparkSession, table: str, value: str, partition: str = "split") -> DataFrame:
    """One partition of a table, the partition column included; other partitions are not read."""
    return spark.table(table).where(F.col(partition) == value)


def append_features(df: DataFrame, table: str, path: str, event_time: float) -> None:
    """Append prepared rows with the system columns, partitioned by event date; one atomic commit per call."""
    written = F.timestamp_micros(F.lit(int(event_time * 1_000_000)))
    stamped = df.select(
        *[quoted(c) for c in df.columns],
        written.alias("write_time"), written.alias("api_invocation_time"), F.lit(False).alias("is_deleted"),
        F.lit(datetime.fromtimestamp(event_time, timezone.utc).date()).alias("event_date"),
    )
    with compiled_methods(df.sparkSession):
        stamped.write.mode("append").partitionBy("event_date").format("parquet").option("path", path).saveAsTable(table)


def check_row_count(spark: SparkSession, table: str, at_least: int) -> int:
    """Rows in the table; fewer than expected is an error. A Spark commit is visible at once, so nothing waits."""
    n = spark.table(table).count()
    if n < at_least:
        raise RuntimeError(f"{table} has {n} rows, expected at least {at_least}")
    return n


def write_dated(df: DataFrame, path: str, as_of: str, key: str = "dt") -> None:
    """CSV below ``<path>/<key>=<as_of>/``; other dates stay."""
    dated = df.withColumn(key, F.lit(as_of))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key)
    writer.option("header", True).csv(path)
