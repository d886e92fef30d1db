"""Reads of the append-only feature table as of a time, and point-in-time joins with it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.nulls import quoted

SYSTEM_COLUMNS = ["write_time", "api_invocation_time", "is_deleted", "event_date"]


def delete_features(spark: SparkSession, keys: DataFrame, table: str, path: str, key: str, event_time: float) -> None:
    """Append a deletion record for each key; the records before stay and are seen by reads as of an earlier time."""
    schema = spark.table(table).schema
    written = F.timestamp_micros(F.lit(int(event_time * 1_000_000)))
    fixed = {
        key: F.col(key), "event_time": F.lit(event_time), "write_time": written, "api_invocation_time": written,
        "is_deleted": F.lit(True), "event_date": F.lit(datetime.fromtimestamp(event_time, timezone.utc).date()),
    }
    rows = keys.select(*[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    rows.write.mode("append").partitionBy("event_date").format("parquet").option("path", path).saveAsTable(table)


def features_as_of(spark: SparkSession, table: str, key: str, as_of: float) -> DataFrame:
    """The latest record of every key with ``event_time`` up to ``as_of``; keys whose latest record is a deletion are left out.

    Dates after ``as_of`` are not read. Records are reduced before the shuffle, so a key with very many records is one row
    a task. Of records with one event time the one written last counts, then the one that is no deletion.
    """
    day = datetime.fromtimestamp(as_of, timezone.utc).date()
    rows = spark.table(table).where((F.col("event_date") <= F.lit(day)) & (F.col("event_time") <= F.lit(as_of)))
    columns = [c for c in rows.columns if c not in SYSTEM_COLUMNS]
    order = F.struct("event_time", "write_time", (~F.col("is_deleted")).alias("stays"))
    latest = rows.groupBy(quoted(key)).agg(F.max_by(F.struct(*[quoted(c) for c in columns], "is_deleted"), order).alias("_r"))
    return latest.where("NOT _r.is_deleted").select(*[F.col("_r")[c].alias(c) for c in columns])


def join_as_of(
    left: DataFrame, right: DataFrame, key: str, time: str, right_time: str, values: Sequence[str], deleted: str | None = None,
    day_seconds: int = 86_400,
) -> DataFrame:
    """``left`` with the ``values`` of the latest row of ``right`` of the same key at or before its time; NULL without one.

    Both sides are bucketed by key and day. Within a bucket the latest row is carried to the rows after it; between buckets
    only the last row of each travels, so a key with a large share of the rows is spread over its days. A latest row that
    is ``deleted`` gives NULL. Times are compared in seconds since the epoch; rows of ``left`` without key or time find none.
    """
    def seconds(df: DataFrame, column: str):
        kind = df.schema[column].dataType.simpleString()
        return F.col(column).cast("double") if kind in ("double", "float", "bigint", "int") else F.unix_micros(F.col(column).cast("timestamp")) / 1e6

    gone = F.col(deleted) if deleted else F.lit(False)
    record = F.struct(*[quoted(v) for v in values], gone.alias("_gone"))
    probes = left.select(F.col(key).alias("_k"), seconds(left, time).alias("_t"), F.struct(*[quoted(c) for c in left.columns]).alias("_l"))
    records = right.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), seconds(right, right_time).alias("_t"), record.alias("_r"))
    both = probes.unionByName(records, allowMissingColumns=True).withColumn("_d", F.floor(F.col("_t") / day_seconds))
    inside = Window.partitionBy("_k", "_d").orderBy("_t", F.col("_l").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("_own", F.last("_r", ignorenulls=True).over(inside))
    lasts = records.withColumn("_d", F.floor(F.col("_t") / day_seconds)).groupBy("_k", "_d").agg(F.max_by("_r", "_t").alias("_last"))
    days = both.select("_k", "_d").distinct().join(lasts, ["_k", "_d"], "left")
    earlier = Window.partitionBy("_k").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)  # a row a day
    days = days.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier)).select("_k", "_d", "_before")
    found = carried.where("_l IS NOT NULL").join(days, ["_k", "_d"], "left")
    hit = F.coalesce("_own", "_before")
    names = [c for c in left.columns if c not in values]
    return found.select(*[F.col("_l")[c].alias(c) for c in names], *[F.when(~hit["_gone"], hit[v]).alias(v) for v in values])
