"""Scoring of rows as they land, into the dated worklist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def write_scored_batch(scored: DataFrame, path: str, as_of: str, batch_id: int) -> None:
    """One batch below ``<path>/dt=<as_of>/batch=<id>/``; writing a batch again replaces it and nothing else."""
    dated = scored.withColumns({"dt": F.lit(as_of), "batch": F.lit(batch_id)})
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "batch").parquet(path)


def score_stream(
    landing: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, as_of: str, checkpoint: str
) -> StreamingQuery:
    """Score every batch of a landing stream through a frozen chain and write it to the worklist of ``as_of``.

    ``score`` maps rows to worklist rows (a bundle's ``score``, for one). A batch that is run again after a failure has the
    same id and so replaces itself: no row is lost or doubled. Runs until all that has landed is scored.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_scored_batch(score(batch), path, as_of, batch_id)

    return landing.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_worklist(spark, path: str, as_of: str) -> DataFrame:
    """All batches of one date; other dates are not read."""
    return spark.read.parquet(path).where(F.col("dt") == as_of).drop("dt", "batch")
