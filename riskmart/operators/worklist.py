"""The ranked scoring output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import flag_at
from .ordering import running_totals, value_ranges


def _best_first(id_column: str) -> list[Column]:
    """Highest score first; NaN and NULL, which have no rank, come last."""
    return [F.nanvl("score", F.lit(None)).desc_nulls_last(), F.col(id_column)]


def worklist(df: DataFrame, id_column: str, score: str, threshold: float | Column) -> DataFrame:
    """``id, score, flag`` with the highest score first, ids breaking ties.

    The sort is range-partitioned over (score, id), so a score shared by many rows still spreads.
    """
    rows = df.select(F.col(id_column), F.col(score).cast("double").alias("score"))
    flagged = rows.withColumn("flag", F.coalesce(flag_at(F.col("score"), threshold), F.lit(0)))
    return flagged.orderBy(*_best_first(id_column))


def ranked_worklist(df: DataFrame, id_column: str, score: str, threshold: float | Column) -> DataFrame:
    """The worklist with ``rank``: one plus the number of rows scored strictly higher."""
    rows = df.select(F.col(score).cast("double").alias("score")).where("score is not null and not isnan(score)")
    levels = rows.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    ahead = running_totals(levels, "score", ["n"], descending=True, cuts=value_ranges(rows, "score"))
    ranks = ahead.select("score", (F.col("n_before") + 1).alias("rank"))
    flagged = df.select(F.col(id_column), F.col(score).cast("double").alias("score"))
    flagged = flagged.withColumn("flag", F.coalesce(flag_at(F.col("score"), threshold), F.lit(0)))
    return flagged.join(ranks, "score", "left").select("rank", id_column, "score", "flag").orderBy(*_best_first(id_column))
