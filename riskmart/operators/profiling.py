"""Exploratory aggregates. Wide frames are profiled in one pass, never one job per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.nulls import name, quoted
from ..functions.numeric import clip_upper
from .ordering import running_totals, value_ranges


def column_values(df: DataFrame, columns: Sequence[str], carry: Sequence[Column] = ()) -> DataFrame:
    """Long form ``(column, value, ...carry)``: one row per cell, values as text, NULL kept."""
    cells = [F.expr(f"CAST({name(c)} AS STRING) AS {name(c)}") for c in columns]
    kept = df.select(*carry, *cells)
    ids = kept.columns[: len(carry)]
    return kept.unpivot(ids, [name(c) for c in columns], "column", "value")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` for all columns; counts are combined before the one shuffle."""
    return column_values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def missing_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percent NULL per column, columns without NULLs left out, largest first."""
    columns = columns or df.columns
    wide = df.agg(*[F.expr(f"avg(CAST({name(c)} IS NULL AS DOUBLE)) AS {name(c)}") for c in columns])
    long = wide.unpivot([], [name(c) for c in columns], "column", "share")
    return long.where("share > 0").select("column", (F.col("share") * 100).alias("pct_null")).orderBy(
        F.col("pct_null").desc(), "column"
    )


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values per column and whether there is exactly one.

    Smallest against largest value decides constancy, so no distinct set is shuffled.
    """
    wide = df.agg(F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.min(quoted(c).cast("string")).alias("low"),
            F.max(quoted(c).cast("string")).alias("high"),
        ) for c in columns
    ]).alias("s"))
    is_constant = F.col("low").isNotNull() & (F.col("low") == F.col("high"))
    return wide.select(F.inline("s")).select("column", is_constant.cast("int").alias("is_constant"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct non-NULL values per column."""
    return value_counts(df, columns).groupBy("column").agg(F.count("value").alias("n_distinct"))


LEVEL_PREFIX = 3  # leading characters by which the levels of a column are cut into sorted pieces


def sorted_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, position, level``: the distinct non-NULL values of every column in text order, counted from 0.

    Levels are sorted in pieces with equal leading characters; the sizes of earlier pieces are added, so a column with
    very many levels is not sorted in one task.
    """
    levels = column_values(df, columns).where("value is not null").select("column", "value").distinct()
    pieced = levels.withColumn("_piece", F.substring("value", 1, LEVEL_PREFIX))
    earlier = Window.partitionBy("column").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieced.groupBy("column", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    offsets = pieces.select("column", "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("column", "_piece").orderBy("value")) - 1
    return pieced.withColumn("_own", inside).join(offsets, ["column", "_piece"]).select(
        "column", (F.col("_before") + F.col("_own")).alias("position"), F.col("value").alias("level"))


def group_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Share in percent of each non-NULL value."""
    counts = group_counts(df.where(F.col(column).isNotNull()), column)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("_total", total).select(
        column, "n", (F.lit(100.0) * F.col("n") / F.col("_total")).alias("pct")
    )


def group_size_histogram(df: DataFrame, entity: str, at_most: int = 15) -> DataFrame:
    """How many entities have 1, 2, ... rows; sizes above ``at_most`` are not shown (the report's axis)."""
    sizes = group_counts(df.where(F.col(entity).isNotNull()), entity).withColumnRenamed("n", "size")
    return sizes.where(F.col("size") <= at_most).groupBy("size").agg(F.count(F.lit(1)).alias("n_entities"))


def class_balance(populations: Mapping[str, DataFrame], target: str) -> DataFrame:
    """Class counts per named population."""
    parts = [group_counts(df, target).select(F.lit(name).alias("population"), target, "n")
             for name, df in populations.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def repeated_entity_share(df: DataFrame, entity: str, target: str) -> DataFrame:
    """Entities with several rows, the positives they hold, and both as shares: one aggregate per entity."""
    per_entity = df.where(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("pos")
    )
    repeated = F.col("n") > 1
    totals = per_entity.agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.count(F.when(repeated, 1)).alias("n_repeated"),
        F.sum("pos").alias("positives"),
        F.coalesce(F.sum(F.when(repeated, F.col("pos"))), F.lit(0)).alias("positives_of_repeated"),
    )
    return totals.select(
        "*",
        F.try_divide(F.col("n_repeated").cast("double"), "n_entities").alias("share_repeated"),
        F.try_divide(F.col("positives_of_repeated").cast("double"), "positives").alias("share_of_positives"),
    )


def rate_by_groups(df: DataFrame, target: str, columns: Sequence[str], min_rows: int = 30) -> DataFrame:
    """Target rate and rows for every value of every column, small groups left out, highest rate first."""
    long = column_values(df, columns, [F.col(target).cast("bigint").alias("y")]).where(F.col("value").isNotNull())
    grouped = long.groupBy("column", "value").agg(F.avg("y").alias("rate"), F.count("y").alias("n"))
    return grouped.where(F.col("n") >= min_rows).orderBy("column", F.col("rate").desc(), "value")


def rate_by_clipped_counter(df: DataFrame, counter: str, target: str, upper: int = 5) -> DataFrame:
    """Target rate per counter value, with everything from ``upper`` on in one group."""
    clipped = clip_upper(name(counter), upper)
    return df.where(F.col(counter).isNotNull()).groupBy(clipped.alias("bucket")).agg(
        F.avg(F.col(target).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n")
    )


def exact_quantiles(
    df: DataFrame, column: str, quantiles: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group: columns ``by..., q, value``.

    Equal values are counted first and the counts summed in order by value range, so memory does not depend on
    the number of distinct values (``percentile`` keeps them all in one buffer).
    """
    by = list(by)
    present = df.select(*by, F.col(column).cast("double").alias("value")).where("value is not null")
    levels = present.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))
    totals = running_totals(levels, "value", ["n"], by, cuts=value_ranges(present, "value"))
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("q")
    position = (F.col("n_total") - 1) * F.col("q")
    holds = lambda p: (p >= F.col("n_before")) & (p < F.col("n_before") + F.col("n"))
    low, high = F.floor(F.col("_at")), F.ceil(F.col("_at"))
    near = totals.select(*by, "value", "n", "n_before", "n_total", wanted).withColumn("_at", position)
    near = near.where(holds(low) | holds(high))
    ends = near.groupBy(*by, "q").agg(
        F.max(F.when(holds(low), F.col("value"))).alias("_low"),
        F.max(F.when(holds(high), F.col("value"))).alias("_high"),
        F.max(F.col("_at") - low).alias("_part"),
    )
    between = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")  # of equal infinities not a number
    return ends.select(*by, "q", F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(between).alias("value"))


def clipped_histogram(df: DataFrame, column: str, q: float = 0.99, bins: int = 30) -> DataFrame:
    """Equal-width histogram of a column clipped at its quantile ``q``; empty bins are listed with zero."""
    upper = exact_quantiles(df, column, [q]).select("value").scalar()
    clipped = df.select(F.col(column).cast("double").alias("x")).where("x is not null").withColumn("_upper", upper)
    clipped = clipped.select(F.least("x", "_upper").alias("x"))
    # Equal values first: edges and bins then come from one small table.
    levels = clipped.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    edges = levels.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("e")).scalar()
    lo, hi = F.col("_edges.lo"), F.col("_edges.hi")
    place = F.floor(F.try_divide((F.col("x") - lo) * F.lit(float(bins)), hi - lo))
    last_closed = F.when(place.isNotNull(), F.least(place, F.lit(bins - 1)))
    bin_id = F.coalesce(last_closed, F.lit(bins // 2))  # middle bin when all values are equal
    counted = levels.withColumn("_edges", edges).groupBy(bin_id.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def numeric_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, NULLs, range, mean and standard deviation per column, in one pass."""
    wide = df.agg(F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.count(quoted(c)).alias("n_present"),
            F.count(F.when(quoted(c).isNull(), 1)).alias("n_null"),
            F.min(quoted(c)).cast("double").alias("min"),
            F.max(quoted(c)).cast("double").alias("max"),
            F.avg(quoted(c)).alias("mean"),
            F.stddev_pop(quoted(c)).alias("std"),
        ) for c in columns
    ]).alias("s"))
    return wide.select(F.inline("s"))

