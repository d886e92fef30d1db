"""Global order without a global sort in one task.

Three building blocks serve every ranking operator:

* ``running_totals``: sums of everything ordered before each key. Keys are split into pieces of value ranges, each
  piece is one window partition, and a second window over the totals per piece supplies the offsets.
* ``first_in_hash_order``: the first *n* rows of a group when rows are ordered by a hash of their id. The hash is
  uniform, so its leading digits cut even a huge group of ties into equal pieces.
* ``hash_cutoffs``: the hash values at given positions of that order.

All three are exact and return the same rows for every partitioning of the input.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import group_key, join_groups

# Leading hex digits of the hash used as pieces: 16^4 = 65,536, which also bounds the per-group window over piece
# totals. A group of 10^11 ties leaves about 1.5 million rows in the one piece that is ordered.
PREFIX_DIGITS = 4


def hash_key(id_column: Column, seed: int | str | None = None) -> Column:
    """32 hex digits of md5 over ``seed:id``, or over the id alone."""
    text = id_column.cast("string")
    return F.md5(text if seed is None else F.concat(F.lit(f"{seed}:"), text))


def hash_fraction(key: Column) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of a hash key."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


# Quantile ranges found by the sketch, and equal-width pieces per range: together up to 25,600 pieces, which is also the
# bound of the window over piece totals.
MAX_RANGES = 400
PIECES_PER_RANGE = 64


def value_ranges(df: DataFrame, key: str, ranges: int | None = None) -> list[float]:
    """Range bounds that spread the rows of ``df`` evenly, from a distributed quantile sketch.

    The bounds decide only how the work is spread, never the result.
    """
    ranges = min(ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_RANGES)
    cuts = df.approxQuantile(key, [i / ranges for i in range(1, ranges)], 0.25 / ranges) if ranges > 1 else []
    return sorted({c for c in cuts if math.isfinite(c)})


def _maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _with_range(df: DataFrame, key: str, cuts: Sequence[float]) -> DataFrame:
    """Add ``_range``: the quantile range of the key and the equal-width piece inside it; never falls as keys rise.

    The outer ranges hold the infinities, and NaN, which Spark orders above everything, has a range of its own.
    """
    if not cuts:
        return df.withColumn("_range", F.lit(0))
    splits = [float("-inf"), *cuts, float("inf")]
    coarse = Bucketizer(splits=splits, inputCol=key, outputCol="_coarse", handleInvalid="keep").transform(df)
    index = F.col("_coarse").cast("int")
    bounds = F.array(*[F.lit(c) for c in cuts])
    low, high = F.get(bounds, index - 1), F.get(bounds, index)
    piece = F.floor((F.col(key) - low) / (high - low) * PIECES_PER_RANGE)
    piece = F.when(low.isNull() | high.isNull(), F.lit(0)).otherwise(F.least(piece, F.lit(PIECES_PER_RANGE - 1)))
    return coarse.withColumn("_range", index * PIECES_PER_RANGE + piece.cast("int")).drop("_coarse")


def running_totals(
    levels: DataFrame,
    key: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    cuts: Sequence[float] = (),
) -> DataFrame:
    """Add ``<sum>_before``, the total of ``sum`` over all rows whose key comes earlier within ``by``, and
    ``<sum>_total``, the total of the whole group.

    ``levels`` holds one row per (``by``, ``key``); ``key`` is a double without NULLs.
    """
    # One shuffle by range serves the windows inside the ranges and the totals per range. NULL groups are groups.
    by = list(by)
    columns, keys = levels.columns, by
    if by:
        levels, by = levels.withColumn("_group", group_key(by)).drop(*by), ["_group"]
    ranged = _with_range(levels, key, cuts).repartition(*by, "_range")
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())

    def before(total: str, order: str, within: list[str]) -> Column:
        window = Window.partitionBy(*within).orderBy(direction(order))
        return F.coalesce(F.sum(total).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # One row per piece and group, whatever the data size.
    offsets = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(s) for s in sums])
    group = Window.partitionBy(*by)
    offsets = offsets.select(
        *by, "_range", *[before(s, "_range", by).alias(f"_offset_{s}") for s in sums],
        *[F.sum(s).over(group).alias(f"{s}_total") for s in sums],
    )
    inside = ranged.select("*", *[before(s, key, [*by, "_range"]).alias(f"_inside_{s}") for s in sums])
    return inside.join(offsets, [*by, "_range"]).select(
        *[F.col("_group")[c].alias(c) if c in keys else F.col(c) for c in columns], *[(F.col(f"_inside_{s}") + F.col(f"_offset_{s}")).alias(f"{s}_before") for s in sums],
        *[f"{s}_total" for s in sums],
    )


def _prefix_totals(keyed: DataFrame, by: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Row count per hash prefix and the count in all earlier prefixes of the same group."""
    counts = keyed.groupBy(*by, "_prefix").agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in carry]
    )
    earlier = Window.partitionBy(*by).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))


def _with_prefix(df: DataFrame, id_column: str, seed: int | str | None) -> DataFrame:
    keyed = df.withColumn("_hash", hash_key(F.col(id_column), seed))
    return keyed.withColumn("_prefix", F.substring("_hash", 1, PREFIX_DIGITS))


def first_in_hash_order(
    df: DataFrame, id_column: str, need: str, by: Sequence[str] = (), seed: int | str | None = None
) -> DataFrame:
    """Rows among the first ``need`` of their group, ordered by (hash of id, id).

    ``need`` is a column that is constant within a group.
    """
    by = list(by)
    keyed = _with_prefix(df, id_column, seed)
    reached = _prefix_totals(keyed, by, [need]).where(F.col("_before") < F.col(need)).select(*by, "_prefix", "_before")
    position = F.row_number().over(Window.partitionBy(*by, "_prefix").orderBy("_hash", id_column))
    return (
        join_groups(keyed, _maybe_broadcast(reached, not by), [*by, "_prefix"])  # at most 65,536 rows without groups
        .withColumn("_position", F.col("_before") + position)
        .where(F.col("_position") <= F.col(need))
        .select(*df.columns)
    )


def positives_in_hash_order(
    df: DataFrame, id_column: str, flag: str, need: str, by: Sequence[str], few: bool = False
) -> DataFrame:
    """Sum of ``flag`` over the first ``need`` rows of each group in (hash of id, id) order: ``by..., hits``.

    Prefixes wholly inside the first rows are summed as counts; rows are ordered only inside the one prefix per
    group that is cut. ``few`` says that the number of groups was checked to be small.
    """
    by = list(by)
    keyed = _with_prefix(df, id_column, None)
    pieces = keyed.groupBy(*by, "_prefix").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(flag).alias("_flags"), F.max(need).alias("_need"))
    earlier = Window.partitionBy(*by).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    pieces = pieces.where(F.col("_before") < F.col("_need"))
    inside = F.col("_before") + F.col("_n") <= F.col("_need")
    whole = pieces.where(inside).groupBy(*by).agg(F.sum("_flags").alias("_whole"))
    cut = pieces.where(~inside).select(*by, "_prefix", (F.col("_need") - F.col("_before")).alias("_left"))
    position = F.row_number().over(Window.partitionBy(*by).orderBy("_hash", id_column))
    part = join_groups(keyed, _maybe_broadcast(cut, few), [*by, "_prefix"]).withColumn("_position", position)
    part = part.where(F.col("_position") <= F.col("_left")).groupBy(*by).agg(F.sum(flag).alias("_part"))
    hits = F.coalesce("_whole", F.lit(0)) + F.coalesce("_part", F.lit(0))
    return join_groups(whole, part, by, "full").select(*by, hits.alias("hits"))


def sample_rows(df: DataFrame, n: int, id_column: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), chosen by a seeded hash of the id."""
    return first_in_hash_order(df.withColumn("_need", F.lit(n)), id_column, "_need", seed=seed).select(*df.columns)


def hash_cutoffs(entities: DataFrame, id_column: str, fractions: Sequence[float], seed: int | str) -> DataFrame:
    """One row with an array of hash keys: the key at position ``int(f * n)`` for each fraction of the n entities.

    A position past the end yields NULL. ``entities`` holds distinct ids.
    """
    keyed = _with_prefix(entities.select(id_column), id_column, seed)
    counts = _prefix_totals(keyed, [])
    total = F.coalesce(counts.agg(F.sum("_n").alias("n")).scalar(), F.lit(0))
    wanted = F.array(*[
        F.struct(F.lit(i).alias("cut"), F.floor(F.lit(float(f)) * F.col("_total")).cast("bigint").alias("position"))
        for i, f in enumerate(fractions)
    ])
    inside = lambda w: (w["position"] >= F.col("_before")) & (w["position"] < F.col("_before") + F.col("_n"))
    hit = counts.withColumn("_total", total).select("_prefix", "_before", F.explode(F.filter(wanted, inside)).alias("w"))
    hit = hit.select("_prefix", F.col("w.cut").alias("_cut"), (F.col("w.position") - F.col("_before") + 1).alias("_nth"))
    # One row per cut.
    ranked = keyed.join(F.broadcast(hit), "_prefix").withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_cut").orderBy("_hash", id_column))
    )
    cuts = ranked.where(F.col("_rank") == F.col("_nth")).groupBy("_cut").agg(F.max("_hash").alias("_hash"))
    found = cuts.agg(F.map_from_entries(F.collect_list(F.struct("_cut", "_hash"))).alias("m"))
    return found.select(F.array(*[
        F.try_element_at("m", F.lit(i)) for i in range(len(fractions))
    ]).alias("cutoffs"))
