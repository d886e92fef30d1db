"""Ranking metrics with exact tie handling.

Everything starts from one table of score levels: rows and positives per (group, score). A score shared by a third of
all rows is one level, already counted before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import alert_count
from ..session import materialise
from .joins import join_groups
from .ordering import positives_in_hash_order, running_totals, value_ranges

# Cut levels up to this count are broadcast; they are counted first.
FEW_CUTS = 10_000


def score_levels(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., score, n, pos`` with the totals of all higher scores as ``n_before`` and ``pos_before``.

    Rows without a score (NULL, NaN) or without a label take no part, here as in the confusion cells.
    """
    scored = df.select(*by, F.col(score).cast("double").alias("score"), F.col(label).cast("bigint").alias("y"))
    scored = scored.where("score is not null and not isnan(score) and y is not null")
    levels = scored.groupBy(*by, "score").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    return running_totals(levels, "score", ["n", "pos"], by, descending=True, cuts=value_ranges(scored, "score"))


def level_sums() -> list[Column]:
    """Aggregates over the score levels of a group from which ``level_metrics`` computes its ratios."""
    pos, n = F.col("pos").cast("double"), F.col("n").cast("double")
    neg = n - pos
    cum_pos, cum_n = F.col("pos_before") + pos, F.col("n_before") + n
    neg_before = F.col("n_before") - F.col("pos_before")
    # Pairs lost: each positive loses to the negatives scored higher and half-loses to those at its own score.
    lost = pos * (neg_before + F.lit(0.5) * neg)
    score = F.col("score")
    return [
        F.sum("n").alias("_n"), F.sum("pos").alias("_pos"), F.sum(pos * cum_pos / cum_n).alias("_steps"),
        F.sum(lost).alias("_lost"), F.sum(pos * F.pow(score - 1, 2) + neg * F.pow(score, 2)).alias("_squares"),
    ]


def level_metrics() -> list[Column]:
    """Average precision, ROC-AUC, Brier score and base rate from the sums; NULL where a class is absent."""
    p, q = F.col("_pos").cast("double"), (F.col("_n") - F.col("_pos")).cast("double")
    return [
        F.try_divide("_steps", p).alias("pr_auc"),
        (F.lit(1.0) - F.try_divide("_lost", p * q)).alias("roc_auc"),
        (F.col("_squares") / F.col("_n")).alias("brier_score"),
        (p / F.col("_n")).alias("base_rate"),
    ]


def ranking_metrics(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., n, positives, pr_auc, roc_auc, brier_score, base_rate``."""
    sums = score_levels(df, score, label, by).groupBy(*by).agg(*level_sums())
    return sums.select(*by, F.col("_n").alias("n"), F.col("_pos").alias("positives"), *level_metrics())


def cut_levels(fractions: Sequence[float]) -> Column:
    """Aggregate over score levels: per fraction, k and the one level that k falls into."""
    cuts = []
    for fraction in fractions:
        k = alert_count(F.col("n_total"), float(fraction))
        here = (F.col("n_before") < k) & (k <= F.col("n_before") + F.col("n"))
        level = F.struct(F.lit(float(fraction)).alias("fraction"), k.alias("k"), "score", "n", "pos", "pos_before",
                         (k - F.col("n_before")).alias("need"))
        cuts.append(F.max(F.when(here, level)))
    return F.array(*cuts)


def precision_from_cuts(
    cuts: DataFrame, df: DataFrame, score: str, label: str, id_column: str, by: Sequence[str] = ()
) -> DataFrame:
    """``by..., fraction, k, precision`` from the materialised rows of ``cut_levels``, one per group and fraction.

    Whole levels are already counted. Only a level that k cuts through is looked at row by row: its rows are
    counted by hash prefix, and only the prefix that holds the last needed row is ordered.
    """
    by, keys = list(by), [*by, "fraction"]
    ratio = lambda hits: (hits / F.col("k").cast("double")).alias("precision")
    through = cuts.where(F.col("need") < F.col("n")).select(*keys, "score", "need")
    n_cuts = through.count()
    if n_cuts == 0:
        return cuts.select(*keys, "k", ratio(F.col("pos_before") + F.col("pos")))
    few = n_cuts <= FEW_CUTS
    rows = df.select(
        *by, F.col(score).cast("double").alias("score"), F.col(label).cast("bigint").alias("y"),
        F.col(id_column).alias("_id"),
    ).where("y is not null")
    # Few cuts are broadcast, so the scored table is filtered in place; many are shuffled and AQE splits hot scores.
    ties = join_groups(rows, F.broadcast(through) if few else through, [*by, "score"])
    hits = positives_in_hash_order(ties, "_id", "y", "need", keys, few)
    taken = F.col("pos_before") + F.coalesce("hits", "pos")
    return join_groups(cuts, hits, keys, "left").select(*keys, "k", ratio(taken))


def precision_at(
    df: DataFrame, score: str, label: str, id_column: str, fractions: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Precision among the top ``fraction`` of rows by score; ties are ordered by a hash of the id."""
    levels = score_levels(df, score, label, by)
    cuts = levels.groupBy(*by).agg(cut_levels(fractions).alias("c")).select(*by, F.inline("c"))
    cuts = materialise(cuts.where("k is not null"), "cuts")
    return precision_from_cuts(cuts, df, score, label, id_column, by)


def top_rows(df: DataFrame, score: str, id_column: str, n: int) -> DataFrame:
    """The ``n`` highest-scored rows of a report."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(id_column)).limit(n)
