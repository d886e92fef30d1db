"""Leak-free splits: every row of an entity gets the same split name."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from .ordering import hash_cutoffs, hash_fraction, hash_key


def _checked(splits: Mapping[str, float]) -> tuple[list[str], list[float]]:
    names, fractions = list(splits), [float(v) for v in splits.values()]
    if abs(sum(fractions) - 1.0) >= 1e-9:
        raise ValueError(f"split fractions must sum to 1, got {fractions}")
    return names, list(accumulate(fractions))


def split_by_hash(entity: Column, seed: int, splits: Mapping[str, float]) -> Column:
    """Split name from a seeded hash of the entity: a pure projection, no shuffle, same on every run.

    Fractions hold in expectation. A NULL entity gets no split, so the leakage gate reports it.
    """
    names, bounds = _checked(splits)
    position = hash_fraction(hash_key(entity, seed))
    chosen = F.when(entity.isNull(), F.lit(None).cast("string"))
    for name, bound in zip(names[:-1], bounds[:-1]):
        chosen = chosen.when(position < F.lit(bound), name)
    return chosen.otherwise(names[-1])


def assign_hash_split(df: DataFrame, entity: str, seed: int, splits: Mapping[str, float]) -> DataFrame:
    return df.withColumn("split", split_by_hash(F.col(entity), seed, splits))


def assign_exact_split(df: DataFrame, entity: str, seed: int, splits: Mapping[str, float]) -> DataFrame:
    """Splits holding exactly ``int(cumulative fraction * n)`` entities.

    Entities are ordered by seeded hash; the hash values at the cut positions reach the rows as a scalar
    subquery, so rows are labelled by a projection and never shuffled, however many one entity owns.
    """
    names, bounds = _checked(splits)
    entities = df.select(entity).where(F.col(entity).isNotNull()).distinct()
    cutoffs = hash_cutoffs(entities, entity, bounds[:-1], seed).scalar()
    labelled = df.withColumn("_cutoffs", cutoffs).withColumn("_hash", hash_key(F.col(entity), seed))
    chosen = F.when(F.col(entity).isNull(), F.lit(None).cast("string"))
    for i, name in enumerate(names[:-1]):
        cut = F.col("_cutoffs")[i]
        chosen = chosen.when(cut.isNull() | (F.col("_hash") < cut), name)
    return labelled.withColumn("split", chosen.otherwise(names[-1])).drop("_cutoffs", "_hash")


def modelling_rows(df: DataFrame, holdout: str = "production") -> DataFrame:
    return df.where(F.col("split") != holdout)
