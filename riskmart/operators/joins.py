"""Joins on group columns in which NULL is a group like any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def group_key(columns: Sequence[str]) -> Column:
    """One key for several columns. A struct is never NULL, and structs with NULL in the same fields are equal."""
    return F.struct(*columns)


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named columns, NULL matching NULL; the columns of ``by`` come first, once."""
    by = list(by)
    a = left.select(group_key(by).alias("_group"), *[c for c in left.columns if c not in by])
    b = right.select(group_key(by).alias("_group"), *[c for c in right.columns if c not in by])
    joined = a.join(b, "_group", how)
    return joined.select(*[F.col("_group")[c].alias(c) for c in by], *[c for c in joined.columns if c != "_group"])
