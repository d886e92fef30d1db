"""Column expressions on model scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def platt(score: Column, a: float | Column, b: float | Column) -> Column:
    """Calibrated probability ``1 / (1 + exp(-(a * score + b)))``."""
    one, slope, offset = F.lit(1.0), _as_column(a), _as_column(b)
    return one / (one + F.exp(-(slope * score + offset)))


def flag_at(score: Column, threshold: float | Column) -> Column:
    """1 when the score reaches the threshold (inclusive)."""
    return (score >= _as_column(threshold)).cast("int")


def alert_count(n: Column, fraction: float | Column) -> Column:
    """Rows in the top ``fraction``: at least one, rounded up, multiplied as doubles."""
    return F.greatest(F.lit(1).cast("bigint"), F.ceil(n.cast("double") * _as_column(fraction)).cast("bigint"))


def fixed_decimals(c: Column, places: int = 6) -> Column:
    return F.format_string(f"%.{places}f", c)


def _as_column(value: float | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))
