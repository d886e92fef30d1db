"""Row-wise counts, indicators and recodes with explicit null rules. Operands are SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .nulls import text, texts


def _add_up(conditions: Sequence[str]) -> Column:
    return F.expr(" + ".join(f"CAST({c} AS INT)" for c in conditions) or "0")


def count_in(operands: Sequence[str], values: Sequence[str]) -> Column:
    """How many of the operands hold one of ``values``; NULL counts zero."""
    return _add_up([f"coalesce({o} IN ({texts(values)}), false)" for o in operands])


def count_not_equal(operands: Sequence[str], value: str) -> Column:
    """How many of the operands differ from ``value``; NULL differs."""
    return _add_up([f"(NOT {o} <=> {text(value)})" for o in operands])


def presence_flag(operand: str) -> Column:
    return F.expr(f"CAST({operand} IS NOT NULL AS INT)")


def absence_flag(operand: str) -> Column:
    return F.expr(f"CAST({operand} IS NULL AS INT)")


def or_else(operand: str, sentinel: str) -> Column:
    return F.expr(f"coalesce({operand}, {text(sentinel)})")


def recode(operand: str, values: Sequence[str], to: str) -> Column:
    """``to`` for NULL and any of ``values``, otherwise the operand itself."""
    return F.expr(f"CASE WHEN {operand} IS NULL OR {operand} IN ({texts(values)}) THEN {text(to)} ELSE {operand} END")
