"""Number parsing and null-safe arithmetic that neither throws on bad text nor loses nulls.

Operands are SQL text: a column name or an expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .nulls import text

# Text accepted as a number. Rules out "250d", "inf" and "nan", which a bare cast takes.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def trimmed_sql(operand: str) -> str:
    return f"btrim(CAST({operand} AS STRING), ' \\t\\n\\r')"


def double_sql(operand: str) -> str:
    clean = trimmed_sql(operand)
    return f"CASE WHEN {clean} RLIKE {text(NUMBER_PATTERN)} THEN try_cast({clean} AS DOUBLE) END"


def trimmed(operand: str) -> Column:
    return F.expr(trimmed_sql(operand))


def lenient_double(operand: str) -> Column:
    """Double value of a text number; NULL for anything else."""
    return F.expr(double_sql(operand))


def strict_bigint(operand: str, label: str = "value") -> Column:
    """Integer value of a text number, decimals truncated; fails the job on bad text or NULL."""
    clean = trimmed_sql(operand)
    # Plain integers take the first branch. A failing try_cast costs far more than a pattern, so none is tried.
    return F.expr(
        f"CASE WHEN {operand} RLIKE {text(INTEGER_PATTERN)} THEN CAST({operand} AS BIGINT) "
        f"WHEN {clean} RLIKE {text(NUMBER_PATTERN)} THEN CAST(CAST({clean} AS DOUBLE) AS BIGINT) "
        f"ELSE CAST(raise_error(concat({text(label + ': not a number: ')}, coalesce({clean}, 'NULL'))) AS BIGINT) END"
    )


def null_safe_sum(operands: Sequence[str], as_type: str = "double") -> Column:
    """Sum in which unparseable and NULL terms count as zero."""
    zero = f"CAST(0 AS {as_type})"
    terms = [f"coalesce(CAST({double_sql(o)} AS {as_type}), {zero})" for o in operands]
    return F.expr(" + ".join(terms) or zero)


def clip_upper(operand: str, upper: str | float) -> Column:
    """Smaller of the two; NULL stays NULL (``least`` alone would return the bound)."""
    return F.expr(f"CASE WHEN {operand} IS NOT NULL THEN least({operand}, {upper}) END")
