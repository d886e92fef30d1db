"""Turning marker text into SQL NULL. Each function is one projection over the string columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The text a CSV reader of the dataframe world takes for null (exact, case-sensitive, untrimmed).
DEFAULT_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def name(column: str) -> str:
    """Column name as SQL text that survives hyphens and dots."""
    return f"`{column}`"


def text(value: str) -> str:
    """String literal as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values: Iterable[str]) -> str:
    return ", ".join(text(v) for v in values)


def quoted(column: str) -> Column:
    return F.col(name(column))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def null_tokens(df: DataFrame, tokens: Iterable[str] = tuple(DEFAULT_NULL_TOKENS)) -> DataFrame:
    """Null every string cell whose whole text is one of ``tokens``."""
    listed, strings = texts(tokens), set(string_columns(df))
    return df.selectExpr(*[
        f"CASE WHEN {name(c)} NOT IN ({listed}) THEN {name(c)} END AS {name(c)}" if c in strings else name(c)
        for c in df.columns
    ])


def null_markers(df: DataFrame, marker: str = "?") -> DataFrame:
    """Null every string cell that equals ``marker`` exactly (no trimming)."""
    return null_tokens(df, [marker])


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
