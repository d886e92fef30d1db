"""Code lists mapped to labels. Operands are SQL text: a column name or an expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import AGE_BANDS
from .nulls import name, text
from .numeric import double_sql, trimmed_sql

# ICD-9 groups as (label, low, high, symptom code); both ends closed, first match wins.
DIAGNOSIS_RANGES = [
    ("Circulatory", 390, 459, 785),
    ("Respiratory", 460, 519, 786),
    ("Digestive", 520, 579, 787),
    ("Genitourinary", 580, 629, 788),
    ("Injury", 800, 999, None),
    ("Musculoskeletal", 710, 739, None),
    ("Neoplasms", 140, 239, None),
]


def diagnosis_group(operand: str, number: str | None = None) -> Column:
    """Ten-label group of an ICD-9 code. Range ends apply to the decimal value, so 459.81 is ``Other``.

    ``number`` names a column that already holds the parsed code; without it the code is parsed in every branch.
    """
    clean, value = trimmed_sql(operand), number or double_sql(operand)
    whens = [
        f"WHEN {operand} IS NULL THEN 'Missing'",
        f"WHEN left({clean}, 1) IN ('V', 'E') THEN 'Other'",
        f"WHEN {value} >= 250 AND {value} < 251 THEN 'Diabetes'",
    ]
    for label, low, high, symptom in DIAGNOSIS_RANGES:
        inside = f"{value} BETWEEN {low} AND {high}"
        if symptom is not None:
            inside += f" OR ({value} >= {symptom} AND {value} < {symptom + 1})"
        whens.append(f"WHEN {inside} THEN {text(label)}")
    return F.expr(f"CASE {' '.join(whens)} ELSE 'Other' END")


def with_diagnosis_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_group`` for each code column, parsing every code once."""
    parsed = df.select("*", *[F.expr(f"{double_sql(c)} AS _number_{c}") for c in columns])
    groups = [diagnosis_group(c, f"_number_{c}").alias(f"{c}_group") for c in columns]
    return parsed.select(*[name(c) for c in df.columns], *groups)


def age_ordinal(operand: str) -> Column:
    """Position of an age band, NULL when the band is unknown."""
    whens = " ".join(f"WHEN {text(band)} THEN {i}" for i, band in enumerate(AGE_BANDS))
    return F.expr(f"CASE {operand} {whens} END")
