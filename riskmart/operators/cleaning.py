"""Row filters, target and column selection, and the composite cleaning step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..functions import (
    absence_flag, age_ordinal, count_in, count_not_equal, lenient_double, null_markers, null_safe_sum, or_else,
    presence_flag, strict_bigint, with_diagnosis_groups,
)
from ..functions.nulls import name, quoted
from .decoding import decode


def exclude_ids(df: DataFrame, column: str, ids: Sequence[float]) -> DataFrame:
    """Drop rows whose numeric id is listed; a NULL or unparseable id is kept."""
    listed = lenient_double(name(column)).isin([float(i) for i in ids])
    return df.where(~F.coalesce(listed, F.lit(False)))


def binary_target(df: DataFrame, source: str, positive: str, target: str) -> DataFrame:
    """0/1 target replacing ``source``; NULL is negative."""
    return df.withColumn(target, F.col(source).eqNullSafe(F.lit(positive)).cast("int")).drop(source)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns, ignoring absent ones."""
    return df.drop(*columns)


def select_features(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The frozen feature order; a missing column is an analysis error."""
    return df.select(*[quoted(c) for c in order])


def feature_names(
    columns: Sequence[str], target: str = S.TARGET, excluded: Sequence[str] = tuple(S.NON_FEATURE_COLUMNS)
) -> list[str]:
    """Columns allowed into a model: neither identifier, system column nor target."""
    return [c for c in columns if c != target and c not in excluded]


def check_features(
    columns: Sequence[str], target: str = S.TARGET, excluded: Sequence[str] = tuple(S.NON_FEATURE_COLUMNS)
) -> None:
    leaked = [c for c in columns if c == target or c in excluded]
    if leaked:
        raise ValueError(f"columns not allowed as features: {leaked}")


def features_and_target(
    df: DataFrame, target: str = S.TARGET, excluded: Sequence[str] = tuple(S.NON_FEATURE_COLUMNS)
) -> DataFrame:
    """Feature columns plus the integer target, nothing else."""
    names = feature_names(df.columns, target, excluded)
    check_features(names, target, excluded)
    return df.select(*[quoted(c) for c in names], F.col(target).cast("int").alias(target))


def normalise_names(df: DataFrame) -> DataFrame:
    """Catalog-style names: lower case, hyphens to underscores; collisions are an error."""
    names = [c.lower().replace("-", "_") for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("column names collide after normalisation")
    return df.toDF(*names)


def derive_encounter_features(df: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """All derived encounter columns in one wide projection, then the three description lookups."""
    drugs = [c for c in S.DRUG_COLUMNS if c in df.columns]
    drug_cells = [name(c) for c in drugs]
    replaced = {
        "medical_specialty": or_else("medical_specialty", "Unknown"),
        "payer_code": or_else("payer_code", "Unknown"),
        **{c: strict_bigint(c, c) for c in S.COUNTER_COLUMNS},
    }
    dropped = [c for c in drugs if c not in S.KEPT_DRUGS]
    kept = [replaced[c].alias(c) if c in replaced else name(c) for c in df.columns if c not in dropped]
    wide = with_diagnosis_groups(df, S.DIAGNOSIS_COLUMNS).select(
        *kept,
        *[f"{c}_group" for c in S.DIAGNOSIS_COLUMNS],
        age_ordinal("age").alias("age_ordinal"),
        count_in(drug_cells, ["Up", "Down"]).alias("n_med_changes"),
        count_not_equal(drug_cells, "No").alias("n_diabetes_meds"),
        presence_flag("A1Cresult").alias("a1c_tested"),
        or_else("A1Cresult", "NotTested").alias("a1c_level"),
        presence_flag("max_glu_serum").alias("glu_tested"),
        or_else("max_glu_serum", "NotTested").alias("glu_level"),
        absence_flag("medical_specialty").alias("specialty_missing"),
        absence_flag("payer_code").alias("payer_missing"),
        null_safe_sum(S.VISIT_COUNTERS, "bigint").alias("prior_visits_total"),
        *[F.col(key).alias(f"_raw_{dimension}") for dimension, key in S.DIMENSIONS.items()],
    )
    for output, key in S.DIMENSIONS.items():
        dimension = dimensions[output]
        order = "line_no" if "line_no" in dimension.columns else None
        wide = decode(wide, f"_raw_{output}", dimension, key, "description", output, order)
    return wide.drop(*[f"_raw_{output}" for output in S.DIMENSIONS])


def clean_and_transform(df: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Raw all-string encounters to the typed 44-column feature table, as one lazy plan."""
    return (
        df.transform(null_markers)
        .transform(exclude_ids, "discharge_disposition_id", S.EXCLUDED_DISPOSITIONS)
        .transform(binary_target, "readmitted", S.POSITIVE_OUTCOME, S.TARGET)
        .transform(drop_columns, S.LOW_VALUE_COLUMNS)
        .transform(derive_encounter_features, dimensions)
    )
