"""Preparing rows for the append-only feature table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.nulls import quoted

# Feature-name pattern and the sentinel for NULL text.
FEATURE_NAME = re.compile(r"^[a-zA-Z][a-zA-Z0-9_-]*$")
NULL_SENTINEL = "Missing"


def check_feature_names(columns: Sequence[str]) -> None:
    bad = [c for c in columns if not FEATURE_NAME.match(c)]
    if bad:
        raise ValueError(f"not valid as feature names: {bad}")


def feature_type(data_type: T.DataType) -> str:
    """Integral, Fractional or String."""
    if isinstance(data_type, T.IntegralType):
        return "Integral"
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        return "Fractional"
    return "String"


def feature_definitions(df: DataFrame) -> DataFrame:
    """``feature_name, feature_type`` of every column, in order."""
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("feature_name"), F.lit(feature_type(f.dataType)).alias("feature_type"))
        for f in df.schema.fields
    ])
    return df.sparkSession.range(1).select(F.inline(rows))


def coerce_for_feature_table(df: DataFrame, event_time: float) -> DataFrame:
    """One projection to bigint, double and string; NULL text becomes a sentinel, NULL numbers stay."""
    columns = []
    for field in df.schema.fields:
        c, kind = quoted(field.name), feature_type(field.dataType)
        if isinstance(field.dataType, T.BooleanType):
            c = c.cast("int").cast("bigint")
        elif kind == "Integral":
            c = c.cast("bigint")
        elif kind == "Fractional":
            c = c.cast("double")
        else:
            c = F.coalesce(c.cast("string"), F.lit(NULL_SENTINEL))
        columns.append(c.alias(field.name))
    prepared = df.select(*columns, F.lit(float(event_time)).alias("event_time"))
    check_feature_names(prepared.columns)
    return prepared
