"""From raw encounters to the split feature table and the append-only feature table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..config import Settings
from ..operators.cleaning import clean_and_transform
from ..operators.features import coerce_for_feature_table
from ..operators.gates import (
    CLASS_FLOOR, PREVALENCE_TOLERANCE, PROPORTION_TOLERANCE, enforce, modelling_statistics, split_counts, split_gates,
)
from ..operators.splitting import assign_exact_split, assign_hash_split
from ..session import compiled_methods
from ..sources.catalog import append_features, check_row_count, write_partitioned


def split_frame(
    raw: DataFrame, dimensions: Mapping[str, DataFrame], settings: Settings, exact: bool = False
) -> DataFrame:
    """Cleaned encounters with their split, still lazy."""
    clean = clean_and_transform(raw, dict(dimensions))
    assign = assign_exact_split if exact else assign_hash_split
    return assign(clean, "patient_nbr", settings.seed, settings.splits)


def run_split_job(
    spark: SparkSession, raw: DataFrame, dimensions: Mapping[str, DataFrame], settings: Settings, table: str,
    path: str, exact: bool = False, floor: int = CLASS_FLOOR, proportion_tolerance: float = PROPORTION_TOLERANCE,
    prevalence_tolerance: float = PREVALENCE_TOLERANCE,
) -> dict[str, DataFrame]:
    """Clean, split, check, write. A failed gate raises before anything is written.

    The split frame feeds the gates and the sink, so it is persisted once (spilling to disk; a lost executor only
    recomputes its own partitions). Reports are read back from the written table.
    """
    frame = split_frame(raw, dimensions, settings, exact).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with compiled_methods(spark):
            enforce(split_gates(
                frame, "patient_nbr", S.TARGET, settings.splits, floor, proportion_tolerance, prevalence_tolerance))
            write_partitioned(frame, table, path)
    finally:
        frame.unpersist()
    written = spark.table(table)
    return {
        "gates": split_gates(
            written, "patient_nbr", S.TARGET, settings.splits, floor, proportion_tolerance, prevalence_tolerance),
        "splits": split_counts(written, S.TARGET, settings.splits),
        "modelling": modelling_statistics(written, S.TARGET, floor),
    }


def run_feature_job(
    spark: SparkSession, clean: DataFrame, table: str, path: str, event_time: float
) -> dict[str, int | str]:
    """Coerce, append, verify that all rows arrived."""
    prepared = coerce_for_feature_table(clean, event_time)
    expected = prepared.count()
    before = spark.table(table).count() if spark.catalog.tableExists(table) else 0
    append_features(prepared, table, path, event_time)
    after = check_row_count(spark, table, before + expected)
    return {"table": table, "records_ingested": after - before, "row_count": after}
