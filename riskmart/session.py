"""Session construction and the shared work folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANED: set[str] = set()

# The Java VM leaves a longer method to its interpreter. Stages of wide rows whose generated code has one run as many small
# methods instead.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def build_session(app_name: str = "riskmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes: UTC, ANSI, AQE with skew-join splitting.

    Partition counts, memory and the shared folder stay whatever the cluster configures; pass them as
    keyword settings only for local runs.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no stack capture per column expression
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(*METHOD_LIMIT)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, *pairs: tuple[str, str]) -> Iterator[None]:
    """Jobs inside run with these settings whoever built the session; its own are restored afterwards."""
    before = [(name, spark.conf.get(name, None)) for name, _ in pairs]
    for name, value in pairs:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before:
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def compiled_methods(spark: SparkSession):
    """Jobs inside keep to ``METHOD_LIMIT``."""
    return settings(spark, METHOD_LIMIT)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or one below the session's warehouse if that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work").rstrip("/")


def work_root(spark: SparkSession) -> str:
    """All intermediates of this application lie below this folder."""
    return f"{shared_folder(spark)}/riskmart/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written intermediate; it goes when the application ends or with ``clean_work``."""
    root = work_root(spark)
    if root not in _CLEANED:
        _CLEANED.add(root)
        atexit.register(_clean_at_exit, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete one written intermediate whose readers are done."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clean_work(spark: SparkSession) -> None:
    """Delete every intermediate this application has written."""
    remove_path(spark, work_root(spark))


def _clean_at_exit(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is not None:  # else stopped before: its session is gone and with it the file systems
        remove_path(spark, root)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Compute once: write to the shared folder and read back, with sizes the planner can see."""
    path = work_path(df.sparkSession, name)
    with compiled_methods(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like ``materialise``, for readers that are done inside: the files go at the end."""
    path = work_path(df.sparkSession, name)
    try:
        with compiled_methods(df.sparkSession):
            df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_path(df.sparkSession, path)
