"""Provenance of raw files: checksum, data rows, ingestion time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

CHUNK_BYTES = 4 * 1024 * 1024


def file_system(path: str):
    """File system and name of a path as Spark spells it: schemes of Hadoop's S3 clients, and plain characters."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        scheme = "s3"
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")


def _checksums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stream each file through SHA-256 in fixed-size chunks, so any file size fits in a task."""
    for batch in batches:
        digests = []
        for path in batch["path"]:
            system, name = file_system(path)
            digest = hashlib.sha256()
            with system.open_input_stream(name, compression=None) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield pd.DataFrame({"path": batch["path"], "sha256": digests})


def manifest(spark: SparkSession, paths: list[str], ingested_at: str) -> DataFrame:
    """``filename, path, length, sha256, row_count, ingested_at``, one row per file.

    ``row_count`` is the number of physical lines less one header line. Listing reads no content; checksums run one
    file per task; line counting splits large files. Zero-byte files hold no header and are not listed.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    tasks = files.select("path").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    sums = tasks.mapInPandas(_checksums, "path string, sha256 string")
    lines = spark.read.text(paths, lineSep="\n").groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("n"))
    # The text reader's metadata spells paths percent-encoded, the file listing does not; "+" is a plain character in both.
    plain = lambda c: F.regexp_replace(c, r"^file:/+", "file:/")
    decoded = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    counted = lines.select(decoded(plain(F.col("path"))).alias("_path"), "n")
    joined = files.join(sums, "path").join(counted, plain(F.col("path")) == F.col("_path"), "left")
    return joined.select(
        F.substring_index("path", "/", -1).alias("filename"), "path", "length", "sha256",
        (F.coalesce("n", F.lit(0)) - 1).alias("row_count"), F.lit(ingested_at).alias("ingested_at"),
    )
