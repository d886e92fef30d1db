"""One text file holding several small tables on top of each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


class StackedFileError(ValueError):
    """The file does not hold the expected tables."""


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, blanks, line`` of one file; ``blanks`` counts the blank lines before. Large files are read in blocks.

    Lines are numbered inside their block and the totals of earlier blocks are added; only those totals, one row per
    block, meet in one task.
    """
    sizes = spark.read.format("binaryFile").load(path).select("path").collect()
    if len(sizes) != 1:
        raise StackedFileError(f"expected one file at {path}, found {len(sizes)}")
    blank: Column = F.regexp_replace("value", r"^[\s,]+|[\s,]+$", "") == ""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), blank.cast("int").alias("blank"),
    )
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lines.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum("blank").alias("blank")).select(
        "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lines_before"),
        F.coalesce(F.sum("blank").over(earlier), F.lit(0)).alias("blanks_before"))
    inside = Window.partitionBy("block").orderBy("place")
    counted = lines.select(
        "line", "block", "blank", F.row_number().over(inside).alias("own"), F.sum("blank").over(inside).alias("own_blanks"))
    return counted.join(offsets, "block").where("blank = 0").select(
        (F.col("lines_before") + F.col("own")).alias("line_no"), (F.col("blanks_before") + F.col("own_blanks")).alias("blanks"), "line")


def sections(lines: DataFrame) -> DataFrame:
    """Header line of every section: lines with equally many blank or comma-only lines before them belong together."""
    return lines.groupBy("blanks").agg(F.min("line_no").alias("header_no"), F.min_by("line", "line_no").alias("header"))


def read_stacked(spark: SparkSession, path: str, tables: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """The tables by name, all strings plus ``line_no``; wrong number of sections or wrong headers is an error.

    Only the empty cell is NULL; the text ``NULL`` stays text.
    """
    lines = numbered_lines(spark, path)
    heads = sections(lines)
    found = heads.count()
    if found != len(tables):
        raise StackedFileError(f"expected {len(tables)} stacked tables, found {found}")
    result = {}
    for (name, columns), head in zip(tables.items(), heads.orderBy("header_no").collect()):  # one row per expected table
        names = [c.strip().strip('"') for c in head["header"].split(",")]
        if names != list(columns):
            raise StackedFileError(f"{name}: expected columns {list(columns)}, found {names}")
        schema = ", ".join(f"`{c}` string" for c in columns)
        body = lines.where((F.col("blanks") == head["blanks"]) & (F.col("line_no") > head["header_no"]))
        cells = F.from_csv("line", schema, {"quote": '"', "escape": '"', "nullValue": ""})
        result[name] = body.select(cells.alias("c"), "line_no").select("c.*", "line_no")
    return result
