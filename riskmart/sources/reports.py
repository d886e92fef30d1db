"""Small report files: JSON documents and Markdown tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def write_json_report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def read_violations(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the ``violations`` array of a (possibly pretty-printed) JSON document."""
    entry = "struct<feature_name: string, constraint_check_type: string, description: string>"
    document = spark.read.schema(f"violations array<{entry}>").json(path, multiLine=True)
    return document.select(F.inline("violations")).withColumnRenamed("feature_name", "feature")


def violations_document(violations: DataFrame) -> DataFrame:
    """One row holding the violations as an array: a report has at most a few per feature."""
    entry = F.struct(F.col("feature").alias("feature_name"), "constraint_check_type", "description")
    return violations.agg(F.sort_array(F.collect_list(entry)).alias("violations"))


def markdown_lines(df: DataFrame, order: str) -> DataFrame:
    """A small table as Markdown text rows ``line_no, line``."""
    def row(cells: list) -> Column:
        return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))

    names = df.columns
    head = df.sparkSession.range(2).select(
        (F.col("id") - 2).alias("line_no"),
        F.when(F.col("id") == 0, row([F.lit(c) for c in names])).otherwise(row([F.lit("---")] * len(names))).alias("line"))

    position = F.row_number().over(Window.orderBy(order)).cast("bigint")
    body = df.select(position.alias("line_no"), row([F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]).alias("line"))
    return head.unionByName(body).orderBy("line_no")


def save_comparison(table: DataFrame, folder: str, order: str = "model") -> None:
    """The comparison table (one row per model) as CSV, and from that file as Markdown."""
    path = f"{folder}/model_comparison_csv"
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    written = table.sparkSession.read.schema(table.schema).option("header", True).csv(path)
    markdown_lines(written, order).select("line").coalesce(1).write.mode("overwrite").text(f"{folder}/model_comparison_md")
