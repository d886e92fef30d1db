"""CSV in and out. Every column is read as a string; typing happens in the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import DEFAULT_NULL_TOKENS, lenient_double, null_tokens
from ..functions.nulls import quoted
from ..functions.numeric import INTEGER_PATTERN, trimmed

# Quotes are doubled inside quotes; a backslash is text. A cell must be able to hold any text, so nothing but the empty
# cell is read as NULL unless asked for. Headers are compared with the names, and a row that does not fit is an error.
_OPTIONS = {"quote": '"', "escape": '"', "sep": ",", "mode": "FAILFAST", "nullValue": "", "enforceSchema": "false"}


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, header: bool = True,
    tokens: Iterable[str] | None = None, multi_line: bool = False,
) -> DataFrame:
    """All-string scan of one or many files or folders; ``tokens`` lists the texts to null beyond the empty cell.

    Columns are found by their header name, in any order; a missing one, and files with different headers, are errors.
    ``multi_line`` allows line breaks inside quotes, at the price of one task per file; without it such a row is an error.
    """
    reader = spark.read.options(**_OPTIONS).option("header", header).option("multiLine", multi_line)
    if header:
        found = reader.csv(path)  # all strings, named by the first header
        df = found.select(*[quoted(f.name) for f in schema.fields]) if found.columns else spark.createDataFrame([], schema)
    else:
        df = reader.schema(schema).csv(path)
    return df if tokens is None else null_tokens(df, tokens)


def read_csv_with_default_nulls(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    return read_csv(spark, path, schema, tokens=DEFAULT_NULL_TOKENS, multi_line=multi_line)


def _typed(field: T.StructField) -> Column:
    """The cell as a value of the field's type; NULL if it is not written as one."""
    cell = f"`{field.name}`"
    if isinstance(field.dataType, T.StringType):
        return quoted(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return lenient_double(cell).cast(field.dataType).alias(field.name)
    if isinstance(field.dataType, T.IntegralType):
        whole = trimmed(cell)
        return F.when(whole.rlike(INTEGER_PATTERN), whole.try_cast(field.dataType)).alias(field.name)
    return quoted(field.name).try_cast(field.dataType).alias(field.name)


def read_typed_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Headerless scan with supplied names and types; a cell that does not parse is NULL, the row stays.

    Numbers follow one pattern: ``250d``, ``inf`` and the like are not numbers.
    """
    raw = read_csv(spark, path, T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]), False, multi_line=multi_line)
    return raw.select(*map(_typed, schema.fields))


def write_csv(df: DataFrame, path: str, single_file: bool = False, header: bool = True) -> None:
    """Overwriting CSV sink. ``single_file`` is for small tables only: one task writes them."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").option("header", header).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result

