"""File sources and sinks of the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.functions.numbers import repaired_int
from cauce.schemas import SourceTable

FORMATS = ("csv", "json", "json_array", "parquet")
CSV_QUOTES = {"quote": '"', "escape": '"'}  # a quote inside a field is doubled


def _check(file_format: str) -> None:
    if file_format not in FORMATS:
        raise ValueError(f"unsupported format: {file_format}")


def _lenient(schema: T.StructType) -> T.StructType:
    """Integers as text: text formats may carry a nullable integer as ``44.0``."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.dataType == T.IntegerType() else f.dataType) for f in schema]
    )


def read_table(
    spark: SparkSession, path: str, table: SourceTable, file_format: str | None = None, quoted_breaks: bool = False
) -> DataFrame:
    """A source table from files, with the declared types; nothing is inferred.

    ``quoted_breaks`` lets CSV fields hold line breaks, at the price that a file is not split over tasks;
    without it such a file fails the read instead of giving torn rows.

    ``json`` has one record per line and splits over tasks; ``json_array`` is one array per file and
    does not.
    """
    file_format = file_format or table.file_format
    _check(file_format)
    if file_format == "parquet":
        return table.project(spark.read.schema(table.schema).parquet(path))
    reader = spark.read.schema(_lenient(table.schema)).option("mode", "FAILFAST")
    if file_format == "csv":
        df = reader.csv(path, header=True, encoding="UTF-8", **CSV_QUOTES, multiLine=quoted_breaks)
    else:
        df = reader.json(path, multiLine=file_format == "json_array")
    integers = {f.name: repaired_int(F.col(f.name)) for f in table.schema if f.dataType == T.IntegerType()}
    return table.project(df.withColumns(integers) if integers else df)


def write_table(df: DataFrame, path: str, table: SourceTable, file_format: str | None = None) -> None:
    """The declared columns in the declared order, replacing what is there."""
    file_format = file_format or table.file_format
    _check(file_format)
    writer = table.project(df).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if file_format == "csv":
        writer.csv(path, header=True, encoding="UTF-8", **CSV_QUOTES)
    elif file_format == "parquet":
        writer.parquet(path)
    else:
        writer.json(path, dateFormat="yyyy-MM-dd", ignoreNullFields=False)
