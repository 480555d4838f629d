"""Row counts and counts of missing values out of the footers of Parquet files.

The newer file source hands ``count`` over to the files' statistics: no column is read. It is not Spark's default for
Parquet, so the reads go through a session of their own with its own settings; the caller's stays as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

V1_SOURCES = "spark.sql.sources.useV1SourceList"


def footer_session(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    listed = [x for x in spark.conf.get(V1_SOURCES).split(",") if x.strip().lower() != "parquet"]
    own.conf.set(V1_SOURCES, ",".join(listed))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def counted(spark: SparkSession, paths: Sequence[str], schema: str, columns: Sequence[str]) -> DataFrame:
    """One row: ``filas`` and, per column, how many values are there."""
    rows = footer_session(spark).read.schema(schema).parquet(*paths)
    return rows.agg(F.count(F.lit(1)).alias("filas"), *(F.count(c).alias(c) for c in columns))


def profiles(spark: SparkSession, tables: Mapping[str, tuple[Sequence[str], str]], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """(tabla, columna, filas, nulos): one line per table (columna NULL, nulos NULL) and one per watched column.

    ``tables``: name -> (folders, schema). One row per table comes to the driver, whatever the table's size.
    """
    lines = []
    for name, (paths, schema) in tables.items():
        watched = list(columns.get(name, ()))
        found = counted(spark, paths, schema, watched).first() if paths else None
        rows = found["filas"] if found else 0
        lines.append((name, None, rows, None))
        lines += [(name, c, rows, rows - found[c] if found else 0) for c in watched]
    return spark.createDataFrame(lines, "tabla string, columna string, filas bigint, nulos bigint")
