"""Folder layout of the lake, and the reads and writes that depend on it."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.schemas import SourceTable
from cauce.sources.steps import COMPRESSION, shuffles_removed, stored as stored_at

PARTITIONS = ("year", "month", "day", "batch_id")
SCHEMA_FILE = "_schema.json"
POINTERS = "_pointers"


@dataclass(frozen=True)
class Lake:
    """Tables of one environment below a root folder that all executors reach."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def bronze_path(self, table: SourceTable) -> str:
        return self.path("bronze", table.name)

    def raw_path(self, table: SourceTable) -> str:
        return self.path("raw", f"raw_{table.name.lower()}")

    def _folder(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def exists(self, path: str) -> bool:
        files, folder = self._folder(path)
        return files.exists(folder)

    def names(self, path: str) -> set[str]:
        """Names of what lies in a folder; none if there is no such folder."""
        files, folder = self._folder(path)
        return {f.getPath().getName() for f in files.listStatus(folder)} if files.exists(folder) else set()

    def mark(self, path: str) -> None:
        """Create an empty file."""
        files, file = self._folder(path)
        files.create(file, True).close()

    def remove(self, path: str) -> None:
        files, folder = self._folder(path)
        files.delete(folder, True)

    def size_of(self, path: str) -> int:
        files, folder = self._folder(path)
        return files.getContentSummary(folder).getLength()

    def bronze(self, table: SourceTable) -> DataFrame:
        """All batches of a table; the partition columns stay text (``month=08``)."""
        columns = [f for f in table.bronze_schema if f.name != "batch_id"]
        schema = T.StructType(columns + [T.StructField(p, T.StringType()) for p in PARTITIONS])
        return self.spark.read.schema(schema).parquet(self.bronze_path(table))

    def read(self, layer: str, name: str) -> DataFrame:
        """A stored table; with the schema that it was written with, so that an empty one can be read too."""
        return read_model(self.spark, self.path(layer, name))


def _versions(lake: Lake, path: str) -> list[str]:
    """Names of the table's complete versions, the newest last: what its pointers name."""
    return [name.split("-", 1)[1] for name in sorted(lake.names(f"{path}/{POINTERS}"))]


def read_model(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest complete version of a table that ``write_model`` has written, or the files of a plain folder."""
    lake = Lake(spark, path)
    versions = _versions(lake, path)
    folder = f"{path}/v-{versions[-1]}" if versions else path
    files, schema_file = lake._folder(f"{folder}/{SCHEMA_FILE}")
    if schema is None and files.exists(schema_file):
        stream = files.open(schema_file)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        schema = T.StructType.fromJson(json.loads(text))
    return (spark.read.schema(schema) if schema else spark.read).parquet(folder)


@dataclass(frozen=True)
class Layout:
    """Physical order of a table: folders by ``partition``, rows of a file by ``cluster``."""

    partition: str
    cluster: tuple[str, ...] = ()


def write_model(df: DataFrame, path: str, layout: Layout | None = None) -> None:
    """Replace a table: a new version is written beside the old one and becomes the table with its pointer.

    A pointer is an empty file whose name has a number and the version; the highest number counts. Creating it is one
    step on every store, and nothing is renamed or copied: readers see the old version or the new one, never none, and a
    writer that dies leaves the old one. The version before stays for readers that have begun with it; older ones, and
    what dead writers have left, are deleted. A table has one writer at a time.

    With a layout, rows are rebalanced by the partition column: adaptive execution merges small
    partitions into one task and splits one that is too large, so a date with a third of all rows
    becomes many files written by many tasks.
    """
    writer_input = df
    if layout:
        writer_input = df.hint("rebalance", layout.partition).sortWithinPartitions(layout.partition, *layout.cluster)
    lake, mark = Lake(df.sparkSession, path), uuid.uuid4().hex[:12]
    new = f"{path}/v-{mark}"
    with shuffles_removed(df.sparkSession):
        writer = writer_input.write
        (writer.partitionBy(layout.partition) if layout else writer).parquet(new, compression=COMPRESSION)
    files, schema_path = lake._folder(f"{new}/{SCHEMA_FILE}")
    schema_file = files.create(schema_path)
    schema_file.write(bytearray(df.schema.json().encode()))
    schema_file.close()
    pointers = sorted(lake.names(f"{path}/{POINTERS}"))
    number = int(pointers[-1].split("-", 1)[0]) + 1 if pointers else 1
    lake.mark(f"{path}/{POINTERS}/{number:012d}-{mark}")
    kept = {f"v-{mark}", *(f"v-{p.split('-', 1)[1]}" for p in pointers[-1:])}
    for name in {n for n in lake.names(path) if n.startswith("v-")} - kept:
        lake.remove(f"{path}/{name}")
    for name in pointers[:-1]:
        lake.remove(f"{path}/{POINTERS}/{name}")


def merge_snapshot(
    lake: Lake, new: DataFrame, path: str, day: str, keys: Sequence[str], staging: str, stored: bool = False
) -> None:
    """Put a snapshot into a history: rows of the same day and keys are replaced, all else is kept.

    ``new`` is written to ``staging`` first, because it is needed twice; not if it is ``stored``, read from files other
    than the history's own. Only the partitions of its
    days are read and rewritten. Keys match when equal or both missing, so a rerun adds nothing.
    """
    fresh = new if stored else stored_at(new, staging)
    merged = fresh
    if lake.exists(path):
        old = lake.spark.read.schema(new.schema).parquet(path)
        old = old.join(fresh.select(day).distinct(), day, "left_semi").alias("old")
        same = [F.col(f"old.{k}").eqNullSafe(F.col(f"fresh.{k}")) for k in keys]
        kept = old.join(fresh.alias("fresh"), same, "left_anti")
        merged = fresh.unionByName(stored_at(kept, f"{staging}-kept"))
    with shuffles_removed(lake.spark):
        (
            merged.hint("rebalance", day)
            .sortWithinPartitions(day, *[k for k in keys if k != day])
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(day).parquet(path, compression=COMPRESSION)
        )
