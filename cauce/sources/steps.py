"""Intermediate results stored between the steps of a job, and writes that leave no shuffle files behind.

A long plan keeps the shuffle files of all its steps until the driver collects its garbage. Cut into steps, the disk holds those
of one step, and what a step hands on as compressed columns.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cauce.session import shared_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COMPRESSION = "zstd"  # a third smaller than with Spark's own choice

# stores a table under a label and gives it back as read from there
Kept = Callable[[DataFrame, str], DataFrame]

_lock = threading.Lock()
_writing: dict[str, int] = {}
_before: dict[str, str | None] = {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when the write has ended, since nothing reads them again.

    The setting belongs to the session: the first of several writers at a time sets it, the last one sets it back.
    """
    session = str(spark._jsparkSession.sessionUUID())
    with _lock:
        _writing[session] = _writing.get(session, 0) + 1
        if _writing[session] == 1:
            _before[session] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            _writing[session] -= 1
            if not _writing[session]:
                before = _before.pop(session)
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows written to a folder and read back."""
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_in(spark: SparkSession, purpose: str) -> Kept:
    """Stores tables below a fresh folder that all executors share."""
    folder = shared_folder(spark, purpose)
    return lambda df, label: stored(df, f"{folder}/{label}")
