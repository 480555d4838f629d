"""Removal of repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """One copy of each whole row, audit columns included.

    A hash aggregate: copies collapse in the map tasks, so a group of copies of any size sends at
    most one row per task through the shuffle.
    """
    return df.distinct()


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` makes Catalyst put a group limit before the shuffle as well as after it, so
    a hot key also shrinks to one row per map task. The order should be total: then reruns agree,
    and two consumers of the result share one shuffle because both need every column.

    A hash of the key leads the partition columns. It changes no group, but nearly all comparisons of
    the two sorts are then decided by eight bytes instead of by long texts with common beginnings.
    """
    rank = F.row_number().over(Window.partitionBy("_hash", *key).orderBy(*order))
    hashed = df.withColumn("_hash", F.xxhash64(*key))
    return hashed.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_hash")
