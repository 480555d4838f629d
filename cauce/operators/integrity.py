"""Referential integrity.

No join here carries a broadcast hint. Parents grow with the data, so the planner has to check
their size: below ``spark.sql.autoBroadcastJoinThreshold`` (by estimate, or by the size measured at
run time) they are broadcast, above it the join is a sort-merge join. Only semi, anti and left outer
joins are used because those are the kinds whose hot keys adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key exists in ``parent``; rows without a key are dropped."""
    return child.join(parent.select(key), key, "left_semi")


def without_parent(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of ``child`` with a key that is missing in ``parent``; rows without a key are not meant."""
    known = parent.select(F.col(parent_key or key).alias(key))
    return child.where(F.col(key).isNotNull()).join(known, key, "left_anti")


def mark_parent(child: DataFrame, parent: DataFrame, key: str, flag: str) -> DataFrame:
    """``child`` plus a flag: does the key exist in ``parent``? False for rows without a key.

    Keys are made distinct together with their length, which changes nothing but where they lie: the
    join then shuffles them once more by key alone. Adaptive execution splits a hot key (a missing
    one too) only if both sides of the join come straight from a shuffle made for it.
    """
    keys = parent.where(F.col(key).isNotNull()).select(key, F.length(key).alias("_length")).distinct()
    known = keys.select(key, F.lit(True).alias(flag))
    return child.join(known, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
