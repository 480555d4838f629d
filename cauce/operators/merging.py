"""Full outer merge of measures that share a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_measures(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys of both sides, each measure 0 where its side has no row.

    Both sides hold one row per key, so stacking them with zeros and adding up gives what a full
    outer join with coalesced keys gives: a missing measure counts as 0, and rows with a missing key
    match nothing, so those of the two sides stay apart. It takes one hash aggregate: the rows are
    combined before the shuffle, neither side is sorted, and no key can be hot.
    """
    measures = {c: df.schema[c].dataType for df in (left, right) for c in df.columns if c not in keys}

    unmatched = reduce(or_, (F.col(k).isNull() for k in keys))

    def widened(df: DataFrame, side: int) -> DataFrame:
        filled = {
            c: (F.coalesce(F.col(c), F.lit(0)) if c in df.columns else F.lit(0)).cast(t)
            for c, t in measures.items()
        }
        return df.withColumns(filled).withColumn("_side", F.when(unmatched, side)).select(*keys, "_side", *measures)

    totals = [F.sum(c).cast(t).alias(c) for c, t in measures.items()]
    stacked = widened(left, 0).unionByName(widened(right, 1))
    return stacked.groupBy(*keys, "_side").agg(*totals).drop("_side")
