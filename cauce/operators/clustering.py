"""Order of rows in files for filters on several columns: a key of interleaved rank bits.

Each column becomes a rank of ``2**bits`` at most: which of the quantiles of its values, as sketched by ``ranges``, a value lies
behind. The ranks' bits are interleaved, highest first, so rows that agree in the first bits of the key agree in the first
bits of every rank. Files that hold a range of keys have narrow ranges in every column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.operators.ranges import key_parts

BITS = 7


def rank_bounds(df: DataFrame, column: str, bits: int = BITS) -> list:
    """Lower ends of the column's ranges, rising; at most ``2**bits - 1`` of them."""
    parts = key_parts(df.select(column), [column], 2**bits)
    return sorted(b.low for p in parts for b in p.bounds if b.low is not None)[: 2**bits - 1]


def rank(column: str, bounds: Sequence, bits: int = BITS) -> Column:
    """The rank of a value, spread over all ``bits``; missing values come first."""
    steps = F.lit(0)
    if bounds:
        held = F.array(*map(F.lit, bounds))
        steps = F.size(F.filter(held, lambda b: b <= F.col(column)))
    return F.when(F.col(column).isNull(), 0).otherwise(F.floor(steps * F.lit(2**bits) / F.lit(len(bounds) + 1))).cast("int")


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The highest bit of each rank, then the next of each, and so on."""
    key = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for r in ranks:
            key = key * 2 + F.getbit(r, F.lit(bit))
    return key


def clustered(df: DataFrame, columns: Sequence[str], files: int, partition: str | None = None, bits: int = BITS) -> DataFrame:
    """The rows dealt into about ``files`` ranges of the key and sorted by it; inside the values of ``partition``, if there is one.

    ``df`` is read several times: give a stored table.
    """
    key = interleaved([rank(c, rank_bounds(df, c, bits), bits) for c in columns], bits)
    order = ([partition] if partition else []) + ["_key"]
    return df.withColumn("_key", key).repartitionByRange(files, *order).sortWithinPartitions(*order, *columns).drop("_key")
