"""Taking out the rows of a batch that have been committed already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 32_768  # of one bitmap
BITS_PER_ROW = 16


def _place(columns: list[str], buckets: int) -> tuple[Column, Column]:
    """Bucket and bit of a row in the filter."""
    position = F.pmod(F.xxhash64(F.lit("filter"), *columns), F.lit(buckets * BUCKET_BITS))
    return F.floor(position / F.lit(BUCKET_BITS)).cast("long"), F.pmod(position, F.lit(BUCKET_BITS))


def seen_filter(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """A Bloom filter of the rows as bitmaps (bucket, bits), added up in the map tasks, and its number of buckets.

    Sixteen bits a row: about one row in sixteen that is not there seems to be.
    """
    buckets = max(1, -(-rows.count() * BITS_PER_ROW // BUCKET_BITS))
    bucket, bit = _place(columns, buckets)
    return rows.select(bucket.alias("_bucket"), bit.alias("_bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")), buckets


def _has_bit(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def uncommitted(rows: DataFrame, committed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows without those that ``committed`` has, copy by copy: of a row that it has twice, the third copy is new.

    Rows are compared by all ``columns``, missing values as equal. What the Bloom filter has not seen is new and goes on as it
    is; only the others are shuffled and compared exactly. The filter has two bytes a committed row; the planner sends it to all
    tasks if it is small, and else joins by bucket, where adaptive execution can split both sides.
    """
    if committed.isEmpty():
        return rows
    bits, buckets = seen_filter(committed, columns)
    bucket, bit = _place(columns, buckets)
    marked = rows.withColumn("_bucket", bucket).withColumn("_bit", bit).join(bits, "_bucket", "left").withColumn(
        "_maybe", F.coalesce(_has_bit(F.col("_bits"), F.col("_bit")), F.lit(False))).drop("_bucket", "_bit", "_bits")
    new = marked.where(~F.col("_maybe")).drop("_maybe")
    digest = F.xxhash64(*columns)
    copies = committed.groupBy(digest.alias("_digest"), *columns).agg(F.count(F.lit(1)).alias("_copies"))
    turn = F.row_number().over(Window.partitionBy("_digest", *columns).orderBy("_digest"))
    doubtful = marked.where("_maybe").drop("_maybe").withColumn("_digest", digest).withColumn("_turn", turn)
    same = F.col("r._digest") == F.col("c._digest")
    for c in columns:
        same &= F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}"))
    kept = doubtful.alias("r").join(copies.alias("c"), same, "left").where(
        F.col("r._turn") > F.coalesce(F.col("c._copies"), F.lit(0))).select(*(f"r.{c}" for c in rows.columns))
    return new.unionByName(kept)
