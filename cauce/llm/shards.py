"""Sharding by a two-pass external shuffle, in DataFrame functions only.

The first pass scatters records by seeded hashes: the shard is the highest of one hash for each shard number, so it
depends on doc_id and the number of shards alone and one more shard only takes rows into itself; inside a shard a second
hash picks one of as many buckets as keep a bucket near ``bucket_bytes``. A bucket's number is data: runs of buckets lie in one
task, as many tasks as their bytes ask for, whatever the number of buckets. The hash of the bucket takes in the place of a record in
its input, so equal records, or a shard of records without ids, fill many buckets, too. The second pass
draws each bucket's order by a Fisher-Yates shuffle (Spark's ``shuffle``) of its records, put in a fixed order
first, and writes it. A record is read back with its slot: the records of its shard's earlier buckets, and its place in its own.

Defined results: a null text has no bytes; null ids share one shard; repeated rows each have a slot; a very long text is a
bucket of its own size; an empty table gives no rows. Input columns named like one of the operator's own (size, shard,
grown_shard, slot) are replaced, and so are ``_bucket`` and ``_at``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cauce.llm.common import scratch, stored, table

ROW_BYTES = 16
BUCKET_BYTES = 1 << 20  # an aggregate holds up to 128 buckets before it sorts
TASK_BYTES = 64 << 20
OWN = ("size", "shard", "grown_shard", "slot", "_bucket", "_at")


def _size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _draw(shard: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", shard.cast("int"))


def placed(docs: DataFrame, shards: int, seed: int) -> DataFrame:
    """Adds _shard and _grown (the shard with one more of them)."""
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.struct(_draw(i, seed).alias("h"), i.alias("i"))))
    return docs.withColumn("_best", best).select(
        *(F.col(f"`{c}`") for c in docs.columns), F.col("_best.i").cast("int").alias("_shard"),
        F.when(_draw(F.lit(shards), seed) > F.col("_best.h"), shards).otherwise(F.col("_best.i")).cast("int").alias("_grown"))


def write_shards(docs: DataFrame, folder: str, shards: int = 40, seed: int = 7, bucket_bytes: int = BUCKET_BYTES,
                 task_bytes: int = TASK_BYTES) -> None:
    """One folder per shard; its records with _bucket and _at, in this order inside a file and from file to file."""
    sizes = dict(placed(docs.select("doc_id", "text"), shards, seed).groupBy("_shard").agg(F.sum(_size())).collect())  # a row per shard
    buckets = [max(1, -(-sizes.get(s, 0) // bucket_bytes)) for s in range(shards)]
    before = [sum(buckets[:s]) for s in range(shards)]
    of = lambda numbers: F.element_at(F.array(*map(F.lit, numbers)), F.col("_shard") + 1).cast("long")
    tasks = max(1, -(-sum(sizes.values()) // task_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kept = [f"`{c}`" for c in docs.columns if c not in OWN]
    rows = placed(docs.select(*kept), shards, seed).select(
        "_shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", F.crc32("text"), F.monotonically_increasing_id()), of(buckets)).alias("_bucket"),
        F.struct(F.xxhash64(F.lit(seed + 2), "doc_id", "text").alias("_order"), F.crc32("text").alias("_crc"), "_grown",
                 F.struct(*kept).alias("_row")).alias("_r"))
    task = F.floor((of(before) + F.col("_bucket")) * F.lit(tasks) / F.lit(sum(buckets))).cast("int")
    first = lambda a, b: (F.when((a["_order"] < b["_order"]) | ((a["_order"] == b["_order"]) & (a["_crc"] < b["_crc"])), -1)
                          .when((a["_order"] == b["_order"]) & a["_crc"].eqNullSafe(b["_crc"]), 0).otherwise(1))
    drawn = rows.withColumn("_task", task).repartitionById(tasks, "_task").groupBy("_task", "_shard", "_bucket").agg(
        F.collect_list("_r").alias("_all")).withColumn("_all", F.shuffle(F.array_sort("_all", first), F.lit(seed)))
    flat = drawn.select(F.col("_shard").alias("shard"), "_bucket", F.posexplode("_all").alias("_at", "_r")).select(
        "_r._row.*", F.col("_r._grown").alias("grown_shard"), "_bucket", "_at", "shard")
    flat.sortWithinPartitions("shard", "_bucket", "_at").write.mode("overwrite").partitionBy("shard").parquet(folder)


def read_shards(spark: SparkSession, folder: str, docs: DataFrame) -> DataFrame:
    """The records that ``write_shards`` has written of ``docs``, with size, shard, grown_shard and slot (from 0, without gaps)."""
    kept = [f for f in docs.schema.fields if f.name not in OWN]
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    rows = spark.read.schema(f"{names}{', ' if names else ''}grown_shard int, _bucket long, _at int, shard int").parquet(folder)
    earlier = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(rows.groupBy("shard", "_bucket").count().select(
        "shard", "_bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start")), "starts")
    return rows.join(starts, ["shard", "_bucket"]).select(
        *(f"`{f.name}`" for f in kept), _size().alias("size"), "shard", "grown_shard", (F.col("_start") + F.col("_at")).alias("slot"))


def shuffled_shards(docs: DataFrame, shards: int = 40, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` with size, shard, grown_shard and slot, read back from written shards."""
    folder = scratch(docs.sparkSession, "shards")
    write_shards(docs, folder, shards, seed, bucket_bytes)
    return read_shards(docs.sparkSession, folder, docs)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shuffled_shards(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
                       F.lit("key").alias("law"), "shard", "slot", "grown_shard")
