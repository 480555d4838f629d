"""Helpers that several operators of this package share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_BYTES = 16 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared folder; a local one only for local sessions that name none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cauce-")
    return f"{base}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends at files that survive lost executors.

    The write's shuffle files go as soon as it has ended, since nothing reads them again; otherwise they
    stay on the executors' disks until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what ``stored`` has written; only for tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "stored_at", None):
            to = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            to.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(to, True)


def partitions_for(df: DataFrame, part_bytes: int = PARTITION_BYTES) -> int:
    """Partitions in proportion to the input's size on disk, at least the session's number for shuffles."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // part_bytes)) if size < 1 << 62 else least


def text_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Lowers the session's rows per Arrow batch for whole texts: 10,000 of them are a hundred MB in JVM and Python each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(name)) > rows:
        df.sparkSession.conf.set(name, rows)
    return df


def slices(batches: Iterable, rows: int = 512) -> Iterator:
    """Arrow batches cut into pieces of few rows, so that Python objects for one piece only are alive."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, component) for the ids in edges (a, b): the smallest id reachable.

    Alternating large and small stars; each round leaves a written table. Hubs go through partial
    aggregates and a join on the hub that adaptive execution can split, never through a collected list.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a != b").distinct(), label)
    mark, hub = None, F.bitwise_not("a")  # another key than the aggregate's: the join's own shuffles can be split
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).select(hub.alias("hub"), "m")
        large = both.withColumn("hub", hub).join(least, "hub").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(hub.alias("hub"), "m")
        small = large.withColumn("hub", hub).join(least, "hub").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
            .alias("e")).select("e.*").where("a != b").distinct()
        before, now = now, stored(small, label)
        discard(before)
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    out = now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
    out.stored_at = now.stored_at
    return out
