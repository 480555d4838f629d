"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does four jobs here: it turns a join into a broadcast once the real size
# of a side is known to be small, splits the partitions of hot join keys, resizes shuffle partitions to
# the data (so the initial number only has to be large enough), and joins by hash instead of by sort
# where every partition of one side is small. Sizes of Parquet files are taken times four when a
# broadcast is considered at planning time, because files are compressed.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


BYTES_PER_SHUFFLE_PARTITION = 128 * 1024**2
FEWEST_PARTITIONS = 200
UNKNOWN_INPUT_BYTES = 1024**4  # assumed on a cluster when nobody says how large the input is


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions for a shuffle of that size. Too many get merged at run time, too few stay too large."""
    return max(input_bytes // BYTES_PER_SHUFFLE_PARTITION, FEWEST_PARTITIONS)


def build_session(
    app: str = "cauce", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the pipeline's settings; ``master`` is left to spark-submit by default.

    ``input_bytes`` is the size of the largest table, from which the number of shuffle partitions follows.
    """
    builder = SparkSession.builder.appName(app)
    if input_bytes is None and not (master or "").startswith("local"):
        input_bytes = UNKNOWN_INPUT_BYTES
    if input_bytes is not None:
        extra = {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes)), **extra}
    if master:
        builder = (
            builder.master(master)
            .config("spark.driver.bindAddress", "127.0.0.1")
            .config("spark.driver.host", "127.0.0.1")
        )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the checkpoint folder that the cluster names.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="cauce-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
