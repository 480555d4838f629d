"""Bronze to raw for the append-only tables, reading only the batches that are new.

The batch loader rebuilds a raw table from all batches ever ingested. With a long history that reads
everything again each day; here the stream follows the run log, the checkpoint remembers which of its entries
have been seen, and a run appends the batches that the rest of them name. Both leave the same rows in the raw table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.plans.ingest import RUN_LOG_SCHEMA, committed_rows, flat_run_log
from cauce.schemas import SourceTable
from cauce.sources.lake import Lake


def append_new_batches(lake: Lake, table: SourceTable) -> None:
    """Load the batches that were committed since the last call, then stop.

    It may overlap with ingestion runs: a batch enters with its entry in the run log, however long its
    files have been there, and files without an entry are not read. Each
    step writes a folder of its own, so a step that is repeated after a failure replaces itself.
    """
    if table.mode != "incremental":
        raise ValueError(f"{table.name} is a full snapshot: its newest batch replaces the raw table")
    if not lake.exists(lake.path("bronze", "_logs")):
        return

    def append(entries: DataFrame, step: int) -> None:
        logged = flat_run_log(entries).where((F.col("tabla") == table.name) & F.col("path").isNotNull())
        if logged.isEmpty():
            return
        (
            committed_rows(lake, table, logged)
            .select("*", F.lit(step).alias("feed_step"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("feed_step").parquet(lake.raw_path(table))
        )

    query = (
        lake.spark.readStream.schema(RUN_LOG_SCHEMA).parquet(lake.path("bronze", "_logs"))
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", lake.path("checkpoints", f"raw_{table.name.lower()}_commits"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
