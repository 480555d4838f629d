"""Bronze to raw as a stream that drops repeated rows.

The batch feed trusts the run log. This one reads the files of Bronze as they come, also those of a batch that the source has
sent again under another id, and keeps the first of equal business rows. The state store holds the rows' digests for as long as
copies may still come: ``within`` after their event time, which is the time of ingestion. A copy that comes later is a new row;
a batch that comes later than ``within`` after the newest one is dropped by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.schemas import AUDIT_COLUMNS, SourceTable
from cauce.sources.lake import PARTITIONS, Lake


def bronze_stream(lake: Lake, table: SourceTable, files_per_step: int) -> DataFrame:
    columns = [f for f in table.bronze_schema if f.name != "batch_id"]
    schema = T.StructType(columns + [T.StructField(p, T.StringType()) for p in PARTITIONS])
    return lake.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_step).parquet(lake.bronze_path(table))


def first_copies(rows: DataFrame, table: SourceTable, within: str) -> DataFrame:
    """The first of the rows that are equal in the source's columns, among those that come ``within`` of each other.

    Rows are told apart by a digest of all columns, so the state does not hold the rows themselves.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in table.columns]
    digest = F.md5(F.concat_ws("\x1f", *values))
    stamped = rows.withColumn("_event", F.to_timestamp("ingestion_ts")).withColumn("_digest", digest)
    return stamped.withWatermark("_event", within).dropDuplicatesWithinWatermark(["_digest"]).drop("_event", "_digest")


def feed_first_copies(lake: Lake, table: SourceTable, target: str, within: str = "7 days", files_per_step: int = 1000) -> None:
    """Load what has come since the last call, then stop. Steps repeated after a failure write nothing twice."""
    if table.mode != "incremental":
        raise ValueError(f"{table.name} is a full snapshot: its newest batch replaces the raw table")
    if not lake.exists(lake.bronze_path(table)):
        return
    rows = first_copies(bronze_stream(lake, table, files_per_step), table, within)
    query = (
        rows.select(*table.columns, *AUDIT_COLUMNS).writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", f"{target}.checkpoint").trigger(availableNow=True).outputMode("append").start()
    )
    query.awaitTermination()
