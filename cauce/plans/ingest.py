"""Bronze: extraction with watermarks, audit columns, run log; and the way from there to raw tables."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cauce.operators.late import uncommitted
from cauce.plans import monitor
from cauce.schemas import SOURCES, SourceTable
from cauce.sources.lake import PARTITIONS, Lake, read_model, write_model
from cauce.sources.steps import COMPRESSION, shuffles_removed

RUN_LOG_SCHEMA = (
    "batch_id string, started_at string, finished_at string, success boolean, "
    "tables map<string, struct<mode: string, rows: bigint, size_bytes: bigint, duration_s: double, path: string>>, "
    "errors array<struct<table: string, error: string, duration_s: double>>, "
    "watermarks map<string, date>"
)
STEP_FAILURE_SCHEMA = "batch_id string, created_at string, error string"

PARALLEL_TABLES = 4

# gives a source table, or its rows after a watermark if the source can apply one itself
Reader = Callable[[SourceTable, date | None], DataFrame]


class IngestionFailed(RuntimeError):
    """At least one table of a run failed; the others were ingested."""


def newer_rows(df: DataFrame, column: str, last_value: date | str | None) -> DataFrame:
    """Rows strictly after the watermark, all rows on the first run. Pushed down to the scan."""
    if last_value is None:
        return df
    return df.where(F.col(column) > F.lit(last_value).cast(df.schema[column].dataType))


def next_watermark(batch: DataFrame, column: str, last_value: date | str | None) -> DataFrame:
    """One row: the highest value of the batch, or the old watermark if the batch is empty."""
    old = F.lit(last_value).cast(batch.schema[column].dataType)
    return batch.agg(F.coalesce(F.max(column), old).alias("last_value"))


def with_audit(df: DataFrame, batch_id: str, source_system: str, ingested_at: datetime) -> DataFrame:
    return df.withColumns(
        {
            "ingestion_ts": F.lit(ingested_at.isoformat()),
            "source_system": F.lit(source_system),
            "batch_id": F.lit(batch_id),
        }
    )


def write_batch(df: DataFrame, path: str, ingested_at: datetime) -> None:
    """Append a batch below ``year=/month=/day=/batch_id=`` of its ingestion.

    The batch has a folder of its own, so repeating a batch after a failure replaces it. All its
    rows go to one folder, hence no shuffle: every task writes what it read.
    """
    dated = df.withColumns(
        {p: F.lit(ingested_at.strftime(f)) for p, f in zip(PARTITIONS, ("%Y", "%m", "%d"))}
    )
    with shuffles_removed(df.sparkSession):
        (
            dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS).parquet(path, compression=COMPRESSION)
        )


def latest_by(log: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Per key the value with the highest order."""
    return log.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def flat_run_log(log: DataFrame) -> DataFrame:
    """One row per run and table."""
    return log.select("batch_id", "started_at", F.explode("tables").alias("tabla", "_t")).select(
        "batch_id", "started_at", "tabla", "_t.*"
    )


def read_run_log(lake: Lake) -> DataFrame | None:
    path = lake.path("bronze", "_logs")
    return lake.spark.read.schema(RUN_LOG_SCHEMA).parquet(path) if lake.exists(path) else None


@dataclass
class Ingestion:
    """Runs of the Bronze job against one lake.

    Without ``overlap_days`` a run takes the rows strictly after the watermark, as the source system's own job does: rows that
    arrive late for the watermark's day are lost, and one date in the future parks the mark. With it, a run reads
    that many days before the watermark again and takes out the rows that earlier runs have committed; the mark is the
    highest date up to the day of the run. Rows that arrive later than the overlap are lost; rows of future dates are read by
    every run and taken out again.
    """

    lake: Lake
    source_system: str
    tables: Mapping[str, SourceTable] = field(default_factory=lambda: SOURCES)
    overlap_days: int | None = None

    @property
    def _log_path(self) -> str:
        return self.lake.path("bronze", "_logs")

    def _append(self, rows: list[dict[str, Any]], schema: str, path: str) -> None:
        self.lake.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def run_log(self) -> DataFrame | None:
        return read_run_log(self.lake)

    def watermark(self, table: str) -> date | None:
        """The last value committed for the table: that of its newest entry in the run log."""
        log = self.run_log()
        if log is None:
            return None
        entries = log.select("finished_at", F.explode("watermarks").alias("table", "last_value"))
        found = latest_by(entries.where(F.col("table") == table), ["table"], "last_value", "finished_at").first()
        return found["last_value"] if found else None

    def _without_committed(self, rows: DataFrame, table: SourceTable, since: date | None) -> DataFrame:
        """The rows without those after ``since`` that earlier runs have committed."""
        log = self.run_log()
        if log is None or not self.lake.exists(self.lake.bronze_path(table)):
            return rows
        committed = committed_rows(self.lake, table, flat_run_log(log)).select(*table.columns)
        return uncommitted(rows, newer_rows(committed, table.watermark, since), table.columns)

    def _committed(self, batch_id: str) -> set[str]:
        """Tables that an earlier attempt of the batch has logged already."""
        log = self.run_log()
        if log is None:
            return set()
        names = log.where(F.col("batch_id") == batch_id).select(F.explode(F.map_keys("tables")).alias("tabla"))
        return {r["tabla"] for r in names.distinct().collect()}

    def _ingest(
        self, table: SourceTable, read: Reader, batch_id: str, at: datetime
    ) -> tuple[dict[str, Any], date | None]:
        """Write a table's batch. Gives its log entry and its new watermark, both still uncommitted."""
        started = time.time()
        last_value = since = self.watermark(table.name) if table.watermark else None
        highest = F.col(table.watermark) if table.watermark else None
        if table.watermark and self.overlap_days is not None:
            since = last_value - timedelta(days=self.overlap_days) if last_value else None
            highest = F.when(highest <= F.lit(at.date()), highest)
        rows = table.project(read(table, since))
        metrics = [F.count(F.lit(1)).alias("rows")]
        if table.watermark:
            rows = newer_rows(rows, table.watermark, since)
            metrics.append(F.max(highest).alias("last"))
            if self.overlap_days is not None:
                rows = self._without_committed(rows, table, since)
        # the count and the new watermark come out of the write itself, not from further passes
        observed = Observation()
        audited = with_audit(rows.observe(observed, *metrics), batch_id, self.source_system, at)
        path = self.lake.bronze_path(table)
        write_batch(audited, path, at)
        entry = {"mode": table.mode, "rows": observed.get["rows"], "size_bytes": None, "path": None}
        if entry["rows"]:
            entry["path"] = f"{path}/year={at:%Y}/month={at:%m}/day={at:%d}/batch_id={batch_id}"
            entry["size_bytes"] = self.lake.size_of(entry["path"])
            if table.watermark:
                last_value = max(filter(None, (observed.get["last"], last_value)), default=None)
        return {**entry, "duration_s": round(time.time() - started, 2)}, last_value

    def run(self, read: Reader, batch_id: str | None = None, at: datetime | None = None) -> str:
        """Ingest all tables. One that fails does not stop the others, but fails the run.

        The row of the run log is the only commit: paths, counts and watermarks become visible with it,
        together. A run that dies before it leaves folders that nobody reads, and the next run starts
        from the old watermarks. Repeating a batch ingests only the tables that it has not committed yet.
        """
        at = at or datetime.now(timezone.utc)
        batch_id = batch_id or f"batch-{uuid.uuid4().hex[:12]}"
        done: dict[str, dict[str, Any]] = {}
        marks: dict[str, date] = {}
        errors: list[dict[str, Any]] = []
        committed = self._committed(batch_id)
        if committed >= set(self.tables):
            return batch_id

        def ingested(name: str) -> tuple[dict[str, Any] | None, date | None, dict[str, Any] | None]:
            started = time.time()
            try:
                return *self._ingest(self.tables[name], read, batch_id, at), None
            except Exception as error:  # noqa: BLE001 - recorded below, raised at the end
                return None, None, {"table": name, "error": str(error), "duration_s": round(time.time() - started, 2)}

        # a small table has few tasks; beside the others it does not hold up the run
        names = [n for n in self.tables if n not in committed]
        with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
            outcomes = list(pool.map(ingested, names))
        for name, (logged, mark, error) in zip(names, outcomes):
            if error:
                errors.append(error)
                continue
            done[name] = logged
            if mark is not None:
                marks[name] = mark
        entry = {"batch_id": batch_id, "started_at": at.isoformat(),
                 "finished_at": datetime.now(timezone.utc).isoformat(), "success": not errors,
                 "tables": done, "errors": errors, "watermarks": marks}
        self._append([entry], RUN_LOG_SCHEMA, self._log_path)
        try:
            self._volume_events(batch_id, at)
        except Exception as error:  # noqa: BLE001 - the batch is committed; the check must not undo that
            logging.getLogger(__name__).exception("volume check of %s failed", batch_id)
            failure = {"batch_id": batch_id, "created_at": at.isoformat(), "error": str(error)}
            self._append([failure], STEP_FAILURE_SCHEMA, self.lake.path("bronze", "_step_failures"))
        if errors:
            raise IngestionFailed(f"{len(errors)} table(s) failed: {[e['table'] for e in errors]}")
        return batch_id

    def _volume_events(self, batch_id: str, at: datetime) -> None:
        """Judge the run just logged against the seven runs logged before it."""
        log = self.run_log()
        runs = monitor.newest_runs(log, monitor.HISTORY_RUNS + 1, until=at.isoformat())
        volumes = flat_run_log(log).select("batch_id", "started_at", "tabla", "rows")
        events = monitor.volume_anomalies(volumes, runs).where(
            (F.col("batch_id") == batch_id) & (F.col("started_at") == at.isoformat())
        )
        monitor.append_events(self.lake, monitor.volume_events(events, at.isoformat()))


def committed_rows(lake: Lake, table: SourceTable, logged: DataFrame) -> DataFrame:
    """The rows below the paths that the flat log rows name; only those folders are read.

    A batch is found by its whole path: the folder that a dead run has left under the same batch id
    on another day does not count.
    """
    paths = logged.where((F.col("tabla") == table.name) & F.col("path").isNotNull())
    folders = paths.select(
        *(F.regexp_extract("path", f"/{p}=([^/]+)", 1).alias(p) for p in PARTITIONS)
    ).distinct()
    return lake.bronze(table).join(folders, list(PARTITIONS), "left_semi").select(*table.bronze_schema.names)


def batch_paths(table: SourceTable, run_log: DataFrame) -> list[str]:
    """The folders of the batches that make up a table now: one, or one per run that brought rows."""
    logged = flat_run_log(run_log).where((F.col("tabla") == table.name) & F.col("path").isNotNull())
    if table.mode == "full":
        logged = logged.groupBy("tabla").agg(F.max_by("path", "started_at").alias("path"))
    return sorted(r["path"] for r in logged.select("path").distinct().collect())


def batch_rows(lake: Lake, table: SourceTable, run_log: DataFrame) -> DataFrame | None:
    """What a raw table holds: the newest batch of a full table, all batches of an incremental one.

    The name of the newest batch is one small row of the run log, and the batch is a folder, so only
    that folder is listed and read. Batches that were not logged, hence not finished, do not count.
    """
    logged = flat_run_log(run_log).where((F.col("tabla") == table.name) & F.col("path").isNotNull())
    if table.mode == "full":
        newest = latest_by(logged, ["tabla"], "path", "started_at").first()
        if newest is None:
            return None
        logged = logged.where(F.col("path") == newest["path"])
    elif logged.isEmpty():
        return None
    return committed_rows(lake, table, logged)


def missing_tables(lake: Lake) -> list[str]:
    """Source tables that no run has ingested and nobody has copied, by name."""
    log = read_run_log(lake)
    seen = {r["tabla"] for r in flat_run_log(log).select("tabla").distinct().collect()} if log is not None else set()
    return sorted(n for n, t in SOURCES.items() if n not in seen and not lake.exists(lake.raw_path(t)))


def raw_rows(lake: Lake, table: SourceTable, if_missing: str = "raise") -> DataFrame:
    """The raw table: as it was last copied, or else straight from its Bronze batches.

    Bronze is columnar already, so the copy is not needed; without it nothing is written twice. A table that was never ingested is an
    error, or with ``if_missing="empty"`` has no rows.
    """
    if lake.exists(lake.raw_path(table)):
        copied = read_model(lake.spark, lake.raw_path(table), table.bronze_schema)
        return copied.select(*table.bronze_schema.names)
    log = read_run_log(lake)
    rows = batch_rows(lake, table, log) if log is not None else None
    if rows is None and log is not None and not flat_run_log(log).where(F.col("tabla") == table.name).isEmpty():
        return lake.spark.createDataFrame([], table.bronze_schema)  # ingested, but empty so far
    if rows is None and if_missing == "empty":
        return lake.spark.createDataFrame([], table.bronze_schema)
    if rows is None:
        raise LookupError(f"{table.name} was never ingested")
    return rows


def load_raw(ingestion: Ingestion, table: SourceTable) -> dict[str, Any]:
    """Replace the raw table; without any batch, leave it as it is and say so."""
    log = ingestion.run_log()
    rows = batch_rows(ingestion.lake, table, log) if log is not None else None
    if rows is None:
        return {"table": table.name, "status": "sin_datos", "rows": None, "path": None}
    observed = Observation()
    path = ingestion.lake.raw_path(table)
    write_model(rows.observe(observed, F.count(F.lit(1)).alias("rows")), path)
    return {"table": table.name, "status": "ok", "rows": observed.get["rows"], "path": path}
