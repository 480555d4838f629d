"""Volume anomalies, the success summary and failures, as rows of an event table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cauce.functions.numbers import percentage

if TYPE_CHECKING:
    from cauce.sources.lake import Lake

# The volume rule and the event names.
HISTORY_RUNS, MIN_VALUES, MAX_CHANGE_PERCENT = 7, 3, 30
VOLUME_ANOMALY, SUCCESS_SUMMARY, TASK_FAILURE = "VOLUME_ANOMALY", "PIPELINE_SUCCESS_SUMMARY", "TASK_FAILURE"
NO_DATA = "NO_DATA"

VOLUME_SCHEMA = "batch_id string, started_at string, tabla string, rows bigint"
EVENT_SCHEMA = "event_type string, created_at string, details map<string, string>"


def newest_runs(log: DataFrame, runs: int, until: str | None = None) -> DataFrame:
    """The newest runs of a log, up to a start time. Runs that loaded nothing are runs as well."""
    known = log.select("batch_id", "started_at").distinct()
    if until is not None:
        known = known.where(F.col("started_at") <= until)
    return known.orderBy(F.desc("started_at"), "batch_id").limit(runs)


def _numbered_runs(log: DataFrame) -> DataFrame:
    """Runs numbered by start. One row per run, so the single window over them stays small."""
    runs = log.select("batch_id", "started_at").distinct()
    number = F.row_number().over(Window.orderBy("started_at", "batch_id"))
    return runs.withColumn("_run", number)


def latest_volumes(volumes: DataFrame, runs: int = HISTORY_RUNS, log: DataFrame | None = None) -> DataFrame:
    """The volumes of the newest runs; a table that a run did not load has no row for it.

    ``log`` has a row for every run, also for those that loaded no table; without it, only runs with
    a volume are known.
    """
    newest = newest_runs(volumes if log is None else log, runs)
    return volumes.join(newest.select("batch_id", "started_at"), ["batch_id", "started_at"], "left_semi")


def volume_history(volumes: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Per run and table: how many of the seven runs before it loaded the table, and how much.

    Runs are the frame, not rows: a table absent from some of those runs has fewer values. ``log`` as
    in ``latest_volumes``.
    """
    before = Window.partitionBy("tabla").orderBy("_run").rangeBetween(-HISTORY_RUNS, -1)
    return volumes.join(_numbered_runs(volumes if log is None else log), ["batch_id", "started_at"]).select(
        "batch_id", "started_at", "tabla", "rows",
        F.count("rows").over(before).alias("_values"),
        F.sum("rows").over(before).alias("_total"),
    )


def volume_anomalies(volumes: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Loads whose volume is more than 30 % off the mean of the runs before.

    Needs three values and a mean above zero. Empty loads are not judged, but count in later means.
    """
    change = F.abs(F.col("rows") * F.col("_values") - F.col("_total"))
    judged = volume_history(volumes, log).where(
        (F.col("rows") > 0) & (F.col("_values") >= MIN_VALUES) & (F.col("_total") > 0)
    )
    return judged.where(change * 100 > F.col("_total") * MAX_CHANGE_PERCENT).select(
        "batch_id", "started_at", "tabla", F.col("rows").alias("current_rows"),
        F.round(F.col("_total").cast("decimal(20,0)") / F.col("_values"), 2).alias("avg_last_7_runs"),
        percentage(change, F.col("_total")).alias("pct_diff"),
    )


def volume_events(anomalies: DataFrame, created_at: str) -> DataFrame:
    parts = [("table", "tabla"), ("current_rows",) * 2, ("avg_last_7_runs",) * 2, ("pct_diff",) * 2]
    details = F.create_map(*[x for key, c in parts for x in (F.lit(key), F.col(c).cast("string"))])
    return anomalies.select(
        F.lit(VOLUME_ANOMALY).alias("event_type"), F.lit(created_at).alias("created_at"), details.alias("details")
    )


def append_events(lake: Lake, events: DataFrame) -> None:
    events.coalesce(1).write.mode("append").parquet(lake.path("ops", "pipeline_events"))


def append_event(lake: Lake, event_type: str, created_at: str, **details: object) -> None:
    row = (event_type, created_at, {k: str(v) for k, v in details.items()})
    append_events(lake, lake.spark.createDataFrame([row], EVENT_SCHEMA))


def pipeline_summary(
    movimientos: DataFrame, transacciones: DataFrame, cartera: DataFrame, errores: DataFrame
) -> DataFrame:
    """One row with the sizes of the layers and of the rejection table."""
    tables: Mapping[str, DataFrame] = {
        "silver_movimientos": movimientos, "gold_transacciones": transacciones, "gold_cartera": cartera,
        "quality_errors": errores,
    }
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name, df in tables.items()],
    )
    return counts.agg(*[F.sum(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables])
