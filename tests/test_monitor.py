"""The volume rule and the event rows."""

from __future__ import annotations

from decimal import Decimal as D

from cauce.plans import monitor
from cauce.sources.lake import Lake


def volumes(spark, *per_run):
    """One run per argument: its volume, or None when the table was not loaded."""
    rows = [(f"b{n}", f"2025-01-{n + 1:02d}T00:00:00+00:00", "t", v) for n, v in enumerate(per_run) if v is not None]
    # another table keeps every run in the log
    rows += [(f"b{n}", f"2025-01-{n + 1:02d}T00:00:00+00:00", "other", 1) for n in range(len(per_run))]
    return spark.createDataFrame(rows, monitor.VOLUME_SCHEMA)


def anomalies(spark, *per_run):
    found = monitor.volume_anomalies(volumes(spark, *per_run)).where("tabla = 't'").orderBy("started_at").collect()
    return [(r["batch_id"], r["avg_last_7_runs"], r["pct_diff"]) for r in found]


def test_published_example(spark):
    """10,000 rows against a mean of 5,929.43 are 68.65 % off."""
    history = [10000] * 3 + [3000] * 2 + [2506, 3000]
    got = anomalies(spark, *history, 10000)
    assert got[-1] == ("b7", D("5929.43"), D("68.65"))


def test_needs_three_values(spark):
    assert anomalies(spark, 10, 10, 100) == []
    assert anomalies(spark, 10, 10, 10, 100) == [("b3", D("10.00"), D("900.00"))]


def test_limit_is_exclusive(spark):
    assert anomalies(spark, 10, 10, 10, 13) == []
    assert anomalies(spark, 10, 10, 10, 7) == []
    assert [a[0] for a in anomalies(spark, 100, 100, 100, 131)] == ["b3"]


def test_empty_loads(spark):
    """They raise no alert themselves, but lower the mean; a mean of zero is not compared with."""
    assert anomalies(spark, 10, 10, 10, 0, 10) == [("b4", D("7.50"), D("33.33"))]
    assert anomalies(spark, 0, 0, 0, 5) == []


def test_frame_is_seven_runs_not_seven_rows(spark):
    runs = [1000] * 3 + [None] * 5 + [10, 10]
    assert anomalies(spark, *runs) == []


def test_runs_that_loaded_nothing_are_runs(spark):
    """After seven runs without any table there is nothing to compare with."""
    log = spark.createDataFrame([(f"b{n}", f"2025-01-{n + 1:02d}T00:00:00+00:00") for n in range(11)],
                                "batch_id string, started_at string")
    known = volumes(spark, *[10] * 3, *[None] * 7, 1000).where("tabla = 't'")
    assert not monitor.volume_anomalies(known).isEmpty()
    assert monitor.volume_anomalies(known, log).isEmpty()
    assert [r["rows"] for r in monitor.latest_volumes(known, 7, log).collect()] == [1000]


def test_latest_volumes(spark):
    got = monitor.latest_volumes(volumes(spark, *range(9))).where("tabla = 't'").collect()
    assert sorted(r["rows"] for r in got) == [2, 3, 4, 5, 6, 7, 8]


def test_events(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    found = monitor.volume_anomalies(volumes(spark, 10, 10, 10, 100)).where("tabla = 't'")
    monitor.append_events(lake, monitor.volume_events(found, "now"))
    monitor.append_event(lake, monitor.TASK_FAILURE, "now", task_name="gold")
    events = {r["event_type"]: r["details"] for r in lake.read("ops", "pipeline_events").collect()}
    assert events[monitor.VOLUME_ANOMALY] == {
        "table": "t", "current_rows": "100", "avg_last_7_runs": "10.00", "pct_diff": "900.00"}
    assert events[monitor.TASK_FAILURE] == {"task_name": "gold"}
