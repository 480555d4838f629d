"""Bronze runs, raw tables, files and snapshots on disk."""

from __future__ import annotations

import threading
from datetime import date, datetime, timezone
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cauce.plans import gold, ingest, layers
from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, PRODUCTOS, SOURCES
from cauce.operators.late import seen_filter, uncommitted
from cauce.operators.ranges import Bounds, Part
from cauce.sources import files, jdbc
from cauce.sources.lake import Lake, Layout, merge_snapshot, read_model, write_model
from cauce.streaming.raw_feed import append_new_batches
from tests.frames import DEFAULTS, raw

AT = [datetime(2025, 1, 9, 1 + h, tzinfo=timezone.utc) for h in range(5)]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def movements(spark, *days):
    rows = [{"id_mov": f"M{d}", "fec_mov": d} for d in days]
    return SOURCES[MOVIMIENTOS].project(raw(spark, MOVIMIENTOS, *rows))


def test_incremental_runs(spark, lake):
    job = ingest.Ingestion(lake, "core", {MOVIMIENTOS: SOURCES[MOVIMIENTOS]})
    source = {"df": movements(spark, date(2025, 1, 1), date(2025, 1, 2))}
    run = lambda n: job.run(lambda table, last: source["df"], f"b{n}", AT[n])
    run(0)
    assert job.watermark(MOVIMIENTOS) == date(2025, 1, 2)
    run(1)
    # rows that arrive late on the day of the watermark are lost, by the strict comparison
    source["df"] = movements(spark, date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 2), date(2025, 1, 3))
    run(2)
    assert job.watermark(MOVIMIENTOS) == date(2025, 1, 3)
    log = {r["batch_id"]: r for r in ingest.flat_run_log(job.run_log()).collect()}
    assert [log[f"b{n}"]["rows"] for n in range(3)] == [2, 0, 1]
    assert log["b1"]["path"] is None and log["b0"]["size_bytes"] > 0
    stored = lake.bronze(SOURCES[MOVIMIENTOS])
    assert {tuple(r) for r in stored.select("year", "month", "day", "batch_id", "source_system", "ingestion_ts").collect()
            } == {("2025", "01", "09", f"b{n}", "core", AT[n].isoformat()) for n in (0, 2)}
    assert ingest.load_raw(job, SOURCES[MOVIMIENTOS])["rows"] == 3


def test_tables_of_a_run_are_read_beside_each_other(spark, lake):
    """Each of two tables waits for the other; a third that fails is recorded."""
    names = (CLIENTES, PRODUCTOS, COMISIONES)
    job, both = ingest.Ingestion(lake, "core", {n: SOURCES[n] for n in names}), threading.Barrier(2)

    def read(table, _last):
        if table.name == COMISIONES:
            raise ValueError("gone")
        both.wait(20)
        return table.project(raw(spark, table.name, {}))

    with pytest.raises(ingest.IngestionFailed, match="1 table"):
        job.run(read, "b0", AT[0])
    entry = job.run_log().first()
    assert {name: t["rows"] for name, t in entry["tables"].items()} == {CLIENTES: 1, PRODUCTOS: 1}
    assert [(e["table"], "gone" in e["error"]) for e in entry["errors"]] == [(COMISIONES, True)]


def test_overlap_takes_late_rows_once(spark, lake):
    """Late rows of the watermark's day, further copies of a row, and dates in the future, over four runs and a repetition."""
    table = SOURCES[MOVIMIENTOS]
    job = ingest.Ingestion(lake, "core", {MOVIMIENTOS: table}, overlap_days=3)
    future = date(2031, 1, 1)
    source = [[date(2025, 1, 1), date(2025, 1, 2), future]]
    source += [[*source[0], date(2025, 1, 2), date(2025, 1, 2)]]  # two more copies of one row, on the mark's day
    source += [[*source[1], date(2025, 1, 1), date(2025, 1, 8), future]]
    source += [[*source[2], date(2025, 1, 3)]]  # later than the overlap
    marks = [date(2025, 1, 2)] * 2 + [date(2025, 1, 8)] * 2
    counts = []
    for n, days in enumerate(source):
        job.run(lambda t, last, days=days: movements(spark, *days), f"b{n}", AT[n])
        assert job.watermark(MOVIMIENTOS) == marks[n]
        counts.append(ingest.raw_rows(lake, table).count())
    assert counts == [3, 5, 8, 8]
    job.run(lambda t, last: movements(spark, *source[3]), "b3", AT[4])
    assert ingest.raw_rows(lake, table).count() == 8


def test_overlap_of_an_empty_run(spark, lake):
    job = ingest.Ingestion(lake, "core", {MOVIMIENTOS: SOURCES[MOVIMIENTOS]}, overlap_days=3)
    job.run(lambda t, last: movements(spark, date(2031, 1, 1)), "b0", AT[0])  # nothing to set the mark by
    assert job.watermark(MOVIMIENTOS) is None
    job.run(lambda t, last: movements(spark, date(2031, 1, 1), date(2025, 1, 1)), "b1", AT[1])
    assert job.watermark(MOVIMIENTOS) == date(2025, 1, 1) and ingest.raw_rows(lake, SOURCES[MOVIMIENTOS]).count() == 2


def test_uncommitted_rows(spark):
    """By all columns, missing values too, copy by copy, for a filter that is full and one that is not."""
    old = [(i, None if i % 3 else "x", i % 7) for i in range(3000)] + [(1, None, 1)]
    new = [(i, None if i % 3 else "x", i % 7) for i in range(1500, 4500)] + [(1, None, 1)] * 3 + [(None, None, None)] * 2
    schema = "a int, b string, c int"
    rows, committed = spark.createDataFrame(new, schema), spark.createDataFrame(old, schema)
    got = sorted(map(tuple, uncommitted(rows, committed, ["a", "b", "c"]).collect()), key=str)
    want = [(i, None if i % 3 else "x", i % 7) for i in range(3000, 4500)] + [(1, None, 1), (None, None, None), (None, None, None)]
    assert got == sorted(want, key=str)
    assert uncommitted(rows, committed.limit(0), ["a", "b", "c"]).count() == len(new)
    bits, buckets = seen_filter(committed, ["a", "b", "c"])
    assert buckets == 2 and bits.count() == 2


def test_failed_table_does_not_stop_others(spark, lake):
    job = ingest.Ingestion(lake, "core", {n: SOURCES[n] for n in (PRODUCTOS, CLIENTES)})

    def read(table, last):
        if table.name == PRODUCTOS:
            raise OSError("connection lost")
        return raw(spark, CLIENTES, {}).drop(*ingest.with_audit(spark.range(1), "", "", AT[0]).columns[1:])

    with pytest.raises(ingest.IngestionFailed, match=PRODUCTOS):
        job.run(read, "b0", AT[0])
    entry = job.run_log().first()
    assert entry["success"] is False and list(entry["tables"]) == [CLIENTES]
    assert entry["errors"][0]["table"] == PRODUCTOS and "connection lost" in entry["errors"][0]["error"]
    assert ingest.load_raw(job, SOURCES[PRODUCTOS])["status"] == "sin_datos"
    assert ingest.load_raw(job, SOURCES[CLIENTES])["rows"] == 1


@pytest.mark.parametrize("dies_in", ["write", "volume", "log"])
def test_no_row_is_lost_after_a_failed_run(spark, lake, monkeypatch, dies_in):
    """Whatever step fails, raw equals the source after the next run, also if that repeats the batch id."""
    table = SOURCES[MOVIMIENTOS]
    job = ingest.Ingestion(lake, "core", {MOVIMIENTOS: table})
    days = [date(2025, 1, 1 + n) for n in range(5)]
    job.run(lambda t, last: movements(spark, days[0]), "b0", AT[0])

    def broken(*args, **kwargs):
        raise OSError("store is down")

    target = {"write": (ingest.Lake, "size_of"), "volume": (ingest.monitor, "append_events"),
              "log": (ingest.Ingestion, "_append")}[dies_in]
    with monkeypatch.context() as patch:
        patch.setattr(*target, broken)
        try:
            job.run(lambda t, last: movements(spark, *days[:3]), "b1", AT[1])
        except (OSError, ingest.IngestionFailed):
            assert dies_in != "volume"
    if dies_in == "volume":
        assert lake.read("bronze", "_step_failures").first()["error"] == "store is down"
    for batch in ("b1", "b2"):
        job.run(lambda t, last: movements(spark, *days), batch, datetime(2025, 1, 11, tzinfo=timezone.utc))
    rows = ingest.raw_rows(lake, table)
    assert sorted(r["fec_mov"] for r in rows.collect()) == days
    assert job.watermark(MOVIMIENTOS) == days[-1]


def test_source_that_is_empty_from_the_start(spark, lake):
    table = SOURCES[MOVIMIENTOS]
    with pytest.raises(LookupError):
        ingest.raw_rows(lake, table)
    assert ingest.raw_rows(lake, table, if_missing="empty").isEmpty() and ingest.missing_tables(lake) == sorted(SOURCES)
    ingest.Ingestion(lake, "core", {MOVIMIENTOS: table}).run(lambda t, last: movements(spark), "b0", AT[0])
    assert MOVIMIENTOS not in ingest.missing_tables(lake)
    rows = ingest.raw_rows(lake, table)
    assert rows.isEmpty() and rows.columns == table.bronze_schema.names


def test_a_source_that_never_came_keeps_the_run_alive(spark, lake, ctx):
    tables = {n: t for n, t in SOURCES.items() if n != COMISIONES}
    job = ingest.Ingestion(lake, "core", tables)
    warehouse = layers.run_pipeline(job, lambda table, last: table.project(raw(spark, table.name, {})) if table.name in DEFAULTS
                                    else spark.createDataFrame([], table.schema), ctx)
    assert warehouse["stg_comisiones"].isEmpty() and warehouse["fact_rentabilidad_cliente"].count() == 1
    events = lake.read("ops", "pipeline_events").where("event_type = 'NO_DATA'").collect()
    assert [r["details"] for r in events] == [{"table": COMISIONES, "status": "sin_datos"}]


def test_feed_that_overlaps_a_run(spark, lake):
    """A batch whose files the feed could see before the run was logged still comes in."""
    table = SOURCES[MOVIMIENTOS]
    job = ingest.Ingestion(lake, "core", {MOVIMIENTOS: table})
    job.run(lambda t, last: movements(spark, date(2025, 1, 1)), "b0", AT[0])
    append_new_batches(lake, table)
    late = movements(spark, date(2025, 1, 2))
    ingest.write_batch(ingest.with_audit(late, "b1", "core", AT[1]), lake.bronze_path(table), AT[1])
    append_new_batches(lake, table)
    assert ingest.raw_rows(lake, table).count() == 1
    job.run(lambda t, last: late, "b1", AT[1])
    append_new_batches(lake, table)
    assert ingest.raw_rows(lake, table).count() == 2


def test_full_table_takes_newest_batch(spark, lake):
    table = SOURCES[CLIENTES]
    job = ingest.Ingestion(lake, "core", {CLIENTES: table})
    for n, ids in enumerate((["a", "b"], ["a"])):
        job.run(lambda t, last, ids=ids: table.project(raw(spark, CLIENTES, *[{"id_cli": i} for i in ids])), f"b{n}", AT[n])
        ingest.load_raw(job, table)
    rows = read_model(spark, lake.raw_path(table)).collect()
    assert [(r["id_cli"], r["batch_id"]) for r in rows] == [("a", "b1")]


def test_repeating_a_batch_replaces_it(spark, lake):
    path = lake.bronze_path(SOURCES[MOVIMIENTOS])
    batch = ingest.with_audit(movements(spark, date(2025, 1, 1)), "b0", "core", AT[0])
    for _ in range(2):
        ingest.write_batch(batch, path, AT[0])
    assert lake.bronze(SOURCES[MOVIMIENTOS]).count() == 1


def test_streaming_feed_equals_rebuild(spark, lake, tmp_path):
    table = SOURCES[COMISIONES]
    job = ingest.Ingestion(lake, "core", {COMISIONES: table})
    other = Lake(spark, str(tmp_path / "other"))
    for n in range(3):
        fee = table.project(raw(spark, COMISIONES, {"id_comision": f"C{n}", "fec_cobro": date(2025, 1, 1 + n)}))
        job.run(lambda t, last, fee=fee: fee, f"b{n}", AT[n])
        # what a failed run left behind is not loaded, neither now nor later
        ingest.write_batch(ingest.with_audit(fee, f"failed{n}", "core", AT[n]), lake.bronze_path(table), AT[n])
        append_new_batches(lake, table)
        append_new_batches(lake, table)
    streamed = ingest.raw_rows(lake, table)
    rebuilt = ingest.batch_rows(lake, table, job.run_log())
    write_model(rebuilt, other.raw_path(table))
    stored = read_model(spark, other.raw_path(table), table.bronze_schema)
    assert streamed.count() == 3 and streamed.exceptAll(stored).isEmpty() and stored.exceptAll(streamed).isEmpty()
    with pytest.raises(ValueError):
        append_new_batches(lake, SOURCES[CLIENTES])


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
@pytest.mark.parametrize("name", [PRODUCTOS, CLIENTES, MOVIMIENTOS])
def test_round_trip(spark, tmp_path, name, kind):
    table, path = SOURCES[name], str(tmp_path / "t")
    rows = {PRODUCTOS: ({"plazo_max_meses": 12}, {"desc_prod": 'coma, "comillas"', "comision_admin": None}),
            CLIENTES: ({"num_doc": "0012"}, {"score_buro": None, "nomb_cli": "Ñandú"}), MOVIMIENTOS: ({},)}[name]
    df = table.project(raw(spark, name, *rows))
    files.write_table(df, path, table, kind)
    back = files.read_table(spark, path, table, kind)
    assert back.columns == table.columns and [f.dataType for f in back.schema] == [f.dataType for f in table.schema]
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_text_files_of_other_writers(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "cod_prod,desc_prod,tip_prod,tasa_ea,plazo_max_meses,cuota_min,comision_admin,estado_prod\n"
        "PRD001,a,RECARGA,0.0,44.0,1.5,,ACTIVO\nPRD002,b,RECARGA,0.0,,1.5,2.0,ACTIVO\n", encoding="utf-8")
    rows = files.read_table(spark, str(tmp_path / "p.csv"), SOURCES[PRODUCTOS]).orderBy("cod_prod").collect()
    assert [(r["plazo_max_meses"], r["comision_admin"]) for r in rows] == [(44, None), (None, D("2.00"))]
    (tmp_path / "q.csv").write_text(
        "cod_prod,desc_prod,tip_prod,tasa_ea,plazo_max_meses,cuota_min,comision_admin,estado_prod\n"
        'PRD001,"say ""hi"", ok",RECARGA,0.0,,1.5,,ACTIVO\nPRD002,"two\nlines",RECARGA,0.0,,1.5,,ACTIVO\n')
    rows = files.read_table(spark, str(tmp_path / "q.csv"), SOURCES[PRODUCTOS], quoted_breaks=True).collect()
    assert sorted(r["desc_prod"] for r in rows) == ['say "hi", ok', "two\nlines"]
    (tmp_path / "c.json").write_text(
        '[\n {"id_cli": "a", "num_doc": "007", "score_buro": 700.0, "fec_nac": "1990-01-02"},\n {"id_cli": "b"}\n]')
    rows = files.read_table(spark, str(tmp_path / "c.json"), SOURCES[CLIENTES], "json_array").orderBy("id_cli").collect()
    assert (rows[0]["num_doc"], rows[0]["score_buro"], rows[0]["fec_nac"]) == ("007", 700, date(1990, 1, 2))
    with pytest.raises(ValueError, match="unsupported format"):
        files.read_table(spark, str(tmp_path), SOURCES[CLIENTES], "xml")


def test_jdbc_conditions():
    parts = jdbc.part_predicates([Part((Bounds("id_mov", None, "M'2"),), 1), Part((Bounds("id_mov", "M'2"), Bounds("fec_mov", missing=True)), 1)],
                                 jdbc.newer_than("fec_mov", date(2025, 1, 2)))
    assert parts[0] == "(id_mov COLLATE \"C\" < 'M''2') AND fec_mov > DATE '2025-01-02'"
    assert parts[1] == "(id_mov COLLATE \"C\" >= 'M''2' AND fec_mov IS NULL) AND fec_mov > DATE '2025-01-02'"
    assert jdbc.newer_than("fec_mov", None) is None
    assert jdbc.sketch_query(SOURCES[CLIENTES], ["id_cli"], None, 100) == "(SELECT id_cli FROM tb_clientes_core) sketch"
    assert jdbc.sketch_query(SOURCES[COMISIONES], ["fec_cobro", "id_comision"], "fec_cobro > DATE '2025-01-02'") == (
        "(SELECT fec_cobro, id_comision FROM tb_comisiones_log TABLESAMPLE SYSTEM (1) REPEATABLE (7) "
        "WHERE fec_cobro > DATE '2025-01-02') sketch")


def test_bulk_load_rows(spark):
    rows = spark.createDataFrame([("P1", "", "x", "1.5", None, "", "0", "")], ", ".join(f"{c} string" for c in SOURCES[PRODUCTOS].columns))
    got = jdbc.as_declared(rows.withColumn("cuota_min", F.lit(None).cast("string")), SOURCES[PRODUCTOS])
    assert got.schema.simpleString() == SOURCES[PRODUCTOS].schema.simpleString()
    assert tuple(got.first()) == ("P1", None, "x", D("1.50"), None, None, D("0.00"), None)


def test_snapshot_reruns(spark, lake):
    path = lake.path("gold", "kpi")
    schema = "fecha_corte date, cod_prod string, cod_segmento string, ciudad string, n int"

    def put(number, *rows):
        new = spark.createDataFrame([(date(2025, 1, d), *r) for d, *r in rows], schema)
        merge_snapshot(lake, new, path, "fecha_corte", ("fecha_corte", "cod_prod", "cod_segmento", "ciudad"),
                       lake.path("staging", str(number)))
        return sorted(((r["fecha_corte"].day, r["cod_prod"], r["n"]) for r in
                       spark.read.schema(schema).parquet(path).collect()))

    assert put(1, (1, "p", None, "c", 1), (1, "q", "s", "c", 2)) == [(1, "p", 1), (1, "q", 2)]
    assert put(2, (2, "p", None, "c", 3)) == [(1, "p", 1), (1, "q", 2), (2, "p", 3)]
    # a rerun replaces the rows it brings, also those with a missing key, and keeps the others
    assert put(3, (1, "p", None, "c", 9)) == [(1, "p", 9), (1, "q", 2), (2, "p", 3)]


def test_layout_splits_a_hot_date(spark, lake):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 3000, F.lit(20250101)).otherwise(20250101 + F.col("id") % 5).alias("day"), "id")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    try:
        write_model(rows, lake.path("gold", "t"), Layout("day", ("id",)))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = lake.read("gold", "t")
    hot_files = stored.where("day = 20250101").select("_metadata.file_path").distinct().count()
    assert stored.count() == 4000 and hot_files > 1


def test_failed_rebuild_keeps_the_table(spark, lake):
    path = lake.path("gold", "t")
    write_model(spark.range(5).withColumn("day", F.lit(1)), path, Layout("day"))
    with pytest.raises(Exception, match="lost"):
        write_model(spark.range(3).select("id", F.raise_error(F.lit("lost")).cast("int").alias("day")), path, Layout("day"))
    assert lake.read("gold", "t").count() == 5
    write_model(spark.range(2).withColumn("day", F.lit(1)), path, Layout("day"))
    assert lake.read("gold", "t").count() == 2


def test_readers_see_whole_versions(spark, lake, monkeypatch):
    """A reader that has begun goes on with its version; a writer that dies anywhere leaves the old one; nothing is renamed."""
    path = lake.path("gold", "t")
    write_model(spark.range(3), path)
    before = lake.read("gold", "t")
    write_model(spark.range(4), path)
    assert before.count() == 3 and lake.read("gold", "t").count() == 4
    for step in ("mark", "names"):  # before the pointer is there
        with monkeypatch.context() as broken:
            broken.setattr(Lake, step, lambda *a, **k: (_ for _ in ()).throw(OSError("store is down")))
            with pytest.raises(OSError):
                write_model(spark.range(9), path)
        assert lake.read("gold", "t").count() == 4
    with monkeypatch.context() as broken:  # after it: the new version counts, though nothing was cleaned up
        broken.setattr(Lake, "remove", lambda *a, **k: (_ for _ in ()).throw(OSError("store is down")))
        with pytest.raises(OSError):
            write_model(spark.range(5), path)
    assert lake.read("gold", "t").count() == 5
    for n in (6, 7):
        write_model(spark.range(n), path)
    assert lake.read("gold", "t").count() == 7 and len([x for x in lake.names(path) if x.startswith("v-")]) == 2
    assert len(lake.names(f"{path}/_pointers")) == 2


def test_empty_partitioned_table_can_be_read(spark, lake):
    write_model(spark.createDataFrame([], "v int, day date"), lake.path("gold", "e"), Layout("day", ("v",)))
    back = lake.read("gold", "e")
    assert back.isEmpty() and back.dtypes == [("v", "int"), ("day", "date")]


def test_unknown_stage(lake, ctx):
    with pytest.raises(ValueError, match="stage must be"):
        layers.Warehouse(lake, ctx).run_layer("bronze")


def test_failures_are_recorded(spark, lake, ctx):
    def read(table, last):
        raise OSError("no source")

    with pytest.raises(ingest.IngestionFailed):
        layers.run_pipeline(ingest.Ingestion(lake, "core"), read, ctx)
    event = lake.read("ops", "pipeline_events").first()
    assert (event["event_type"], event["details"]["task_name"]) == ("TASK_FAILURE", "bronze")


def test_models_go_to_their_layer():
    assert layers.MODELS["stg_clientes"].target_layer == "silver" and layers.MODELS["dim_canal"].target_layer == "gold"
    assert len(layers.ALL_TESTS) == 43 and len(layers.MODELS) == 16
    assert set(gold.rules.SEGMENT_LABELS) == {"BAS", "STD", "PRM", "ELT"}
