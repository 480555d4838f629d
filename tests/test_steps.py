"""Models made in steps: the rows of one plan, without the shuffles of all steps on disk together."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cauce.plans import silver
from cauce.plans.layers import Warehouse
from cauce.queries import Tables
from cauce.schemas import CLIENTES, MOVIMIENTOS, PRODUCTOS
from cauce.sources.lake import Lake, Layout, merge_snapshot, write_model
from cauce.sources.steps import CLEANUP, kept_in, shuffles_removed
from tests.frames import raw
from tests.test_skew import final_plan, formatted, no_broadcast, settings


@pytest.fixture(scope="module")
def dims(spark, ctx):
    clients = silver.stg_clientes(raw(spark, CLIENTES, {}, {"id_cli": "CLI000002"}), ctx)
    return clients, silver.stg_productos(raw(spark, PRODUCTOS, {}, {"cod_prod": "PRD002"}, {"cod_prod": None}))


@pytest.fixture(scope="module")
def movements(spark):
    """Days of two clients; copies, a null key of every kind, unknown products and clients, bad dates and amounts."""
    rows = [{"id_mov": f"M{i}", "id_cli": f"CLI00000{i % 2 + 1}", "cod_prod": f"PRD00{i % 3 + 1}", "fec_mov": date(2025, 3, 1 + i % 20),
             "vr_mov": Decimal(i * i % 37 + 1)} for i in range(60)]
    odd = [{"id_mov": "N1", "cod_prod": None}, {"id_mov": None}, {"id_mov": "N2", "id_cli": None}, {"id_mov": "N3", "id_cli": "CLIX"},
           {"id_mov": "N4", "fec_mov": None}, {"id_mov": "N5", "fec_mov": date(2031, 1, 1)}, {"id_mov": "N6", "vr_mov": Decimal(-1)},
           {"id_mov": "N7", "vr_mov": None}, {"id_mov": "N8", "cod_prod": "PRD009"}, {"id_mov": "N9", "num_cuenta": None, "hra_mov": None}]
    copies = [{**r, "ingestion_ts": "2025-12-02T00:00:00+00:00", "vr_mov": Decimal(500)} for r in rows[::7]] + rows[::5] + odd[:1]
    return raw(spark, MOVIMIENTOS, *rows, *odd, *copies)


def test_steps_give_the_rows_of_one_plan(spark, ctx, dims, movements):
    want = silver.stg_movimientos(movements, *dims, ctx).collect()
    assert 30 < len(want) < 60
    got = silver.stg_movimientos_in_steps(movements, *dims, ctx, kept_in(spark, "steps")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    with no_broadcast(spark):  # also where the missing products are too many for a broadcast
        again = silver.stg_movimientos_in_steps(movements, *dims, ctx, kept_in(spark, "steps"))
        assert sorted(map(str, again.collect())) == sorted(map(str, want))
    nothing = silver.stg_movimientos_in_steps(movements.limit(0), *dims, ctx, kept_in(spark, "steps"))
    assert nothing.isEmpty()


def test_wide_rows_are_shuffled_once_after_their_copies_have_gone(spark):
    """By client and day; neither by product nor by movement."""
    t = Tables(spark, "/root/testdata/sf0.001")
    plan = formatted(t.movimientos_por_pasos)
    dealt = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert len(dealt) == 2 and all("id_cli" in line and "fec_mov" in line for line in dealt)
    assert "WindowGroupLimit" not in plan
    # plans that read no statistics compute none, and remove no copies again either
    narrow = formatted(t.movimientos.select("id_mov"))
    assert "WindowGroupLimit" not in narrow and "functions=[sum(" not in narrow and "partial_sum(" not in narrow


def test_a_hot_day_is_still_split(spark, ctx, dims, tmp_path):
    n = F.col("id")
    base = raw(spark, MOVIMIENTOS, {}).drop("id_mov", "fec_mov")
    rows = spark.range(3000).repartition(6).select(
        F.concat(F.lit("M"), n.cast("string")).alias("id_mov"), F.date_add(F.lit(date(2025, 1, 1)), F.when(n < 1500, 0).otherwise(n % 90).cast("int")).alias("fec_mov"))
    rows.crossJoin(base).select(raw(spark, MOVIMIENTOS, {}).columns).write.parquet(str(tmp_path / "m"))
    movements = spark.read.parquet(str(tmp_path / "m"))
    with no_broadcast(spark), settings(spark, spark__sql__autoBroadcastJoinThreshold="10KB"):  # room for products that are missing
        found = silver.stg_movimientos_in_steps(movements, *dims, ctx, kept_in(spark, "steps"))
        assert "skew=true" in final_plan(found)
    assert found.count() == 3000


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    def rows():
        return spark.range(1000).groupBy((F.col("id") % 9).alias("k")).agg(F.sum("id").alias("s"), F.lit(date(2025, 1, 1)).alias("day"))
    before, setting = _shuffle_files(spark), spark.conf.get(CLEANUP, None)
    write_model(rows(), str(tmp_path / "model"))
    write_model(rows(), str(tmp_path / "dated"), Layout("day", ("k",)))
    for _ in range(2):
        merge_snapshot(Lake(spark, str(tmp_path)), rows(), str(tmp_path / "snapshot"), "day", ("k",), str(tmp_path / "staging"))
    assert kept_in(spark, "some")(rows(), "sums").count() == 9
    left = {name.split("_")[1] for name in _shuffle_files(spark) - before}
    assert len(left) <= 1  # that of the count
    assert spark.conf.get(CLEANUP, None) == setting


def test_the_setting_is_put_back_after_the_last_of_several_writers(spark):
    before = spark.conf.get(CLEANUP, None)
    with shuffles_removed(spark):
        with pytest.raises(ValueError), shuffles_removed(spark):
            raise ValueError
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP, None) == before


def test_steps_of_a_model_go_with_its_end(spark, ctx, tmp_path):
    w = Warehouse(Lake(spark, str(tmp_path)), ctx)
    assert w.kept("dim_canal")(spark.range(3), "x").count() == 3
    w.build("dim_canal")
    assert not w.lake.names(w.lake.path("steps", "dim_canal")) and w["dim_canal"].count() == 5
