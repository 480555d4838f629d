"""Hot keys: right results, and plans that split or shrink them."""

from __future__ import annotations

import statistics
from contextlib import contextmanager
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cauce.plans import gold, rejects, silver
from cauce.queries import CONTEXT, Tables
from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS
from tests.frames import raw


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def no_broadcast(spark):
    """Joins as on tables too large to broadcast, with limits low enough for test data."""
    return settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="0",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__files__maxPartitionBytes="16KB", spark__sql__files__openCostInBytes="0",
    )


def stored(df, name):
    """The table written and read back, so that plans start at a scan."""
    path = f"{df.sparkSession.conf.get('spark.checkpoint.dir')}/{name}"
    df.repartition(6).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 movements: a third are copies of one, a third belong to one client, half of these to one day."""
    start = date(2025, 1, 1)
    base = raw(spark, MOVIMIENTOS, {})
    n = F.col("id")
    kind = F.when(n < 1000, 0).when(n < 1500, 1).when(n < 2000, 2).otherwise(3)
    rows = spark.range(3000).repartition(6).withColumn("kind", kind).select(
        F.when(n < 1000, "copy").otherwise(F.concat(F.lit("M"), n.cast("string"))).alias("id_mov"),
        F.when(F.col("kind") < 3, "CLI000001").otherwise(F.concat(F.lit("CLI"), F.lpad((n % 50).cast("string"), 6, "0")))
        .alias("id_cli"),
        F.when(F.col("kind") <= 1, F.lit(start)).otherwise(F.date_add(F.lit(start), (n % 90).cast("int"))).alias("fec_mov"),
        F.when(n < 1000, 7).otherwise(n % 997 + 1).cast("decimal(16,2)").alias("vr_mov"))
    return stored(rows.crossJoin(base.drop("id_mov", "id_cli", "fec_mov", "vr_mov")).select(base.columns), "hot")


@pytest.fixture(scope="module")
def dims(spark, ctx):
    clients = raw(spark, CLIENTES, *[{"id_cli": f"CLI{i:06d}"} for i in range(45)])
    return stored(silver.stg_clientes(clients, ctx), "c"), stored(silver.stg_productos(raw(spark, PRODUCTOS, {})), "p")


def test_statistics_equal_brute_force(spark, ctx, hot, dims):
    rows = {r["id_mov"]: r for r in hot.collect() if r["id_cli"] < "CLI000045"}.values()
    by_client: dict = {}
    for r in rows:
        by_client.setdefault(r["id_cli"], []).append(r)
    expected = {}
    for r in rows:
        window = [float(o["vr_mov"]) for o in by_client[r["id_cli"]]
                  if timedelta(1) <= r["fec_mov"] - o["fec_mov"] <= timedelta(30)]
        expected[r["id_mov"]] = (statistics.fmean(window) if window else None,
                                 statistics.stdev(window) if len(window) > 1 else None)
    with no_broadcast(spark):
        got = {r["id_mov"]: (r["promedio_movil_30d"], r["stddev_movil_30d"]) for r in
               silver.stg_movimientos(hot, *dims, ctx).collect()}
    assert got.keys() == expected.keys() and len(got) > 1800
    for key, pair in expected.items():
        for mine, theirs in zip(got[key], pair):
            assert mine == (None if theirs is None else pytest.approx(theirs, rel=1e-9)), key


def test_movement_plan(spark, ctx, hot, dims):
    with no_broadcast(spark):
        plan = final_plan(silver.stg_movimientos(hot, *dims, ctx))
    # copies shrink before the shuffle, the shuffle serves both consumers, the hot day is split
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert "ReusedExchange" in plan
    assert "skew=true" in plan
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_missing_keys(spark, ctx, dims):
    """Half of the loans without a client: rejected one by one, in a join that splits them."""
    base = raw(spark, OBLIGACIONES, {})
    n = F.col("id")
    loans = spark.range(8000).repartition(6).select(
        F.concat(F.lit("O"), n.cast("string")).alias("id_oblig"),
        F.when(n >= 4000, F.concat(F.lit("CLI"), F.lpad((n % 50).cast("string"), 6, "0"))).alias("id_cli"),
    ).crossJoin(base.drop("id_oblig", "id_cli")).select(base.columns)
    loans = stored(loans, "loans")
    with no_broadcast(spark):
        found = rejects.err_calidad_datos(
            raw(spark, MOVIMIENTOS), loans, raw(spark, COMISIONES), *dims, ctx).where("tabla = 'TB_OBLIGACIONES'")
        plan = final_plan(found)
        assert found.count() == 4000 + 400 and found.where("motivo is null").count() == 4000
        assert silver.stg_obligaciones(loans, *dims, ctx).count() == 3600
    assert "skew=true" in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_path, ctx, dims):
    path = str(tmp_path / "m")
    raw(spark, MOVIMIENTOS, {}).write.parquet(path)
    movements = spark.read.parquet(path)
    income = gold.interest_income(
        silver.valid_movements(movements, *dims, ctx), gold.dim_productos(dims[1]))
    plan = formatted(income)
    assert "GreaterThanOrEqual(fec_mov,2015-01-01)" in plan and "In(tip_mov" in plan
    narrow = formatted(rejects.orphan_rows(movements, MOVIMIENTOS, "id_mov", *dims))
    assert "ReadSchema: struct<id_mov:string,id_cli:string,cod_prod:string>" in narrow


def test_no_query_crosses_or_leaves_the_jvm(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    for df in (t.movimientos, t.rentabilidad, t.errores, t.kpi, t.transacciones):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert CONTEXT.as_of == date(2025, 12, 31)
