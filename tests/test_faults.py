"""Controlled defects: exact numbers, reproducible choice, and what the rules make of them."""

from __future__ import annotations

import hashlib
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from cauce.operators import faults, sampling
from cauce.operators.sampling import exact_sample
from cauce.plans import rejects, silver
from cauce.plans.fault_run import inject, inject_all
from cauce.plans.ingest import with_audit
from cauce.queries import Tables
from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS
from cauce.sources.driver_tables import BATCHES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("share", [0.0, 0.001, 0.3, 1.0])
def test_sample_is_exact_and_complete(spark, share):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (F.col("id") % 7).alias("v"))
    sample = exact_sample(df, share, "s")
    ranks = sorted(r["_rank"] for r in sample.picked.collect())
    assert ranks == list(range(1, int(5000 * share) + 1))
    whole = sample.near.select("k", "v").unionByName(sample.far)
    assert whole.count() == 5000 and whole.exceptAll(df).isEmpty()


@pytest.mark.parametrize("share", [0.05, 0.4, 0.9])
def test_sample_with_a_hot_group_of_copies(spark, monkeypatch, share):
    """A third of the rows are one row repeated: still exact, dealt out in blocks, nothing lost."""
    monkeypatch.setattr(sampling, "COPIES_PER_TASK_ROW", 100)
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") >= 1000, F.col("id")).alias("v"))
    sample = exact_sample(df, share, "s")
    ranks = sorted(r["_rank"] for r in sample.picked.collect())
    assert ranks == list(range(1, int(3000 * share) + 1))
    whole = Counter(tuple(r) for r in sample.near.select("k", "v").unionByName(sample.far).collect())
    assert whole == Counter(tuple(r) for r in df.collect())


def test_rows_of_one_key_spread_over_all_buckets(spark):
    """Different rows with the same key, or without one, do not meet in one window."""
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).alias("k"), F.col("id").alias("v"))
    bucket = F.substring(sampling.row_digest(df.columns, "s"), 1, 4)
    assert df.groupBy(bucket.alias("b")).count().agg(F.max("count")).first()[0] < 20


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    picks = [{r["k"] for r in exact_sample(d, 0.05, "s").picked.collect()} for d in (df, df.repartition(13))]
    assert picks[0] == picks[1] and len(picks[0]) == 100


def sample_by_sorting(rows, columns, seed, size):
    """(rank, row) of the lowest digests of row and seed."""
    def digest(row):
        return hashlib.md5("|".join(["" if row[c] is None else str(row[c]) for c in columns] + [seed]).encode()).hexdigest()
    return sorted(((digest(r), str(tuple(r.values())), r) for r in rows), key=lambda x: x[:2])[:size]


@pytest.mark.parametrize("hot", [0, 700])
def test_several_samples_in_two_reads(spark, tmp_path, monkeypatch, hot):
    """Each sample equals sorting the whole table; together with the rest they are the table; short first guesses are mended."""
    monkeypatch.setattr(sampling, "COPIES_PER_TASK_ROW", 100)
    rows = [{"k": None if i < hot else f"k{i}", "v": 1 if i < hot else i} for i in range(2000)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "k string, v int").repartition(4)
    shares = {"a": 0.01, "b": 0.3, "c": 0.0, "d": 0.002}
    sizes = lambda n: {x: int(n * s) * (100 if x == "d" else 1) for x, s in shares.items()}  # noqa: E731 - d takes far more than its share
    found = sampling.ranked_samples(df, shares, {x: f"s{x}" for x in shares}, sizes, str(tmp_path / "near"))
    assert found.sizes == sizes(2000)
    for x in shares:
        got = found.picked(x).select("k", "v", "_rank", "_digest").collect()
        want = sample_by_sorting(rows, ["k", "v"], f"s{x}", found.sizes[x])
        assert sorted(r["_rank"] for r in got) == list(range(1, len(want) + 1))
        assert sorted((r["_rank"], r["_digest"]) for r in got) == [(n, d) for n, (d, _, _) in enumerate(want, 1)]
        assert Counter((r.k, r.v) for r in got) == Counter(tuple(r.values()) for *_, r in want)
    whole = Counter(tuple(r) for r in found.near.select("k", "v").unionByName(found.far).collect())
    assert whole == Counter(tuple(r.values()) for r in rows)


def test_defects_of_an_empty_table(spark, tmp_path):
    t = Tables(spark, FOLDER)
    found = inject(t.source(MOVIMIENTOS).limit(0), MOVIMIENTOS, date(2025, 7, 31), "s", str(tmp_path))
    assert found.table.count() == found.log.count() == 0


def test_dates_split_in_halves(spark):
    df = spark.range(1001).select(F.col("id").cast("string").alias("k"), F.lit(date(2024, 5, 5)).alias("d"))
    out = faults.shift_dates(df, 0.011, "d", "T", "k", date(2025, 7, 31), "s")
    days = [r["d"] for r in out.table.where("d <> date '2024-05-05'").collect()]
    assert sum(d > date(2025, 8, 29) for d in days) == 5 and sum(d < date(2014, 12, 3) for d in days) == 6
    assert out.log.count() == 11 and out.table.count() == 1001


def test_rules_find_what_was_injected(spark, ctx):
    """Without the defects that the derived tables bring, the rejections are exactly the logged ones."""
    t = Tables(spark, FOLDER)
    dims = silver.stg_clientes(t.raw(CLIENTES), ctx), silver.stg_productos(t.raw(PRODUCTOS))
    clean = {
        MOVIMIENTOS: silver.valid_movements(t.raw(MOVIMIENTOS), *dims, ctx),
        OBLIGACIONES: silver.stg_obligaciones(t.raw(OBLIGACIONES), *dims, ctx).drop("num_cuotas_pend_es_nulo"),
        COMISIONES: t.raw(COMISIONES).join(dims[0].select("id_cli"), "id_cli", "left_semi"),
    }
    clean = {n: df.drop("ingestion_ts", "source_system", "batch_id") for n, df in clean.items()}
    run = inject_all(clean, ctx.as_of, "s", f"{spark.conf.get('spark.checkpoint.dir')}/faults")
    logged = {(r["tabla"], r["tipo_anomalia"]): r["n"] for r in
              run.log.where("tipo_anomalia <> 'DUPLICADO_EXACTO'").groupBy("tabla", "tipo_anomalia").agg(
                  F.count("*").alias("n")).collect()}
    errors = rejects.err_calidad_datos(*(run.tables[n] for n in (MOVIMIENTOS, OBLIGACIONES, COMISIONES)), *dims, ctx)
    found = {(r["tabla"], r["tipo_error"]): r["n"] for r in rejects.counts_by_type(errors).collect()}
    assert found == logged and len(found) == 6

    audited = with_audit(run.tables[MOVIMIENTOS], BATCHES[0][0], "s", ctx.as_of)
    kept = silver.valid_movements(audited, *dims, ctx).select("id_mov", "fec_mov", "hra_mov", "cod_prod")
    repeated = run.log.where("tipo_anomalia = 'DUPLICADO_EXACTO'").count()
    assert run.tables[MOVIMIENTOS].count() == clean[MOVIMIENTOS].count() + repeated
    lost = clean[MOVIMIENTOS].count() - kept.count()
    assert 0 < lost <= errors.where(F.col("tabla") == MOVIMIENTOS).count()
