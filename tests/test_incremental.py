"""Incremental movements: after any order of batches, repetitions and failures, equal to a rebuild from all rows."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.plans import silver
from cauce.plans.incremental import IncrementalMovements
from cauce.schemas import CLIENTES, MOVIMIENTOS, PRODUCTOS, SOURCES
from cauce.sources import lake as lakes
from cauce.sources.lake import Lake
from tests.frames import raw

SCHEMA = SOURCES[MOVIMIENTOS].bronze_schema


def batches(spark, seed, count=4):
    """Rows of a few clients over 100 days: hot days, copies in other batches with other amounts, late rows, bad rows."""
    rng = np.random.default_rng(seed)
    out = [[] for _ in range(count)]
    for n in range(240):
        client = f"CLI{int(rng.integers(0, 3))}" if n % 3 else "CLI0"  # a third of the rows has one client
        day = date(2025, 1, 20) + timedelta(days=int(rng.integers(0, 100))) if n % 40 else [None, date(2031, 1, 1)][n // 40 % 2]
        number = None if n % 50 == 49 else f"MOV{n}"
        for at in {int(rng.integers(0, count)) for _ in range(1 + (n % 5 == 0))}:
            amount = Decimal(int(rng.integers(-300, 100_000))) / 100 if n % 17 else None
            product = "PRDX" if n % 31 == 0 else f"PRD{n % 2}"
            out[at].append((number, client if n % 29 else None, product, "8", day, "10:00:00", amount, "PAGO_PSE", "APP", None, "EXITOSA", "d",
                            f"2025-06-0{1 + at}T00:00:00", "core", f"b{at}"))
    return [spark.createDataFrame(rows + rows[:3], SCHEMA) for rows in out]


@pytest.fixture(scope="module")
def parents(spark, ctx):
    clients = raw(spark, CLIENTES, *({"id_cli": f"CLI{i}"} for i in range(2)))
    products = raw(spark, PRODUCTOS, *({"cod_prod": f"PRD{i}"} for i in range(2)))
    return silver.stg_clientes(clients, ctx), silver.stg_productos(products)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2, 1), (2, 2, 3, 0, 1, 3)])
def test_equals_a_rebuild(spark, ctx, parents, tmp_path, order):
    found = batches(spark, 1)
    state = IncrementalMovements(Lake(spark, str(tmp_path)), ctx)
    everything = found[0]
    for df in found[1:]:
        everything = everything.unionByName(df)
    for n in order:
        state.apply(found[n], f"b{n}", parents[1])
    want = silver.stg_movimientos(everything, *parents, ctx)
    assert rows_of(state.stg_movimientos(*parents)) == rows_of(want) and want.count() > 80
    assert want.where("stddev_movil_30d > 0").count() > 20


@pytest.mark.parametrize("dies_after", [0, 1, 2, 3])
def test_a_failed_batch_is_repeated(spark, ctx, parents, tmp_path, monkeypatch, dies_after):
    found = batches(spark, 2, 3)
    state = IncrementalMovements(Lake(spark, str(tmp_path)), ctx)
    state.apply(found[2], "b2", parents[1])
    steps = ["_settled_changes", "_add_totals", "_renew_window"]

    def dying(*args, **kwargs):
        raise OSError("store is down")
    with monkeypatch.context() as broken:
        if dies_after < 3:
            broken.setattr(IncrementalMovements, steps[dies_after], dying)
        else:
            broken.setattr("cauce.plans.incremental.merge_snapshot", dying)
        with pytest.raises(OSError):
            state.apply(found[0], "b0", parents[1])
    if dies_after:
        with pytest.raises(RuntimeError, match="b0"):
            state.apply(found[1], "b1", parents[1])
    state.apply(found[0], "b0", parents[1])
    state.apply(found[1], "b1", parents[1])
    want = silver.stg_movimientos(found[0].unionByName(found[1]).unionByName(found[2]), *parents, ctx)
    assert rows_of(state.stg_movimientos(*parents)) == rows_of(want)


def test_a_day_touches_its_own_months_only(spark, ctx, parents, tmp_path):
    """A batch rewrites the months that it changes or reaches; the files of the others stay as they are."""
    state = IncrementalMovements(Lake(spark, str(tmp_path)), ctx)
    row = {"id_mov": "M", "id_cli": "CLI0", "cod_prod": "PRD0", "vr_mov": Decimal(5), "ingestion_ts": "t"}
    days = [date(2025, m, 5) for m in range(1, 13)]
    state.apply(raw(spark, MOVIMIENTOS, *({**row, "fec_mov": d} for d in days)), "b0", parents[1])

    def files(part):
        return {(p.parent.name if part != "totales" else p.parent.parent.name, p.name)
                for p in (tmp_path / "incremental" / "movimientos" / part).rglob("*.parquet")}
    before = {part: files(part) for part in ("unicos", "ventana", "totales")}
    state.apply(raw(spark, MOVIMIENTOS, {**row, "id_mov": "N", "fec_mov": date(2025, 6, 20)}), "b1", parents[1])
    after = {part: files(part) for part in before}
    assert {m for m, _ in before["unicos"] ^ after["unicos"]} == {"mes=202506"}
    assert {m for m, _ in before["ventana"] ^ after["ventana"]} == {"mes=202506", "mes=202507"}
    assert {m for m, _ in before["totales"] ^ after["totales"]} == {"mes=202506"}
    state.apply(batches(spark, 1)[0].limit(0), "b2", parents[1])
    assert {part: files(part) for part in before} == after


def test_snapshot_of_an_empty_state(spark, ctx, parents, tmp_path):
    state = IncrementalMovements(Lake(spark, str(tmp_path)), ctx)
    assert state.stg_movimientos(*parents).count() == 0 and lakes.PARTITIONS
