"""Edge cases of the trusted tables."""

from __future__ import annotations

import math
import statistics
from datetime import date
from decimal import Decimal as D

import pytest

from cauce.plans import gold, rejects, silver
from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS
from tests.frames import raw


@pytest.fixture(scope="module")
def dims(spark, ctx):
    clients = silver.stg_clientes(raw(spark, CLIENTES, {}, {"id_cli": "CLI000002"}), ctx)
    return clients, silver.stg_productos(raw(spark, PRODUCTOS, {}))


def test_client_rules(spark, ctx):
    rows = {r["id_cli"]: r for r in silver.stg_clientes(raw(
        spark, CLIENTES, {"id_cli": "a"}, {"id_cli": "a"}, {"id_cli": "b", "num_doc": None},
        {"id_cli": "c", "fec_nac": None}, {"id_cli": None},
        {"id_cli": "d", "score_buro": None, "ciudad_res": None, "canal_adquis": None, "nomb_cli": None}), ctx).collect()}
    assert set(rows) == {"a", "d"}
    assert (rows["d"]["score_buro"], rows["d"]["score_buro_es_nulo"]) == (None, True)
    assert (rows["d"]["ciudad_res"], rows["d"]["ciudad_res_imputada"]) == ("DESCONOCIDA", True)
    assert rows["d"]["canal_adquis"] == "NO_REGISTRADO"
    assert rows["d"]["nomb_cli_hash"] is None and len(rows["a"]["nomb_cli_hash"]) == 64
    assert not {"nomb_cli", "apell_cli", "num_doc"} & set(rows["a"].asDict())


def test_copies_with_other_audit_values_stay(spark, dims):
    fees = raw(spark, COMISIONES, {}, {}, {"batch_id": "b2"})
    assert silver.stg_comisiones(fees, *dims).count() == 2


def test_movement_copies(spark):
    rows = silver.unique_movements(raw(
        spark, MOVIMIENTOS,
        {"vr_mov": D("1")}, {"vr_mov": D("3")}, {"vr_mov": None}, {"vr_mov": D("2"), "cod_ciudad": None},
        {"vr_mov": D("9"), "ingestion_ts": "2025-12-02T00:00:00+00:00"},
        {"id_mov": "M2", "cod_prod": None}, {"id_mov": "M2", "cod_prod": None, "cod_ciudad": "AAA"})).collect()
    assert sorted((r["id_mov"], r["vr_mov"], r["cod_ciudad"]) for r in rows) == [
        ("M1", D("3.00"), "BOG"), ("M2", D("100.00"), "AAA")]


def test_neither_valid_nor_rejected(spark, ctx, dims):
    """A missing date or amount fails no check and passes no filter."""
    movements = raw(spark, MOVIMIENTOS, {"fec_mov": None}, {"vr_mov": None})
    nothing = raw(spark, OBLIGACIONES, {"sdo_capital": None}), raw(spark, COMISIONES)
    assert silver.valid_movements(movements, *dims, ctx).count() == 0
    assert silver.stg_movimientos(movements, *dims, ctx).count() == 0
    assert rejects.err_calidad_datos(movements, *nothing, *dims, ctx).count() == 0


def test_limits_are_inclusive(spark, ctx, dims):
    movements = raw(spark, MOVIMIENTOS, *[{"id_mov": str(d), "fec_mov": d} for d in (
        date(2014, 12, 31), date(2015, 1, 1), date(2025, 12, 31), date(2026, 1, 1))])
    assert silver.valid_movements(movements, *dims, ctx).count() == 2
    loans = raw(spark, OBLIGACIONES, {"id_oblig": "x", "sdo_capital": D("105.00")},
                {"id_oblig": "y", "sdo_capital": D("105.01")})
    assert [r["id_oblig"] for r in silver.stg_obligaciones(loans, *dims, ctx).collect()] == ["x"]


def test_rejections(spark, ctx, dims):
    found = rejects.err_calidad_datos(
        raw(spark, MOVIMIENTOS, {"id_cli": "CLI9", "vr_mov": D("-5"), "fec_mov": date(2031, 1, 1)},
            {"id_mov": "M2", "vr_mov": D("0")}, {"id_mov": "M2", "vr_mov": D("0")}, {"id_mov": "M3"}),
        raw(spark, OBLIGACIONES, {"id_cli": None}, {"id_oblig": "O2", "sdo_capital": D("200")}),
        raw(spark, COMISIONES, {"cod_prod": "PRD9"}), *dims, ctx).collect()
    assert sorted(((r["id_registro"], r["tipo_error"], r["motivo"]) for r in found), key=str) == sorted([
        ("M1", "FK_HUERFANA", "id_cli=CLI9 o cod_prod=PRD001 no existen en las dimensiones"),
        ("M1", "FECHA_FUERA_DE_RANGO", "fec_mov=2031-01-01 fuera del rango válido"),
        ("M1", "CAMPO_INCONSISTENTE", "vr_mov=-5.00 (monto inválido)"),
        ("M2", "CAMPO_INCONSISTENTE", "vr_mov=0.00 (monto inválido)"),
        ("M2", "CAMPO_INCONSISTENTE", "vr_mov=0.00 (monto inválido)"),
        ("O1", "FK_HUERFANA", None),
        ("O2", "CAMPO_INCONSISTENTE", "sdo_capital=200.00 > vr_aprobado=100.00"),
        ("C1", "FK_HUERFANA", "id_cli=CLI000001 o cod_prod=PRD9 no existen en las dimensiones"),
    ], key=str)


def test_trailing_statistics(spark, ctx, dims):
    """The day itself and anything older than 30 days do not count; one earlier row has no deviation."""
    days = [("a", date(2025, 3, 1), "10"), ("b", date(2025, 3, 1), "20"), ("c", date(2025, 3, 31), "90"),
            ("d", date(2025, 4, 1), "70"), ("e", date(2025, 6, 1), "5")]
    rows = {r["id_mov"]: r for r in silver.stg_movimientos(raw(
        spark, MOVIMIENTOS, *[{"id_mov": i, "fec_mov": d, "vr_mov": D(v)} for i, d, v in days]), *dims, ctx).collect()}
    stats = {k: (r["promedio_movil_30d"], r["stddev_movil_30d"], r["ind_sospechoso"]) for k, r in rows.items()}
    assert stats["a"] == stats["b"] == stats["e"] == (None, None, False)
    assert stats["c"][0] == 15.0 and math.isclose(stats["c"][1], math.sqrt(50)) and stats["c"][2] is True
    assert stats["d"] == (90.0, None, False)


def test_deviation_of_large_and_close_amounts(spark, ctx, dims):
    """Squares of these amounts have 32 digits and differ in the last few only."""
    base = D("90000000000000.00")
    rows = [{"id_mov": str(i), "fec_mov": date(2025, 3, 1), "vr_mov": base + i % 7} for i in range(1500)]
    late = {"id_mov": "z", "fec_mov": date(2025, 3, 2), "vr_mov": base + 20}
    got = silver.stg_movimientos(raw(spark, MOVIMIENTOS, *rows, late), *dims, ctx).where("id_mov = 'z'").first()
    assert math.isclose(got["stddev_movil_30d"], statistics.stdev(i % 7 for i in range(1500)), rel_tol=1e-12)
    assert got["ind_sospechoso"] is True


def test_deviation_of_large_and_wide_amounts(spark, ctx, dims):
    huge = D("99999999999999.99")
    rows = [{"id_mov": str(i), "fec_mov": date(2025, 3, 1), "vr_mov": huge - i * 10**10} for i in range(200)]
    late = {"id_mov": "z", "fec_mov": date(2025, 3, 2)}
    got = silver.stg_movimientos(raw(spark, MOVIMIENTOS, *rows, late), *dims, ctx).where("id_mov = 'z'").first()
    values = [float(r["vr_mov"]) for r in rows]
    mean = sum(values) / 200
    assert math.isclose(got["promedio_movil_30d"], mean)
    assert math.isclose(got["stddev_movil_30d"], math.sqrt(sum((v - mean) ** 2 for v in values) / 199), rel_tol=1e-6)


def test_profitability(spark, ctx, dims):
    """Twelve observed months, not calendar months; interest whatever the state, fees only if charged."""
    months = [date(2023 + m // 12, m % 12 + 1, 15) for m in range(0, 28, 2)]
    fees = raw(spark, COMISIONES, *[{"id_comision": str(d), "fec_cobro": d} for d in months],
               {"id_comision": "r", "estado_cobro": "REVERSADO", "fec_cobro": date(2025, 9, 1)},
               {"id_comision": "n", "fec_cobro": None, "id_cli": "CLI000002"})
    movements = raw(spark, MOVIMIENTOS, {"fec_mov": date(2025, 7, 1), "cod_estado_mov": "FALLIDA", "vr_mov": D("1000")},
                    {"id_mov": "M2", "tip_mov": "RECARGA"})
    clients, products = dims
    rows = {(r["id_cli"], r["periodo"]): r for r in gold.fact_rentabilidad_cliente(
        silver.valid_movements(movements, clients, products, ctx), silver.stg_comisiones(fees, clients, products),
        gold.dim_productos(products)).collect()}
    assert len(rows) == 16
    assert rows["CLI000002", None]["cltv_12m"] == D("10.00")
    assert rows["CLI000001", "2024-11"]["cltv_12m"] == D("120.00")
    assert rows["CLI000001", "2025-03"]["cltv_12m"] == D("120.00")
    last = rows["CLI000001", "2025-07"]
    assert (last["ingreso_intereses"], last["ingreso_comisiones"], last["cltv_12m"]) == (
        D("21.34"), D("0.00"), D("131.34"))


def test_kpi(spark, ctx, dims):
    clients, products = dims
    loans = raw(spark, OBLIGACIONES, {"dias_mora_act": 5}, {"id_oblig": "O2", "sdo_capital": D("100")},
                {"id_oblig": "O3", "id_cli": "CLI000002", "sdo_capital": D("0"), "dias_mora_act": None})
    portfolio = gold.fact_cartera(silver.stg_obligaciones(loans, clients, products, ctx))
    row = gold.kpi_cartera_diaria(portfolio, gold.dim_clientes(clients, ctx), ctx).first().asDict()
    assert row == dict(fecha_corte=date(2025, 12, 31), cod_prod="PRD001", cod_segmento="STD", ciudad="Cali",
                       total_obligaciones_activas=3, monto_total_cartera=D("150.00"), monto_en_mora=D("50.00"),
                       tasa_mora_pct=D("33.33"), clientes_con_mora=1)
    empty = gold.kpi_cartera_diaria(portfolio.where("id_oblig = 'O3'"), gold.dim_clientes(clients, ctx), ctx).first()
    assert (empty["tasa_mora_pct"], empty["clientes_con_mora"]) == (None, 0)


def test_reference_dimensions(spark):
    assert gold.dim_canal(spark).count() == 5 and gold.dim_geografia(spark).count() == 14
    assert gold.dim_geografia(spark).select("cod_ciudad").distinct().count() == 14


def test_rows_without_failures_make_no_lines(spark, ctx, dims):
    """The lines of a rejection are made for failing rows only, not for every row of the table."""
    found = rejects.err_calidad_datos(raw(spark, MOVIMIENTOS, {}, {"vr_mov": D("0")}, {"fec_mov": None, "cod_prod": None}),
                                      raw(spark, OBLIGACIONES, {}), raw(spark, COMISIONES, {}), *dims, ctx)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    lines = [n for n, line in enumerate(plan) if "Generate" in line]
    assert len(lines) == 3 and all("Filter" in plan[n + 1] or "Filter" in plan[n + 2] for n in lines)
    assert sorted((r["tipo_error"], r["motivo"]) for r in found.select("tipo_error", "motivo").collect() if r["motivo"]) == [
        ("CAMPO_INCONSISTENTE", "vr_mov=0.00 (monto inválido)")]
    assert found.where("motivo is null").count() == 1
