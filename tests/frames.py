"""Small hand-made source tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from pyspark.sql import DataFrame, SparkSession

from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SOURCES

DEFAULTS = {
    CLIENTES: dict(id_cli="CLI000001", nomb_cli="Ana", apell_cli="Paz", tip_doc="CC", num_doc="1",
                   fec_nac=date(1990, 5, 5), fec_alta=date(2020, 1, 1), cod_segmento="STD", score_buro=700,
                   ciudad_res="Cali", depto_res="Valle", estado_cli="ACTIVO", canal_adquis="APP"),
    PRODUCTOS: dict(cod_prod="PRD001", desc_prod="x", tip_prod="TARJETA_DIGITAL", tasa_ea=D("28.84"),
                    plazo_max_meses=None, cuota_min=D("0"), comision_admin=D("5"), estado_prod="ACTIVO"),
    MOVIMIENTOS: dict(id_mov="M1", id_cli="CLI000001", cod_prod="PRD001", num_cuenta="8", fec_mov=date(2025, 3, 1),
                      hra_mov="10:00:00", vr_mov=D("100.00"), tip_mov="AVANCE_EFECTIVO", cod_canal="APP",
                      cod_ciudad="BOG", cod_estado_mov="EXITOSA", id_dispositivo="d"),
    OBLIGACIONES: dict(id_oblig="O1", id_cli="CLI000001", cod_prod="PRD001", vr_aprobado=D("100"),
                       vr_desembolsado=D("100"), sdo_capital=D("50"), vr_cuota=D("5"),
                       fec_desembolso=date(2024, 1, 1), fec_venc=date(2026, 1, 1), dias_mora_act=0,
                       num_cuotas_pend=3, calif_riesgo="NORMAL"),
    COMISIONES: dict(id_comision="C1", id_cli="CLI000001", cod_prod="PRD001", fec_cobro=date(2025, 3, 1),
                     vr_comision=D("10"), tip_comision="MANEJO", estado_cobro="EXITOSO"),
}
AUDIT = dict(ingestion_ts="2025-12-01T00:00:00+00:00", source_system="s", batch_id="b1")


def raw(spark: SparkSession, table: str, *rows: dict) -> DataFrame:
    full = [{**DEFAULTS[table], **AUDIT, **r} for r in rows]
    return spark.createDataFrame(full, SOURCES[table].bronze_schema)
