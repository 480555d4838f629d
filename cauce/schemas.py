"""Contracts of the six source tables: columns, types, file format and extraction mode."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STR, INT, DATE, BOOL = T.StringType(), T.IntegerType(), T.DateType(), T.BooleanType()


def _dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


def _contract(sensitive: str = "", **columns: T.DataType) -> T.StructType:
    marked = set(sensitive.split())
    return T.StructType(
        [T.StructField(c, t, True, {"sensitive": True} if c in marked else {}) for c, t in columns.items()]
    )


# Table names, column names and column order of the source system.
CLIENTES, PRODUCTOS, SUCURSALES = "TB_CLIENTES_CORE", "TB_PRODUCTOS_CAT", "TB_SUCURSALES_RED"
MOVIMIENTOS, OBLIGACIONES, COMISIONES = "TB_MOV_FINANCIEROS", "TB_OBLIGACIONES", "TB_COMISIONES_LOG"

AUDIT_COLUMNS = ("ingestion_ts", "source_system", "batch_id")


@dataclass(frozen=True)
class SourceTable:
    """One table of the source system."""

    name: str
    key: str
    schema: T.StructType
    file_format: str
    watermark: str | None = None

    @property
    def mode(self) -> str:
        return "incremental" if self.watermark else "full"

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def bronze_schema(self) -> T.StructType:
        audit = [T.StructField(c, STR) for c in AUDIT_COLUMNS]
        return T.StructType(list(self.schema.fields) + audit)

    def project(self, df: DataFrame) -> DataFrame:
        """The declared columns in the declared order; fails when one is missing."""
        return df.select(*self.columns)


SOURCES: dict[str, SourceTable] = {
    t.name: t
    for t in (
        SourceTable(
            PRODUCTOS, "cod_prod",
            _contract(cod_prod=STR, desc_prod=STR, tip_prod=STR, tasa_ea=_dec(6, 2), plazo_max_meses=INT,
                      cuota_min=_dec(14, 2), comision_admin=_dec(14, 2), estado_prod=STR),
            "csv",
        ),
        SourceTable(
            SUCURSALES, "cod_suc",
            _contract(cod_suc=STR, nom_suc=STR, tip_punto=STR, ciudad=STR, depto=STR,
                      latitud=_dec(9, 6), longitud=_dec(9, 6), activo=BOOL),
            "json",
        ),
        SourceTable(
            CLIENTES, "id_cli",
            _contract("nomb_cli apell_cli num_doc fec_nac score_buro",
                      id_cli=STR, nomb_cli=STR, apell_cli=STR, tip_doc=STR, num_doc=STR, fec_nac=DATE,
                      fec_alta=DATE, cod_segmento=STR, score_buro=INT, ciudad_res=STR, depto_res=STR,
                      estado_cli=STR, canal_adquis=STR),
            "json",
        ),
        SourceTable(
            OBLIGACIONES, "id_oblig",
            _contract("vr_aprobado vr_desembolsado sdo_capital vr_cuota dias_mora_act calif_riesgo",
                      id_oblig=STR, id_cli=STR, cod_prod=STR, vr_aprobado=_dec(16, 2),
                      vr_desembolsado=_dec(16, 2), sdo_capital=_dec(16, 2), vr_cuota=_dec(14, 2),
                      fec_desembolso=DATE, fec_venc=DATE, dias_mora_act=INT, num_cuotas_pend=INT,
                      calif_riesgo=STR),
            "parquet",
        ),
        SourceTable(
            MOVIMIENTOS, "id_mov",
            _contract("num_cuenta vr_mov id_dispositivo",
                      id_mov=STR, id_cli=STR, cod_prod=STR, num_cuenta=STR, fec_mov=DATE, hra_mov=STR,
                      vr_mov=_dec(16, 2), tip_mov=STR, cod_canal=STR, cod_ciudad=STR,
                      cod_estado_mov=STR, id_dispositivo=STR),
            "parquet", watermark="fec_mov",
        ),
        SourceTable(
            COMISIONES, "id_comision",
            _contract("vr_comision",
                      id_comision=STR, id_cli=STR, cod_prod=STR, fec_cobro=DATE, vr_comision=_dec(14, 2),
                      tip_comision=STR, estado_cobro=STR),
            "parquet", watermark="fec_cobro",
        ),
    )
}
