"""Column catalogue and lineage of computed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from cauce.schemas import AUDIT_COLUMNS, SOURCES

CATALOG_SCHEMA = "tabla string, campo string, tipo string, origen string, sensible string"
LINEAGE_SCHEMA = "campo string, tabla string, origen string, regla string"

# Computed column, its table, what it comes from, rule.
LINEAGE = (
    ("edad", "dim_clientes", "TB_CLIENTES_CORE.fec_nac", "año de corte - año de nacimiento"),
    ("segmento_desc", "dim_clientes", "TB_CLIENTES_CORE.cod_segmento", "etiqueta del código"),
    ("tasa_mensual_equivalente", "dim_productos", "TB_PRODUCTOS_CAT.tasa_ea", "((1 + ea/100)^(1/12) - 1) * 100"),
    ("vr_mov_usd", "fact_transacciones", "TB_MOV_FINANCIEROS.vr_mov", "vr_mov / 4050.0"),
    ("horario_habil", "fact_transacciones", "TB_MOV_FINANCIEROS.fec_mov, hra_mov", "lunes a viernes, 07:00-20:59"),
    ("ind_sospechoso", "stg_movimientos", "TB_MOV_FINANCIEROS.vr_mov",
     "vr_mov > promedio + 3 desviaciones de los 30 días previos del cliente"),
    ("bucket_mora", "fact_cartera", "TB_OBLIGACIONES.dias_mora_act", "0 / 1-30 / 31-60 / 61-90 / resto"),
    ("calif_regulatoria", "fact_cartera", "fact_cartera.bucket_mora", "A a E según el rango"),
    ("provision_estimada", "fact_cartera", "TB_OBLIGACIONES.sdo_capital", "sdo_capital * porcentaje de la calificación"),
    ("ingreso_intereses", "fact_rentabilidad_cliente",
     "TB_MOV_FINANCIEROS.vr_mov, dim_productos.tasa_mensual_equivalente",
     "suma de vr_mov * tasa de avances y compras de productos de crédito"),
    ("cltv_12m", "fact_rentabilidad_cliente", "fact_rentabilidad_cliente.ingreso_total", "suma de 12 periodos"),
)
SENSITIVE_COMPUTED = (
    "vr_mov_usd", "provision_estimada", "ingreso_intereses", "ingreso_comisiones", "ingreso_total", "cltv_12m",
)


def _origins() -> dict[str, str]:
    """Column name -> source column; a key that several tables share belongs to the one it is the key of."""
    found: dict[str, str] = {}
    for table in SOURCES.values():
        for column in table.columns:
            if column not in found or column == table.key:
                found[column] = f"{table.name}.{column}"
    return found


def column_catalog(spark: SparkSession, models: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of the given models, from their schemas alone; no data is read."""
    origins = _origins()
    sensitive = {f.name for t in SOURCES.values() for f in t.schema if f.metadata.get("sensitive")}
    computed = {(table, column): source for column, table, source, _ in LINEAGE}

    def row(table: str, name: str, kind: str) -> tuple[str, str, str, str, str]:
        base = name.removesuffix("_hash")
        origin = computed.get((table, name)) or origins.get(name) or origins.get(base)
        if not origin:
            origin = "ingestión" if name in AUDIT_COLUMNS else "calculado"
        if name.endswith("_hash"):
            mark = "sí (hash)"
        else:
            mark = "sí" if name in sensitive or name in SENSITIVE_COMPUTED else "no"
        return table, name, kind, origin, mark

    rows = [row(t, f.name, f.dataType.simpleString()) for t, df in models.items() for f in df.schema]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def lineage(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LINEAGE, LINEAGE_SCHEMA)
