"""Gold: dimensions, facts and the daily portfolio snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.context import RunContext
from cauce.functions import masking, rules
from cauce.functions.numbers import percentage
from cauce.operators.merging import merge_measures
from cauce.operators.rolling import trailing_row_sum
from cauce.schemas import AUDIT_COLUMNS

# The two reference dimensions kept by the data team.
CHANNELS = (
    ("APP", "Aplicación móvil", "DIGITAL"),
    ("WEB", "Portal web", "DIGITAL"),
    ("CORRESPONSAL", "Corresponsal bancario", "FISICO"),
    ("OFICINA", "Oficina", "FISICO"),
    ("CAJERO", "Cajero automático", "FISICO"),
)
CITIES = (
    ("BOG", "Bogotá", "Cundinamarca", "Colombia"),
    ("MED", "Medellín", "Antioquia", "Colombia"),
    ("CAL", "Cali", "Valle del Cauca", "Colombia"),
    ("BAQ", "Barranquilla", "Atlántico", "Colombia"),
    ("BGA", "Bucaramanga", "Santander", "Colombia"),
    ("CDMX", "Ciudad de México", "CDMX", "México"),
    ("GDL", "Guadalajara", "Jalisco", "México"),
    ("MTY", "Monterrey", "Nuevo León", "México"),
    ("LIM", "Lima", "Lima", "Perú"),
    ("AQP", "Arequipa", "Arequipa", "Perú"),
    ("SCL", "Santiago", "Región Metropolitana", "Chile"),
    ("VAP", "Valparaíso", "Valparaíso", "Chile"),
    ("BUE", "Buenos Aires", "CABA", "Argentina"),
    ("COR", "Córdoba", "Córdoba", "Argentina"),
)
VALUE_MONTHS = 12


def dim_canal(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHANNELS, "cod_canal string, desc_canal string, tipo_canal string")


def dim_geografia(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, "cod_ciudad string, ciudad string, depto string, pais string")


def dim_clientes(clientes: DataFrame, ctx: RunContext) -> DataFrame:
    return clientes.withColumns(
        {
            "nombre_completo_hash": masking.masked_full_name(F.col("nomb_cli_hash"), F.col("apell_cli_hash")),
            "edad": rules.age_in_years(F.col("fec_nac"), F.lit(ctx.as_of)),
            "segmento_desc": rules.segment_label(F.col("cod_segmento")),
        }
    ).select(
        "id_cli", "nombre_completo_hash", "tip_doc", "num_doc_hash", "fec_nac", "edad", "fec_alta",
        "cod_segmento", "segmento_desc", "score_buro", "score_buro_es_nulo", "ciudad_res", "depto_res",
        "estado_cli", "canal_adquis", *AUDIT_COLUMNS,
    )


def dim_productos(productos: DataFrame) -> DataFrame:
    return productos.select(
        "cod_prod",
        F.col("desc_prod").alias("nombre_producto"),
        F.col("tip_prod").alias("tipo_producto"),
        rules.product_family(F.col("tip_prod")).alias("familia_producto"),
        F.col("tasa_ea").alias("tasa_efectiva_anual"),
        rules.monthly_rate(F.col("tasa_ea")).alias("tasa_mensual_equivalente"),
        F.col("plazo_max_meses").alias("plazo_maximo_meses"),
        "es_plazo_aplicable",
        F.col("cuota_min").alias("cuota_minima"),
        F.col("comision_admin").alias("comision_administracion"),
        F.col("estado_prod").alias("estado_producto"),
        *AUDIT_COLUMNS,
    )


def fact_transacciones(movimientos: DataFrame, productos: DataFrame, ctx: RunContext) -> DataFrame:
    """``productos`` is ``dim_productos``; statistics and flag come with the movements."""
    families = productos.select("cod_prod", "familia_producto")
    return movimientos.join(families, "cod_prod").withColumns(
        {
            "vr_mov_usd": rules.in_dollars(F.col("vr_mov"), ctx.cop_per_usd),
            "horario_habil": rules.business_hours(F.col("fec_mov"), F.col("hra_mov")),
        }
    ).select(
        "id_mov", "id_cli", "cod_prod", "familia_producto", "num_cuenta", "fec_mov", "hra_mov", "vr_mov",
        "vr_mov_usd", "tip_mov", "cod_canal", "cod_ciudad", "horario_habil", "cod_estado_mov",
        "promedio_movil_30d", "stddev_movil_30d", "ind_sospechoso", *AUDIT_COLUMNS,
    )


def fact_cartera(obligaciones: DataFrame) -> DataFrame:
    days = F.col("dias_mora_act")
    return obligaciones.withColumns(
        {
            "bucket_mora": rules.arrears_bucket(days),
            "calif_regulatoria": rules.regulatory_rating(days),
            "provision_pct": rules.provision_share(days),
            "provision_estimada": F.round(F.col("sdo_capital") * rules.provision_share(days), 2),
        }
    ).select(
        "id_oblig", "id_cli", "cod_prod", "vr_aprobado", "vr_desembolsado", "sdo_capital", "vr_cuota",
        "fec_desembolso", "fec_venc", "dias_mora_act", "bucket_mora", "calif_regulatoria",
        F.col("calif_riesgo").alias("calif_riesgo_fuente"), "provision_pct", "provision_estimada",
        "num_cuotas_pend", "num_cuotas_pend_es_nulo", *AUDIT_COLUMNS,
    )


def interest_income(movimientos: DataFrame, productos: DataFrame) -> DataFrame:
    """Interest per client and month: credit movements times the monthly rate of their product.

    The state of the movement plays no part. The rate as a share has 6 digits, so sums are exact.
    """
    rates = productos.where(F.col("familia_producto") == "CREDITO").select(
        "cod_prod", (F.col("tasa_mensual_equivalente") / 100).cast("decimal(9,6)").alias("_share")
    )
    return (
        movimientos.where(F.col("tip_mov").isin(*rules.INTEREST_MOVEMENTS))
        .join(rates, "cod_prod")
        .groupBy("id_cli", rules.month_of(F.col("fec_mov")).alias("periodo"))
        .agg(F.sum(F.col("vr_mov") * F.col("_share")).alias("ingreso_intereses"))
    )


def fee_income(comisiones: DataFrame) -> DataFrame:
    """Fees actually charged, per client and month."""
    return (
        comisiones.where(F.col("estado_cobro") == rules.CHARGED)
        .groupBy("id_cli", rules.month_of(F.col("fec_cobro")).alias("periodo"))
        .agg(F.sum("vr_comision").alias("ingreso_comisiones"))
    )


def combined_income(movimientos: DataFrame, comisiones: DataFrame, productos: DataFrame) -> DataFrame:
    """Interest and fees side by side, unrounded, 0 where a client has none in a month."""
    return merge_measures(
        interest_income(movimientos, productos), fee_income(comisiones), ["id_cli", "periodo"]
    )


def fact_rentabilidad_cliente(
    movimientos: DataFrame, comisiones: DataFrame, productos: DataFrame
) -> DataFrame:
    """Monthly income per client and its sum over the last 12 months that the client has.

    The window runs over one row per client and month; rounding comes last.
    """
    income = combined_income(movimientos, comisiones, productos)
    total = F.col("ingreso_intereses") + F.col("ingreso_comisiones")
    return income.select(
        "id_cli",
        "periodo",
        F.round("ingreso_intereses", 2).alias("ingreso_intereses"),
        F.round("ingreso_comisiones", 2).alias("ingreso_comisiones"),
        F.round(total, 2).alias("ingreso_total"),
        F.round(trailing_row_sum(total, "id_cli", "periodo", VALUE_MONTHS), 2).alias("cltv_12m"),
    )


def kpi_cartera_diaria(cartera: DataFrame, clientes: DataFrame, ctx: RunContext) -> DataFrame:
    """State of the portfolio on the run date by product, segment and city."""
    late = F.col("dias_mora_act") > 0
    late_balance = F.sum(F.when(late, F.col("sdo_capital")).otherwise(F.lit(0).cast("decimal(16,2)")))
    return (
        cartera.join(clientes.select("id_cli", "cod_segmento", F.col("ciudad_res").alias("ciudad")), "id_cli")
        .groupBy("cod_prod", "cod_segmento", "ciudad")
        .agg(
            F.countDistinct("id_oblig").alias("total_obligaciones_activas"),
            F.round(F.sum("sdo_capital"), 2).alias("monto_total_cartera"),
            F.round(late_balance, 2).alias("monto_en_mora"),
            percentage(late_balance, F.sum("sdo_capital")).alias("tasa_mora_pct"),
            F.countDistinct(F.when(late, F.col("id_cli"))).alias("clientes_con_mora"),
        )
        .select(F.lit(ctx.as_of).alias("fecha_corte"), "*")
    )


def portfolio_by_rating(cartera: DataFrame) -> DataFrame:
    """Loans, balance and provision per regulatory rating."""
    return cartera.groupBy("calif_regulatoria").agg(
        F.count(F.lit(1)).alias("obligaciones"),
        F.sum("sdo_capital").alias("saldo"),
        F.sum("provision_estimada").alias("provision"),
    )


def top_clients(rentabilidad: DataFrame, k: int = 10) -> DataFrame:
    """The client months with the highest 12-month value; a per-task top k, then a merge."""
    return rentabilidad.orderBy(F.desc("cltv_12m"), "id_cli", "periodo").limit(k)
