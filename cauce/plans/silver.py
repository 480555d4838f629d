"""Silver: the trusted tables. Raw rows in, typed, unique, referentially valid and masked rows out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.context import RunContext
from cauce.functions import masking, rules
from cauce.operators.dedup import distinct_rows, first_per_key
from cauce.operators.integrity import with_parent, without_parent
from cauce.operators.nulls import Exclude, Flag, Impute, apply_null_rules
from cauce.operators.rolling import trailing_day_totals, trailing_deviation, trailing_mean
from cauce.schemas import AUDIT_COLUMNS, CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SUCURSALES
from cauce.sources.steps import Kept

# Strategy, default and flag name per column.
NULL_RULES = {
    CLIENTES: (
        Exclude("id_cli"), Exclude("num_doc"), Exclude("fec_nac"),
        Flag("score_buro", "score_buro_es_nulo"),
        Impute("ciudad_res", "DESCONOCIDA", "ciudad_res_imputada"),
        Impute("canal_adquis", "NO_REGISTRADO"),
    ),
    PRODUCTOS: (
        Exclude("cod_prod"),
        Flag("plazo_max_meses", "es_plazo_aplicable", when_present=True),
        Impute("comision_admin", 0, "comision_admin_imputada"),
    ),
    SUCURSALES: (
        Exclude("cod_suc"),
        Flag(("latitud", "longitud"), "tiene_geolocalizacion", when_present=True),
    ),
    MOVIMIENTOS: (
        Exclude("id_mov"),
        Impute("cod_ciudad", "DESCONOCIDA", "cod_ciudad_imputada"),
        Flag("id_dispositivo", "sin_dispositivo_registrado"),
    ),
    OBLIGACIONES: (Exclude("id_oblig"), Flag("num_cuotas_pend", "num_cuotas_pend_es_nulo")),
    COMISIONES: (Exclude("id_comision"), Impute("tip_comision", "SIN_CLASIFICAR", "tip_comision_imputado")),
}

# What makes two movements the same one, and how far back the fraud rule looks.
MOVEMENT_KEY = (
    "id_mov", "id_cli", "cod_prod", "num_cuenta", "fec_mov", "hra_mov", "tip_mov", "cod_canal", "cod_estado_mov",
)
TRAILING_DAYS = 30


# Names and order of the columns in the select lists below, which are the tables' contract.


def stg_clientes(clientes: DataFrame, ctx: RunContext) -> DataFrame:
    clean = apply_null_rules(distinct_rows(clientes), NULL_RULES[CLIENTES])
    hashed = {f"{c}_hash": masking.masked(F.col(c), ctx.pii_salt) for c in ("nomb_cli", "apell_cli", "num_doc")}
    return clean.withColumns(hashed).select(
        "id_cli", "nomb_cli_hash", "apell_cli_hash", "tip_doc", "num_doc_hash", "fec_nac", "fec_alta",
        "cod_segmento", "score_buro", "score_buro_es_nulo", "ciudad_res", "ciudad_res_imputada", "depto_res",
        "estado_cli", "canal_adquis", *AUDIT_COLUMNS,
    )


def stg_productos(productos: DataFrame) -> DataFrame:
    return apply_null_rules(distinct_rows(productos), NULL_RULES[PRODUCTOS]).select(
        "cod_prod", "desc_prod", "tip_prod", "tasa_ea", "plazo_max_meses", "es_plazo_aplicable", "cuota_min",
        "comision_admin", "comision_admin_imputada", "estado_prod", *AUDIT_COLUMNS,
    )


def stg_sucursales(sucursales: DataFrame) -> DataFrame:
    return apply_null_rules(distinct_rows(sucursales), NULL_RULES[SUCURSALES]).select(
        "cod_suc", "nom_suc", "tip_punto", "ciudad", "depto", "latitud", "longitud", "tiene_geolocalizacion",
        "activo", *AUDIT_COLUMNS,
    )


def unique_movements(movimientos: DataFrame, extra_order: Sequence[Column] = ()) -> DataFrame:
    """One row per movement: the earliest ingested.

    Copies that differ outside the key are told apart by the remaining columns, highest amount
    first, so the choice does not depend on the run; ``extra_order`` decides between rows equal in all of them.
    """
    order = (
        F.col("ingestion_ts").asc(), F.col("vr_mov").desc_nulls_last(), F.col("cod_ciudad").asc_nulls_last(),
        F.col("id_dispositivo").asc_nulls_last(), F.col("batch_id").asc(), F.col("source_system").asc(),
    )
    return first_per_key(movimientos, MOVEMENT_KEY, (*order, *extra_order))


def sound(unicos: DataFrame, ctx: RunContext) -> DataFrame:
    """Of unique movements those with an id, a date in range and a positive amount."""
    dated = rules.valid_date(F.col("fec_mov"), F.lit(ctx.first_valid_date), F.lit(ctx.as_of))
    return unicos.where(F.col("id_mov").isNotNull() & dated & (F.col("vr_mov") > 0))


def acceptable(unicos: DataFrame, productos: DataFrame, ctx: RunContext) -> DataFrame:
    """Of unique movements those with an id, a date in range, a positive amount and a known product."""
    return with_parent(sound(unicos, ctx), productos, "cod_prod")


def _acceptable_movements(movimientos: DataFrame, productos: DataFrame, ctx: RunContext) -> DataFrame:
    return acceptable(unique_movements(movimientos), productos, ctx)


def valid_movements(
    movimientos: DataFrame, clientes: DataFrame, productos: DataFrame, ctx: RunContext
) -> DataFrame:
    """The rows of ``stg_movimientos`` without their statistics, for plans that need none."""
    return with_parent(_acceptable_movements(movimientos, productos, ctx), clientes, "id_cli")


def stg_movimientos(
    movimientos: DataFrame, clientes: DataFrame, productos: DataFrame, ctx: RunContext
) -> DataFrame:
    """Valid movements with the trailing statistics of their client and the fraud flag.

    The client check is done on the day totals, not on the movements: a movement whose client is
    unknown finds no totals in the final join. The wide rows are therefore shuffled twice only, by
    movement and by (client, day); a hot client spreads over its days in the second shuffle, and a
    hot day is split by the adaptive join.
    """
    rows = _acceptable_movements(movimientos, productos, ctx)
    return with_statistics(rows, trailing_day_totals(rows, "id_cli", "fec_mov", "vr_mov", TRAILING_DAYS), clientes)


def acceptable_in_steps(movimientos: DataFrame, productos: DataFrame, ctx: RunContext, kept: Kept) -> DataFrame:
    """Acceptable movements, stored by ``kept`` once their copies have gone, so that no two wide shuffles lie on disk together.

    Copies are removed once instead of once for each reader. The product check looks up each product once and stores those that
    are missing: usually few, so the wide rows need no shuffle by product. Where they are many, the planner shuffles them.
    """
    unicos = kept(sound(unique_movements(movimientos), ctx), "unicos")
    missing = kept(without_parent(unicos.select("cod_prod").distinct(), productos, "cod_prod"), "sin_producto")
    return without_parent(unicos, missing, "cod_prod")


def stg_movimientos_in_steps(
    movimientos: DataFrame, clientes: DataFrame, productos: DataFrame, ctx: RunContext, kept: Kept
) -> DataFrame:
    """The rows of ``stg_movimientos``; movements and statistics are stored by ``kept`` before they meet."""
    rows = acceptable_in_steps(movimientos, productos, ctx, kept)
    statistics = day_statistics(trailing_day_totals(rows, "id_cli", "fec_mov", "vr_mov", TRAILING_DAYS), clientes)
    return measured(rows, kept(statistics, "estadisticas"))


def with_statistics(rows: DataFrame, day_totals: DataFrame, clientes: DataFrame) -> DataFrame:
    """Acceptable movements of known clients with the statistics made of their (client, day) trailing totals."""
    return measured(rows, day_statistics(day_totals, clientes))


def day_statistics(day_totals: DataFrame, clientes: DataFrame) -> DataFrame:
    """Mean and deviation per day of known clients; made before the join, so that two doubles go there in place of the wide totals."""
    return with_parent(day_totals, clientes, "id_cli").select(
        "id_cli", "fec_mov", trailing_mean().alias("promedio_movil_30d"), trailing_deviation().alias("stddev_movil_30d")
    )


def measured(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """Acceptable movements with the statistics of their client and day; those without any go."""
    # narrow and unique by (client, day), so a hash table of a part of them is small: the wide rows need no sort
    joined = rows.join(statistics.hint("shuffle_hash"), ["id_cli", "fec_mov"]).withColumn("hra_mov", rules.checked_clock(F.col("hra_mov")))
    flagged = joined.withColumn(
        "ind_sospechoso",
        rules.suspicious_amount(F.col("vr_mov"), F.col("promedio_movil_30d"), F.col("stddev_movil_30d")),
    )
    return apply_null_rules(flagged, NULL_RULES[MOVIMIENTOS]).select(
        "id_mov", "id_cli", "cod_prod", "num_cuenta", "fec_mov", "hra_mov", "vr_mov", "tip_mov", "cod_canal",
        "cod_ciudad", "cod_ciudad_imputada", "cod_estado_mov", "id_dispositivo", "sin_dispositivo_registrado",
        "promedio_movil_30d", "stddev_movil_30d", "ind_sospechoso", *AUDIT_COLUMNS,
    )


def stg_obligaciones(
    obligaciones: DataFrame, clientes: DataFrame, productos: DataFrame, ctx: RunContext
) -> DataFrame:
    dated = rules.valid_date(F.col("fec_desembolso"), F.lit(ctx.first_valid_date), F.lit(ctx.as_of))
    sound = rules.balance_within_tolerance(F.col("sdo_capital"), F.col("vr_aprobado"))
    kept = distinct_rows(obligaciones).where(dated & sound)
    known = with_parent(with_parent(kept, productos, "cod_prod"), clientes, "id_cli")
    return apply_null_rules(known, NULL_RULES[OBLIGACIONES]).select(
        "id_oblig", "id_cli", "cod_prod", "vr_aprobado", "vr_desembolsado", "sdo_capital", "vr_cuota",
        "fec_desembolso", "fec_venc", "dias_mora_act", "num_cuotas_pend", "num_cuotas_pend_es_nulo",
        "calif_riesgo", *AUDIT_COLUMNS,
    )


def stg_comisiones(comisiones: DataFrame, clientes: DataFrame, productos: DataFrame) -> DataFrame:
    known = with_parent(with_parent(distinct_rows(comisiones), productos, "cod_prod"), clientes, "id_cli")
    return apply_null_rules(known, NULL_RULES[COMISIONES]).select(
        "id_comision", "id_cli", "cod_prod", "fec_cobro", "vr_comision", "tip_comision",
        "tip_comision_imputado", "estado_cobro", *AUDIT_COLUMNS,
    )
