"""The Silver quality report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.context import RunContext
from cauce.functions.masking import MASK_PATTERN
from cauce.functions.numbers import count_where, percentage
from cauce.plans.rejects import rejected_counts
from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SOURCES, SUCURSALES

# Columns whose share of missing values is reported.
WATCHED_NULLS = {
    CLIENTES: ("score_buro", "ciudad_res", "canal_adquis"),
    PRODUCTOS: ("comision_admin",),
    SUCURSALES: ("latitud",),
    MOVIMIENTOS: ("id_dispositivo", "cod_ciudad"),
    OBLIGACIONES: ("num_cuotas_pend",),
    COMISIONES: ("tip_comision",),
}


def _profile(raw: DataFrame, table: str) -> DataFrame:
    """One pass over one table: its rows and the missing values of its watched columns."""
    nulls = [
        F.struct(F.lit(f"{table}.{c}").alias("columna"), count_where(F.col(c).isNull()).alias("nulos"))
        for c in WATCHED_NULLS[table]
    ]
    return raw.agg(
        F.lit(table).alias("tabla"), F.count(F.lit(1)).alias("filas_totales"), F.array(*nulls).alias("_nulls")
    )


def table_profiles(raw: Mapping[str, DataFrame]) -> DataFrame:
    """One row per source table."""
    return reduce(DataFrame.unionByName, [_profile(raw[t], t) for t in WATCHED_NULLS])


def table_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per source table."""
    counted = [
        raw[t].agg(F.lit(t).alias("tabla"), F.count(F.lit(1)).alias("filas_totales")) for t in WATCHED_NULLS
    ]
    return reduce(DataFrame.unionByName, counted)


def _with_rejections(profiles: DataFrame, errors: DataFrame) -> DataFrame:
    rejected = F.coalesce("filas_rechazadas", F.lit(0).cast("bigint"))
    return (
        profiles.join(rejected_counts(errors), "tabla", "left")
        .withColumn("filas_rechazadas", rejected)
        .withColumn("pct_conformes", percentage(F.col("filas_totales") - F.col("filas_rechazadas"),
                                                F.col("filas_totales")))
    )


def conformity_summary(raw: Mapping[str, DataFrame], errors: DataFrame) -> DataFrame:
    """Total, rejected and conforming share per table."""
    return _with_rejections(table_counts(raw), errors).select(
        "tabla", "filas_totales", "filas_rechazadas", "pct_conformes"
    )


def null_shares(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Percentage of missing values per watched column."""
    return table_profiles(raw).select("filas_totales", F.inline("_nulls")).select(
        "columna", percentage(F.col("nulos"), F.col("filas_totales")).alias("pct_nulos")
    )


def dq_report_silver(raw: Mapping[str, DataFrame], errors: DataFrame, ctx: RunContext) -> DataFrame:
    """Long format (table or column, metric, value): each source table is read once."""

    def line(subject: str, metric: str, value: str) -> F.Column:
        return F.struct(
            F.col(subject).alias("tabla"), F.lit(metric).alias("metrica"),
            F.col(value).cast("decimal(20,2)").alias("valor"),
        )

    summary = _with_rejections(table_profiles(raw), errors)
    table_lines = F.array(*[line("tabla", m, m) for m in ("filas_totales", "filas_rechazadas", "pct_conformes")])
    null_lines = F.transform(
        "_nulls",
        lambda n: F.struct(
            n["columna"].alias("tabla"), F.lit("pct_nulos").alias("metrica"),
            percentage(n["nulos"], F.col("filas_totales")).cast("decimal(20,2)").alias("valor"),
        ),
    )
    return summary.select(F.inline(F.concat(table_lines, null_lines))).withColumn(
        "corrida_ts", F.lit(ctx.run_ts).cast("timestamp_ntz")
    )


def null_rate_profile(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Per source table, rows and the mean share of missing values over all its columns."""

    def profile(table: str) -> DataFrame:
        columns = SOURCES[table].columns
        missing = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
        return sources[table].agg(
            F.lit(table).alias("tabla"), F.count(F.lit(1)).alias("filas"),
            percentage(F.sum(missing), F.count(F.lit(1)) * len(columns)).alias("pct_nulos_promedio"),
        )

    return reduce(DataFrame.unionByName, [profile(t) for t in SOURCES])


def mask_check(clientes: DataFrame) -> DataFrame:
    """Per masked column of the client table, how many values are not a hash."""
    masked = [c for c in clientes.columns if c.endswith("_hash")]
    clear = [f.name for f in SOURCES[CLIENTES].schema if f"{f.name}_hash" in masked and f.name in clientes.columns]
    if clear:
        raise ValueError(f"clear-text personal data in a masked table: {clear}")
    lines = [
        F.struct(
            F.lit(c).alias("columna"), F.count(c).alias("valores"),
            count_where(~F.col(c).rlike(MASK_PATTERN)).alias("sin_mascara"),
        )
        for c in masked
    ]
    return clientes.agg(F.array(*lines).alias("_lines")).select(F.inline("_lines"))
