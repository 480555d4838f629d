"""The rejection table: which raw rows Silver leaves out, and why."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.context import RunContext
from cauce.functions import rules
from cauce.operators.integrity import mark_parent
from cauce.schemas import COMISIONES, MOVIMIENTOS, OBLIGACIONES

# Reason codes.
ORPHAN, BAD_DATE, INCONSISTENT = "FK_HUERFANA", "FECHA_FUERA_DE_RANGO", "CAMPO_INCONSISTENTE"

# (code, condition that rejects the row, message); a NULL condition rejects nothing, and a NULL part
# makes the message NULL
Check = tuple[str, Column, Column]


# The message texts in the checks below.
def _message(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _date_check(column: str, ctx: RunContext) -> Check:
    valid = rules.valid_date(F.col(column), F.lit(ctx.first_valid_date), F.lit(ctx.as_of))
    return BAD_DATE, ~valid, _message(f"{column}=", F.col(column), " fuera del rango válido")


def _orphan_check() -> Check:
    text = _message("id_cli=", F.col("id_cli"), " o cod_prod=", F.col("cod_prod"), " no existen en las dimensiones")
    return ORPHAN, ~(F.col("_client_known") & F.col("_product_known")), text


def _movement_checks(ctx: RunContext) -> list[Check]:
    wrong_sign = _message("vr_mov=", F.col("vr_mov"), " (monto inválido)")
    return [_date_check("fec_mov", ctx), (INCONSISTENT, F.col("vr_mov") <= 0, wrong_sign)]


def _loan_checks(ctx: RunContext) -> list[Check]:
    too_high = ~rules.balance_within_tolerance(F.col("sdo_capital"), F.col("vr_aprobado"))
    text = _message("sdo_capital=", F.col("sdo_capital"), " > vr_aprobado=", F.col("vr_aprobado"))
    return [_date_check("fec_desembolso", ctx), (INCONSISTENT, too_high, text)]


def _failures(
    raw: DataFrame, table: str, key: str, checks: list[Check], clientes: DataFrame, productos: DataFrame
) -> DataFrame:
    """One pass over the table: every row yields as many lines as it fails checks.

    Rows that fail none are left out before the lines are made: nearly all are, and an array for each of them costs more
    than the checks.
    """
    marked = mark_parent(
        mark_parent(raw, productos, "cod_prod", "_product_known"), clientes, "id_cli", "_client_known"
    )
    all_checks = [_orphan_check(), *checks]
    outcomes = [
        F.when(failed, F.struct(F.lit(code).alias("tipo_error"), text.alias("motivo"))) for code, failed, text in all_checks
    ]
    return (
        marked.where(reduce(Column.__or__, [F.coalesce(failed, F.lit(False)) for _, failed, _ in all_checks])).select(
            F.lit(table).alias("tabla"), F.col(key).alias("id_registro"),
            F.explode(F.array_compact(F.array(*outcomes))).alias("_failed"),
        )
        .select("tabla", "id_registro", "_failed.tipo_error", "_failed.motivo")
    )


def orphan_rows(raw: DataFrame, table: str, key: str, clientes: DataFrame, productos: DataFrame) -> DataFrame:
    """Rows without a known client or without a known product; a missing key counts as unknown."""
    return _failures(raw, table, key, [], clientes, productos)


def err_calidad_datos(
    movimientos: DataFrame,
    obligaciones: DataFrame,
    comisiones: DataFrame,
    clientes: DataFrame,
    productos: DataFrame,
    ctx: RunContext,
) -> DataFrame:
    """All rejections. Raw rows are judged before removal of copies, so copies appear as often."""
    parts = [
        _failures(movimientos, MOVIMIENTOS, "id_mov", _movement_checks(ctx), clientes, productos),
        _failures(obligaciones, OBLIGACIONES, "id_oblig", _loan_checks(ctx), clientes, productos),
        _failures(comisiones, COMISIONES, "id_comision", [], clientes, productos),
    ]
    found = reduce(DataFrame.unionByName, parts)
    return found.withColumn("fecha_deteccion", F.lit(ctx.run_ts).cast("timestamp_ntz"))


def rejected_counts(errors: DataFrame) -> DataFrame:
    """Distinct rejected records per table."""
    return errors.groupBy("tabla").agg(F.countDistinct("id_registro").alias("filas_rechazadas"))


def counts_by_type(errors: DataFrame) -> DataFrame:
    return errors.groupBy("tipo_error", "tabla").agg(F.count(F.lit(1)).alias("n"))
