"""Controlled defects for testing the quality rules: table in, damaged table and log out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.operators.sampling import Sample, digest_number, exact_sample, row_digest

# Defect codes, reasons and ranges.
DUPLICATE, BAD_DATE, ORPHAN, INCONSISTENT = (
    "DUPLICADO_EXACTO", "FECHA_FUERA_DE_RANGO", "FK_HUERFANA", "CAMPO_INCONSISTENTE",
)
DUPLICATE_REASON = "Fila duplicada exacta (misma PK) para simular reintento de ingesta sin idempotencia"
FUTURE_REASON = "{} posterior a la ventana de carga (posible error de reloj de origen)"
PAST_REASON = "{} anterior a la fundación del banco (posible error de migración)"
SIGN_REASON = "vr_mov negativo (signo inválido para el tipo de movimiento)"
BALANCE_REASON = "sdo_capital > vr_aprobado (inconsistencia de negocio)"
FOUNDED = date(2015, 1, 1)
FUTURE_DAYS, PAST_DAYS = (30, 399), (30, 3649)
FIRST_ORPHAN = 900_000
ORPHAN_PREFIX = "CLIX"  # clients are CLI and digits: no client has such a key, however many there are
INFLATION_PERCENT = (130, 179)
LOG_SCHEMA = ("tabla", "id_registro", "tipo_anomalia", "motivo")


@dataclass(frozen=True)
class Damaged:
    table: DataFrame
    log: DataFrame


def _between(low: int, high: int, start: int, digest: str = "_digest") -> Column:
    """A number from low to high taken from the row's digest."""
    return (F.lit(low) + digest_number(F.col(digest), start) % (high - low + 1)).cast("int")


def shifted_date(rank: Column, size: int, last: date, digest: str = "_digest") -> Column:
    """Past the loading window in the first half of the sample, before the founding in the rest."""
    return F.when(rank <= size // 2, F.date_add(F.lit(last), _between(*FUTURE_DAYS, 9, digest))).otherwise(
        F.date_sub(F.lit(FOUNDED), _between(*PAST_DAYS, 17, digest)))


def date_reason(rank: Column, size: int, column: str) -> Column:
    return F.when(rank <= size // 2, FUTURE_REASON.format(column)).otherwise(PAST_REASON.format(column))


def orphan_key(rank: Column) -> Column:
    """One of a series of client numbers that no client has."""
    return F.concat(F.lit(ORPHAN_PREFIX), (rank - 1 + FIRST_ORPHAN).cast("string"))


def orphan_reason(rank: Column, column: str) -> Column:
    return F.concat(F.lit(f"{column}="), orphan_key(rank), F.lit(" no existe en TB_CLIENTES_CORE"))


def inflated(approved: str, digest: str = "_digest") -> Column:
    percent = _between(*INFLATION_PERCENT, 9, digest).cast("decimal(3,0)")
    return F.round(F.col(approved) * percent / 100, 2)


def log_lines(picked: DataFrame, table: str, key: str, kind: str, reason: Column) -> DataFrame:
    return picked.select(
        F.lit(table).alias("tabla"), F.col(key).alias("id_registro"), F.lit(kind).alias("tipo_anomalia"),
        reason.alias("motivo"),
    )


def _changed(sample: Sample, column: str, value: Column) -> DataFrame:
    """The whole table with the column replaced in the sampled rows."""
    kind = sample.far.schema[column].dataType
    new = F.when(F.col("_rank").isNotNull(), value.cast(kind)).otherwise(F.col(column))
    near = sample.near.withColumn(column, new).select(*sample.far.columns)
    return sample.far.unionByName(near)


def repeat_rows(df: DataFrame, share: float, table: str, key: str, seed: str) -> Damaged:
    sample = exact_sample(df, share, seed)
    table_out = df.unionByName(sample.picked.select(*df.columns))
    return Damaged(table_out, log_lines(sample.picked, table, key, DUPLICATE, F.lit(DUPLICATE_REASON)))


def shift_dates(
    df: DataFrame, share: float, column: str, table: str, key: str, last: date, seed: str
) -> Damaged:
    """The first half of the sample moves past the loading window, the rest before the founding."""
    sample = exact_sample(df, share, seed)
    rank = F.col("_rank")
    moved, reason = shifted_date(rank, sample.size, last), date_reason(rank, sample.size, column)
    return Damaged(_changed(sample, column, moved), log_lines(sample.picked, table, key, BAD_DATE, reason))


def orphan_keys(df: DataFrame, share: float, column: str, table: str, key: str, seed: str) -> Damaged:
    """The key becomes one of a series of client numbers that no client has."""
    sample = exact_sample(df, share, seed)
    unknown, reason = orphan_key(F.col("_rank")), orphan_reason(F.col("_rank"), column)
    return Damaged(_changed(sample, column, unknown), log_lines(sample.picked, table, key, ORPHAN, reason))


def flip_signs(df: DataFrame, share: float, column: str, table: str, key: str, seed: str) -> Damaged:
    sample = exact_sample(df, share, seed)
    log = log_lines(sample.picked, table, key, INCONSISTENT, F.lit(SIGN_REASON))
    return Damaged(_changed(sample, column, -F.abs(column)), log)


def inflate_balances(
    df: DataFrame, share: float, column: str, approved: str, table: str, key: str, seed: str
) -> Damaged:
    sample = exact_sample(df, share, seed)
    log = log_lines(sample.picked, table, key, INCONSISTENT, F.lit(BALANCE_REASON))
    return Damaged(_changed(sample, column, inflated(approved)), log)


def blank_values(df: DataFrame, share: float, columns: list[str], seed: str) -> DataFrame:
    """Each value of the columns goes missing with the given probability, independently."""
    limit = int(share * 2**32)
    hit = {c: digest_number(row_digest(df.columns, f"{seed}|{c}"), 1) < limit for c in columns}
    return df.withColumns({c: F.when(~hit[c], F.col(c)) for c in columns})


def counts_by_kind(log: DataFrame) -> DataFrame:
    return log.groupBy("tipo_anomalia").agg(F.count(F.lit(1)).alias("n"))
