"""All controlled defects at their usual rates, with a common log."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.operators import faults
from cauce.operators.faults import Damaged
from cauce.operators.sampling import ranked_samples
from cauce.schemas import COMISIONES, MOVIMIENTOS, OBLIGACIONES, SOURCES
from cauce.sources.lake import read_model, write_model

# Share of rows per defect.
DUPLICATES, BAD_DATES, ORPHANS, INCONSISTENT = 0.003, 0.002, 0.0015, 0.002


@dataclass(frozen=True)
class FaultRun:
    tables: Mapping[str, DataFrame]
    log: DataFrame


@dataclass(frozen=True)
class Defect:
    """One kind of defect of a table: its sample, the column that it changes, and what it logs.

    ``value`` and ``reason`` are given the row's rank in the sample, the sample's size and the name of its digest. Without a
    column the sampled rows are repeated.
    """

    name: str
    share: float
    kind: str
    column: str | None
    value: Callable[[Column, int, str], Column] | None
    reason: Callable[[Column, int], Column]


def table_defects(table: str, last: date) -> tuple[Defect, ...]:
    def dates(name: str, column: str) -> Defect:
        return Defect(name, BAD_DATES, faults.BAD_DATE, column, lambda r, n, d: faults.shifted_date(r, n, last, d),
                      lambda r, n: faults.date_reason(r, n, column))

    def orphans(name: str) -> Defect:
        return Defect(name, ORPHANS, faults.ORPHAN, "id_cli", lambda r, n, d: faults.orphan_key(r), lambda r, n: faults.orphan_reason(r, "id_cli"))

    return {
        MOVIMIENTOS: (
            Defect("1", DUPLICATES, faults.DUPLICATE, None, None, lambda r, n: F.lit(faults.DUPLICATE_REASON)),
            dates("2", "fec_mov"), orphans("4"),
            Defect("6", INCONSISTENT, faults.INCONSISTENT, "vr_mov", lambda r, n, d: -F.abs("vr_mov"), lambda r, n: F.lit(faults.SIGN_REASON)),
        ),
        OBLIGACIONES: (
            dates("3", "fec_desembolso"),
            Defect("7", INCONSISTENT, faults.INCONSISTENT, "sdo_capital", lambda r, n, d: faults.inflated("vr_aprobado", d),
                   lambda r, n: F.lit(faults.BALANCE_REASON)),
        ),
        COMISIONES: (orphans("5"),),
    }[table]


def inject(df: DataFrame, table: str, last: date, seed: str, folder: str) -> Damaged:
    """All defects of a table in one projection: the table is read twice and written once, with a log of what was changed.

    Samples are independent, so a row may have several defects; shares are of the table with its repeated rows, and the copy of a
    row is that of the row as it was.
    """
    defects = table_defects(table, last)

    def sizes(rows: int) -> dict[str, int]:
        repeated = {d.name: int(rows * d.share) for d in defects if d.column is None}
        return {d.name: repeated.get(d.name, int((rows + sum(repeated.values())) * d.share)) for d in defects}

    found = ranked_samples(df, {d.name: d.share for d in defects}, {d.name: f"{seed}{d.name}" for d in defects}, sizes, f"{folder}/near")
    changes = {
        d.column: F.when(F.col(f"_rank_{d.name}").isNotNull(), d.value(F.col(f"_rank_{d.name}"), found.sizes[d.name], f"_digest_{d.name}")
                         .cast(df.schema[d.column].dataType)).otherwise(F.col(d.column))
        for d in defects if d.column
    }
    out = found.far.unionByName(found.near.withColumns(changes).select(*df.columns))
    for d in defects:
        if d.column is None:
            out = out.unionByName(found.picked(d.name).select(*df.columns))
    key = SOURCES[table].key
    log = reduce(DataFrame.unionByName, (
        faults.log_lines(found.picked(d.name), table, key, d.kind, d.reason(F.col("_rank"), found.sizes[d.name])) for d in defects))
    written = []
    for part, rows in (("table", out), ("log", log)):
        write_model(rows, f"{folder}/{part}")
        written.append(read_model(df.sparkSession, f"{folder}/{part}"))
    return Damaged(*written)


def inject_all(sources: Mapping[str, DataFrame], last: date, seed: str, folder: str) -> FaultRun:
    """Damage movements, loans and fees; results go to ``folder``, which all executors reach."""
    damaged = {table: inject(sources[table], table, last, seed, f"{folder}/{table}") for table in (MOVIMIENTOS, OBLIGACIONES, COMISIONES)}
    return FaultRun({**sources, **{t: d.table for t, d in damaged.items()}}, reduce(DataFrame.unionByName, (d.log for d in damaged.values())))
