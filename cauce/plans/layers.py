"""Which model belongs where, and the daily run over all layers."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.context import RunContext
from cauce.operators.checks import Accepted, NoRows, NotNull, Related, Test, Unique, run_tests
from cauce.plans import gold, monitor, quality, rejects, silver
from cauce.plans.ingest import Ingestion, Reader, load_raw, missing_tables, raw_rows
from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SOURCES, SUCURSALES
from cauce.sources.lake import Lake, Layout, merge_snapshot, write_model
from cauce.sources.steps import Kept, stored

DEFAULT_LAYER = "silver"
PARALLEL_MODELS = 4


@dataclass(frozen=True)
class Model:
    """A table: how to build it from the lake, its layer and its layout."""

    build: Callable[[Warehouse], DataFrame]
    layer: str | None = None
    layout: Layout | None = None
    snapshot_keys: tuple[str, ...] = ()

    @property
    def target_layer(self) -> str:
        return self.layer or DEFAULT_LAYER


def _with_month(df: DataFrame) -> DataFrame:
    """Loans are spread over thousands of days; folders by month keep files large."""
    month = F.year("fec_desembolso") * 100 + F.month("fec_desembolso")
    return df.withColumn("mes_desembolso", month)


SILVER: tuple[dict[str, Model], ...] = (
    {
        "stg_clientes": Model(lambda w: silver.stg_clientes(w.raw[CLIENTES], w.ctx)),
        "stg_productos": Model(lambda w: silver.stg_productos(w.raw[PRODUCTOS])),
        "stg_sucursales": Model(lambda w: silver.stg_sucursales(w.raw[SUCURSALES])),
    },
    {
        # alone, like the other widest models: the disk holds the shuffles of all models of a group
        "stg_movimientos": Model(
            lambda w: silver.stg_movimientos_in_steps(w.raw[MOVIMIENTOS], w["stg_clientes"], w["stg_productos"], w.ctx,
                                                      w.kept("stg_movimientos"))),
    },
    {
        "stg_obligaciones": Model(
            lambda w: silver.stg_obligaciones(w.raw[OBLIGACIONES], w["stg_clientes"], w["stg_productos"], w.ctx)),
        "stg_comisiones": Model(
            lambda w: silver.stg_comisiones(w.raw[COMISIONES], w["stg_clientes"], w["stg_productos"])),
        "err_calidad_datos": Model(
            lambda w: rejects.err_calidad_datos(w.raw[MOVIMIENTOS], w.raw[OBLIGACIONES], w.raw[COMISIONES],
                                                w["stg_clientes"], w["stg_productos"], w.ctx)),
    },
    {"dq_report_silver": Model(lambda w: quality.dq_report_silver(w.raw, w["err_calidad_datos"], w.ctx))},
)
GOLD: tuple[dict[str, Model], ...] = (
    {
        "dim_clientes": Model(lambda w: gold.dim_clientes(w["stg_clientes"], w.ctx), "gold"),
        "dim_productos": Model(lambda w: gold.dim_productos(w["stg_productos"]), "gold"),
        "dim_geografia": Model(lambda w: gold.dim_geografia(w.lake.spark), "gold"),
        "dim_canal": Model(lambda w: gold.dim_canal(w.lake.spark), "gold"),
    },
    {
        # stored before its rows are dealt by date, which shuffles them again
        "fact_transacciones": Model(
            lambda w: w.kept("fact_transacciones")(gold.fact_transacciones(w["stg_movimientos"], w["dim_productos"], w.ctx), "filas"),
            "gold", Layout("fec_mov", ("cod_prod", "cod_canal"))),
    },
    {
        "fact_cartera": Model(
            lambda w: _with_month(gold.fact_cartera(w["stg_obligaciones"])), "gold",
            Layout("mes_desembolso", ("calif_regulatoria", "cod_prod", "fec_desembolso"))),
        "fact_rentabilidad_cliente": Model(
            lambda w: gold.fact_rentabilidad_cliente(w["stg_movimientos"], w["stg_comisiones"], w["dim_productos"]),
            "gold"),
    },
    {
        "kpi_cartera_diaria": Model(
            lambda w: gold.kpi_cartera_diaria(w["fact_cartera"], w["dim_clientes"], w.ctx), "gold",
            Layout("fecha_corte", ("cod_prod", "cod_segmento")),
            snapshot_keys=("fecha_corte", "cod_prod", "cod_segmento", "ciudad")),
    },
)
STAGES = {"silver": SILVER, "gold": GOLD}
MODELS = {name: model for stage in STAGES.values() for group in stage for name, model in group.items()}

# The tests and the values they accept.
PRODUCT_TYPES = ("CRED_LIBRE_INVERSION", "CRED_ROTATIVO", "TARJETA_DIGITAL", "CUENTA_AHORRO_DIGITAL",
                 "PAGO_PSE", "TRANSFERENCIA_ACH", "CORRESPONSALIA", "RECARGA")
TESTS: dict[str, tuple[Test, ...]] = {
    "silver": (
        NotNull("stg_clientes", "id_cli"), Unique("stg_clientes", "id_cli"),
        Accepted("stg_clientes", "cod_segmento", ("BAS", "STD", "PRM", "ELT")),
        Accepted("stg_clientes", "estado_cli", ("ACTIVO", "INACTIVO", "BLOQUEADO")),
        NotNull("stg_productos", "cod_prod"), Unique("stg_productos", "cod_prod"),
        Accepted("stg_productos", "tip_prod", PRODUCT_TYPES),
        NotNull("stg_sucursales", "cod_suc"), Unique("stg_sucursales", "cod_suc"),
        NotNull("stg_movimientos", "id_mov"),
        Related("stg_movimientos", "id_cli", "stg_clientes", "id_cli"),
        Related("stg_movimientos", "cod_prod", "stg_productos", "cod_prod"),
        Accepted("stg_movimientos", "cod_estado_mov", ("EXITOSA", "FALLIDA", "PENDIENTE")),
        NotNull("stg_obligaciones", "id_oblig"), Unique("stg_obligaciones", "id_oblig"),
        Related("stg_obligaciones", "id_cli", "stg_clientes", "id_cli"),
        NotNull("stg_comisiones", "id_comision"), Unique("stg_comisiones", "id_comision"),
        Related("stg_comisiones", "cod_prod", "stg_productos", "cod_prod"),
        NoRows("vr_mov_positivo", "stg_movimientos", "vr_mov <= 0"),
        NoRows("dias_mora_no_negativo", "stg_obligaciones", "dias_mora_act < 0"),
    ),
    "gold": (
        NotNull("dim_clientes", "id_cli"), Unique("dim_clientes", "id_cli"),
        Accepted("dim_clientes", "segmento_desc", (*gold.rules.SEGMENT_LABELS.values(), gold.rules.NO_SEGMENT)),
        NotNull("dim_productos", "cod_prod"), Unique("dim_productos", "cod_prod"),
        Accepted("dim_productos", "familia_producto", ("CREDITO", "AHORRO", "TRANSACCIONAL")),
        NotNull("dim_geografia", "cod_ciudad"), Unique("dim_geografia", "cod_ciudad"),
        NotNull("dim_canal", "cod_canal"), Unique("dim_canal", "cod_canal"),
        Accepted("dim_canal", "tipo_canal", ("FISICO", "DIGITAL")),
        NotNull("fact_transacciones", "id_mov"),
        Related("fact_transacciones", "id_cli", "dim_clientes", "id_cli"),
        Related("fact_transacciones", "cod_prod", "dim_productos", "cod_prod"),
        Related("fact_transacciones", "cod_canal", "dim_canal", "cod_canal"),
        NotNull("fact_cartera", "id_oblig"), Unique("fact_cartera", "id_oblig"),
        Related("fact_cartera", "id_cli", "dim_clientes", "id_cli"),
        Accepted("fact_cartera", "bucket_mora", ("Al día", "Rango 1", "Rango 2", "Rango 3", "Deteriorado")),
        Accepted("fact_cartera", "calif_regulatoria", ("A", "B", "C", "D", "E")),
        Related("fact_rentabilidad_cliente", "id_cli", "dim_clientes", "id_cli"),
        Related("kpi_cartera_diaria", "cod_prod", "dim_productos", "cod_prod"),
    ),
}
ALL_TESTS: tuple[Test, ...] = TESTS["silver"] + TESTS["gold"]


class TestsFailed(RuntimeError):
    """Some table tests of a stage found failures."""


@dataclass
class Warehouse:
    """The models over one lake: each is read back from where it was written."""

    lake: Lake
    ctx: RunContext

    @cached_property
    def raw(self) -> Mapping[str, DataFrame]:
        return {name: raw_rows(self.lake, table, if_missing="empty") for name, table in SOURCES.items()}

    def __getitem__(self, model: str) -> DataFrame:
        return self.lake.read(MODELS[model].target_layer, model)

    def _steps(self, model: str) -> str:
        return self.lake.path("steps", model)

    def kept(self, model: str) -> Kept:
        """Stores what a model needs while it is built."""
        return lambda df, label: stored(df, f"{self._steps(model)}/{label}")

    def build(self, name: str) -> None:
        model, path = MODELS[name], self.lake.path(MODELS[name].target_layer, name)
        df = model.build(self)
        if model.snapshot_keys:
            staging = self.lake.path("staging", name)
            merge_snapshot(self.lake, df, path, model.layout.partition, model.snapshot_keys, staging)
        else:
            write_model(df, path, model.layout)
        self.lake.remove(self._steps(name))

    def run_layer(self, stage: str) -> None:
        """Build the models of a stage; those of one group do not depend on each other."""
        if stage not in STAGES:
            raise ValueError(f"stage must be one of {sorted(STAGES)}, not {stage!r}")
        for group in STAGES[stage]:
            with ThreadPoolExecutor(PARALLEL_MODELS) as pool:
                list(pool.map(self.build, group))

    def test_results(self, stage: str | None = None) -> DataFrame:
        tests = TESTS[stage] if stage else ALL_TESTS
        names = {t.table for t in tests} | {t.parent for t in tests if isinstance(t, Related)}
        return run_tests({name: self[name] for name in names}, tests)

    def test_layer(self, stage: str) -> None:
        failed = self.test_results(stage).where("fallas > 0").collect()
        if failed:
            raise TestsFailed(f"{stage}: {[(r['prueba'], r['fallas']) for r in failed]}")

    def summary(self) -> DataFrame:
        return monitor.pipeline_summary(
            self["stg_movimientos"], self["fact_transacciones"], self["fact_cartera"], self["err_calidad_datos"]
        )


def run_pipeline(
    ingestion: Ingestion, read: Reader, ctx: RunContext, test: bool = True, copy_raw: bool = False
) -> Warehouse:
    """Bronze, Silver, Gold in this order; a stage that fails is recorded and ends the run.

    ``copy_raw`` rebuilds the raw tables from Bronze first; by default Silver reads Bronze itself.
    """
    lake, started = ingestion.lake, time.time()
    warehouse = Warehouse(lake, ctx)

    def silver_stage() -> None:
        # a source table that has not come keeps the run alive: it has no rows, and an event says so
        for name in missing_tables(lake):
            monitor.append_event(lake, monitor.NO_DATA, datetime.now(timezone.utc).isoformat(), table=name, status="sin_datos")
        for table in SOURCES.values() if copy_raw else ():
            load_raw(ingestion, table)
        warehouse.run_layer("silver")
        if test:
            warehouse.test_layer("silver")

    def gold_stage() -> None:
        warehouse.run_layer("gold")
        if test:
            warehouse.test_layer("gold")

    for name, stage in (("bronze", lambda: ingestion.run(read)), ("silver", silver_stage), ("gold", gold_stage)):
        try:
            stage()
        except Exception as error:
            now = datetime.now(timezone.utc).isoformat()
            monitor.append_event(lake, monitor.TASK_FAILURE, now, task_name=name, error_message=error)
            raise
    counts = warehouse.summary().first().asDict()
    monitor.append_event(lake, monitor.SUCCESS_SUMMARY, datetime.now(timezone.utc).isoformat(), **counts,
                         duration_seconds=round(time.time() - started, 2))
    return warehouse
