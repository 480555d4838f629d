"""The registered queries over the driver tables, each next to its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce import oracle
from cauce.context import RunContext
from cauce.functions import rules
from cauce.functions.numbers import repaired_int
from cauce.operators import checks, faults, ranges
from cauce.operators.checks import Accepted, NotNull, Related, Unique
from cauce.operators.clustering import clustered
from cauce.operators.dedup import distinct_rows
from cauce.operators.distinct_counts import DistinctCounts
from cauce.operators.integrity import with_parent
from cauce.operators.nulls import apply_null_rules
from cauce.operators.rolling import trailing_day_totals
from cauce.plans import gold, incremental, ingest, layers, monitor, quality, rejects, silver
from cauce.plans.fault_run import inject_all
from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SOURCES, SUCURSALES
from cauce.session import shared_folder
from cauce.sources import files, footers
from cauce.sources.driver_tables import AS_OF, BATCHES, SOURCE_SYSTEM, raw_table, source_table
from cauce.sources.lake import Lake, merge_snapshot
from cauce.sources.steps import Kept, kept_in
from cauce.streaming.dedup_feed import feed_first_copies

CONTEXT = RunContext(as_of=date.fromisoformat(AS_OF), run_ts=f"{AS_OF} 06:00:00", pii_salt="sal-de-prueba")

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The models over one folder of driver tables, as plans; of these only the movements run steps before a query does."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def source(self, name: str) -> DataFrame:
        return source_table(self.spark, self.folder, name)

    def raw(self, name: str) -> DataFrame:
        return raw_table(self.spark, self.folder, name)

    @cached_property
    def all_sources(self) -> dict[str, DataFrame]:
        return {name: self.source(name) for name in SOURCES}

    @cached_property
    def all_raw(self) -> dict[str, DataFrame]:
        return {name: self.raw(name) for name in SOURCES}

    @cached_property
    def clientes(self) -> DataFrame:
        return silver.stg_clientes(self.raw(CLIENTES), CONTEXT)

    @cached_property
    def productos(self) -> DataFrame:
        return silver.stg_productos(self.raw(PRODUCTOS))

    @cached_property
    def sucursales(self) -> DataFrame:
        return silver.stg_sucursales(self.raw(SUCURSALES))

    @cached_property
    def movimientos_aceptables(self) -> DataFrame:
        return silver.acceptable_in_steps(self.raw(MOVIMIENTOS), self.productos, CONTEXT, self.kept)

    @cached_property
    def movimientos(self) -> DataFrame:
        """For plans that read few columns of them: those that are not read are not computed after the copies have gone."""
        rows = self.movimientos_aceptables
        return silver.with_statistics(
            rows, trailing_day_totals(rows, "id_cli", "fec_mov", "vr_mov", silver.TRAILING_DAYS), self.clientes)

    @cached_property
    def movimientos_por_pasos(self) -> DataFrame:
        """The same, for plans that read their statistics."""
        return silver.stg_movimientos_in_steps(self.raw(MOVIMIENTOS), self.clientes, self.productos, CONTEXT, self.kept)

    @cached_property
    def movimientos_escritos(self) -> DataFrame:
        """The same as a table, for a plan that shuffles their wide rows again."""
        return self.kept(self.movimientos_por_pasos, "movimientos")

    @cached_property
    def movimientos_validos(self) -> DataFrame:
        return silver.valid_movements(self.raw(MOVIMIENTOS), self.clientes, self.productos, CONTEXT)

    @cached_property
    def obligaciones(self) -> DataFrame:
        return silver.stg_obligaciones(self.raw(OBLIGACIONES), self.clientes, self.productos, CONTEXT)

    @cached_property
    def comisiones(self) -> DataFrame:
        return silver.stg_comisiones(self.raw(COMISIONES), self.clientes, self.productos)

    @cached_property
    def errores(self) -> DataFrame:
        return rejects.err_calidad_datos(
            self.raw(MOVIMIENTOS), self.raw(OBLIGACIONES), self.raw(COMISIONES), self.clientes, self.productos, CONTEXT
        )

    @cached_property
    def dim_clientes(self) -> DataFrame:
        return gold.dim_clientes(self.clientes, CONTEXT)

    @cached_property
    def dim_productos(self) -> DataFrame:
        return gold.dim_productos(self.productos)

    @cached_property
    def transacciones(self) -> DataFrame:
        return gold.fact_transacciones(self.movimientos, self.dim_productos, CONTEXT)

    @cached_property
    def cartera(self) -> DataFrame:
        return gold.fact_cartera(self.obligaciones)

    @cached_property
    def rentabilidad(self) -> DataFrame:
        return gold.fact_rentabilidad_cliente(self.movimientos_validos, self.comisiones, self.dim_productos)

    @cached_property
    def kpi(self) -> DataFrame:
        return gold.kpi_cartera_diaria(self.cartera, self.dim_clientes, CONTEXT)


    def model(self, name: str) -> DataFrame:
        """A Silver or Gold model, or a raw table, by its table name."""
        frames = {
            "stg_clientes": lambda: self.clientes, "stg_productos": lambda: self.productos,
            "stg_sucursales": lambda: self.sucursales, "stg_movimientos": lambda: self.movimientos,
            "stg_obligaciones": lambda: self.obligaciones, "stg_comisiones": lambda: self.comisiones,
            "dim_clientes": lambda: self.dim_clientes, "dim_productos": lambda: self.dim_productos,
            "dim_geografia": lambda: gold.dim_geografia(self.spark), "dim_canal": lambda: gold.dim_canal(self.spark),
            "fact_transacciones": lambda: self.transacciones, "fact_cartera": lambda: self.cartera,
            "fact_rentabilidad_cliente": lambda: gold.fact_rentabilidad_cliente(  # from the rows that the movements are made of, too
                with_parent(self.movimientos_aceptables, self.clientes, "id_cli"), self.comisiones, self.dim_productos),
            "kpi_cartera_diaria": lambda: self.kpi,
        }
        return frames[name]() if name in frames else self.raw(name)

    @cached_property
    def kept(self) -> Kept:
        return kept_in(self.spark, "movimientos")

    def lake(self, purpose: str) -> Lake:
        return Lake(self.spark, shared_folder(self.spark, purpose))

    @cached_property
    def volumes(self) -> DataFrame:
        """Rows per month and incremental table, as if one run had loaded each month."""

        def monthly(name: str) -> DataFrame:
            month = rules.month_of(F.col(SOURCES[name].watermark)).alias("month")
            return self.source(name).groupBy(month).agg(F.count(F.lit(1)).alias("rows")).select(
                F.concat(F.lit("run-"), "month").alias("batch_id"),
                F.concat("month", F.lit("-01T02:00:00+00:00")).alias("started_at"),
                F.lit(name).alias("tabla"), "rows",
            )

        return monthly(MOVIMIENTOS).unionByName(monthly(COMISIONES))

    @cached_property
    def run_log(self) -> DataFrame:
        """The same as a nested run log; a run has at most one entry per source table."""
        entry = F.struct(
            F.lit("incremental").alias("mode"), "rows", F.lit(None).cast("bigint").alias("size_bytes"),
            F.lit(None).cast("double").alias("duration_s"), F.lit(None).cast("string").alias("path"),
        )
        return self.volumes.groupBy("batch_id", "started_at").agg(
            F.map_from_entries(F.collect_list(F.struct("tabla", entry))).alias("tables")
        )


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which is how the other engine hands them to its client."""
    return df.select(
        *(F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
          for f in df.schema)
    )


QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}
_CTES = oracle.build_ctes(CONTEXT.pii_salt, CONTEXT.run_ts)


def register(
    name: str, build: Callable[[Tables], DataFrame], twin: str | None = None, decimals: str = ""
) -> None:
    """``decimals`` names the columns that the twin returns as DECIMAL."""
    QUERIES[name] = lambda spark, folder: comparable(build(Tables(spark, folder)))
    if twin:
        TWINS[name] = oracle.assemble(oracle.as_doubles(twin, decimals), _CTES)


# Silver
register("stg_clientes", lambda t: t.clientes, "FROM t_cli")
register("stg_productos", lambda t: t.productos, "FROM t_prod",
         "tasa_ea cuota_min comision_admin")
register("stg_sucursales", lambda t: t.sucursales, "FROM t_suc",
         "latitud longitud")
register("stg_movimientos", lambda t: t.movimientos_por_pasos, "FROM t_mov",
         "vr_mov")
register("stg_obligaciones", lambda t: t.obligaciones, "FROM t_obl",
         "vr_aprobado vr_desembolsado sdo_capital vr_cuota")
register("stg_comisiones", lambda t: t.comisiones, "FROM t_com",
         "vr_comision")
register("dedup_whole_row", lambda t: distinct_rows(t.source(MOVIMIENTOS)), "SELECT DISTINCT * FROM src_mov",
         "vr_mov")
register("dedup_movimientos", lambda t: silver.unique_movements(t.raw(MOVIMIENTOS)), "FROM uniq_mov",
         "vr_mov")
register(
    "fk_valid_movimientos",
    lambda t: with_parent(with_parent(t.source(MOVIMIENTOS), t.productos, "cod_prod"), t.clientes, "id_cli")
    .select(*SOURCES[MOVIMIENTOS].columns),
    "SELECT m.* FROM src_mov m WHERE EXISTS (FROM t_cli c WHERE c.id_cli = m.id_cli) "
    "AND EXISTS (FROM t_prod p WHERE p.cod_prod = m.cod_prod)",
    "vr_mov",
)
register(
    "null_strategy_clientes",
    lambda t: apply_null_rules(t.source(CLIENTES), silver.NULL_RULES[CLIENTES]).select(
        "id_cli", "score_buro", "score_buro_es_nulo", "ciudad_res", "ciudad_res_imputada", "canal_adquis"),
    "SELECT id_cli, score_buro, score_buro IS NULL AS score_buro_es_nulo, "
    "ifnull(ciudad_res, 'DESCONOCIDA') AS ciudad_res, ciudad_res IS NULL AS ciudad_res_imputada, "
    "ifnull(canal_adquis, 'NO_REGISTRADO') AS canal_adquis FROM src_cli "
    "WHERE num_doc IS NOT NULL AND fec_nac IS NOT NULL",
)
register(
    "promedio_movil_30d",
    lambda t: t.movimientos_por_pasos.select("id_mov", "id_cli", "cod_prod", "fec_mov", "vr_mov", "promedio_movil_30d"),
    "SELECT id_mov, id_cli, cod_prod, fec_mov, vr_mov, promedio_movil_30d FROM mov_stats",
    "vr_mov",
)
register(
    "stddev_movil_30d",
    lambda t: t.movimientos_por_pasos.select("id_mov", "id_cli", "cod_prod", "fec_mov", "vr_mov", "stddev_movil_30d",
                                   "ind_sospechoso"),
    "SELECT id_mov, id_cli, cod_prod, fec_mov, vr_mov, stddev_movil_30d, ind_sospechoso FROM t_mov",
    "vr_mov",
)



def trailing_by_batches(t: Tables) -> DataFrame:
    """The trusted movements after their batches came out of order, one of them twice."""
    state = incremental.IncrementalMovements(t.lake("incremental"), CONTEXT)
    raw = t.raw(MOVIMIENTOS)
    for number in (1, 0, 2, 0):
        batch_id = BATCHES[number][0]
        state.apply(raw.where(F.col("batch_id") == batch_id), batch_id, t.productos)
    return state.stg_movimientos(t.clientes, t.productos)


register("trailing_incremental", trailing_by_batches, "FROM t_mov", "vr_mov")

# rejections and quality report
register("err_calidad_datos", lambda t: t.errores, "FROM errors")
register(
    "err_fk_huerfana",
    lambda t: rejects.orphan_rows(t.raw(MOVIMIENTOS), MOVIMIENTOS, "id_mov", t.clientes, t.productos),
    f"FROM orphan_rows WHERE tabla = '{MOVIMIENTOS}'",
)
register("err_por_tipo", lambda t: rejects.counts_by_type(t.errores),
         "SELECT tipo_error, tabla, count(*) AS n FROM rejects GROUP BY ALL")
register("dq_totales", lambda t: quality.table_counts(t.all_raw), "FROM totals")
register("dq_rechazadas", lambda t: rejects.rejected_counts(t.errores), "FROM rejected")
register("dq_resumen", lambda t: quality.conformity_summary(t.all_raw, t.errores), "FROM summary")
register("dq_pct_nulos", lambda t: quality.null_shares(t.all_raw), "FROM null_pct")
register("dq_report_silver", lambda t: quality.dq_report_silver(t.all_raw, t.errores, CONTEXT), "FROM dq_report")

# Gold
register("dim_clientes", lambda t: t.dim_clientes, "FROM d_cli")
register("dim_productos", lambda t: t.dim_productos, "FROM d_prod",
         "tasa_efectiva_anual tasa_mensual_equivalente cuota_minima comision_administracion")
register("fact_transacciones", lambda t: gold.fact_transacciones(t.movimientos_escritos, t.dim_productos, CONTEXT), "FROM f_mov",
         "vr_mov")
register("fact_cartera", lambda t: t.cartera, "SELECT * EXCLUDE (grade, permille) FROM f_obl",
         "vr_aprobado vr_desembolsado sdo_capital vr_cuota")
register("ingreso_intereses", lambda t: gold.interest_income(t.movimientos_validos, t.dim_productos), "FROM interest",
         "ingreso_intereses")
register("ingreso_comisiones", lambda t: gold.fee_income(t.comisiones), "FROM fees",
         "ingreso_comisiones")
register("rentabilidad_full_outer",
         lambda t: gold.combined_income(t.movimientos_validos, t.comisiones, t.dim_productos), "FROM income",
         "ingreso_intereses ingreso_comisiones")
register("fact_rentabilidad_cliente", lambda t: t.rentabilidad, "FROM f_rent",
         "ingreso_intereses ingreso_comisiones ingreso_total cltv_12m")
register("cltv_12m", lambda t: t.rentabilidad.select("id_cli", "periodo", "cltv_12m"),
         "SELECT id_cli, periodo, cltv_12m FROM f_rent",
         "cltv_12m")
register("top_cltv", lambda t: gold.top_clients(t.rentabilidad),
         "FROM f_rent ORDER BY cltv_12m DESC, id_cli, periodo LIMIT 10",
         "ingreso_intereses ingreso_comisiones ingreso_total cltv_12m")
register("kpi_cartera_diaria", lambda t: t.kpi, "FROM kpi",
         "monto_total_cartera monto_en_mora")
register("tasa_mora", lambda t: t.kpi.select("cod_prod", "cod_segmento", "ciudad", "tasa_mora_pct"),
         "SELECT cod_prod, cod_segmento, ciudad, tasa_mora_pct FROM kpi")
register("cartera_por_calificacion", lambda t: gold.portfolio_by_rating(t.cartera),
         "SELECT calif_regulatoria, count(*) AS obligaciones, sum(sdo_capital) AS saldo, "
         f"sum({oracle.cents('provision_estimada')})::DOUBLE / 100 AS provision FROM f_obl GROUP BY ALL",
         "saldo")


# Bronze and raw
INGESTED_AT = [datetime.fromisoformat(b[1]) for b in BATCHES]


def three_runs(t: Tables, *names: str) -> ingest.Ingestion:
    """Three ingestion runs; each sees the rows dated before its limit, as a growing source would."""
    ingestion = ingest.Ingestion(t.lake("bronze"), SOURCE_SYSTEM, {n: SOURCES[n] for n in names})
    for (batch_id, _, limit), at in zip(BATCHES, INGESTED_AT):

        def read(table, _last, limit=limit):
            rows = t.source(table.name)
            return rows.where(F.col(table.watermark) < F.lit(limit).cast("date")) if table.watermark and limit else rows

        ingestion.run(read, batch_id, at)
    return ingestion


def raw_rows(t: Tables, name: str) -> DataFrame:
    ingestion = three_runs(t, name)
    return ingest.batch_rows(ingestion.lake, SOURCES[name], ingestion.run_log())


def after_a_dead_run(t: Tables, name: str) -> DataFrame:
    """A run, a run that dies before its commit, and its repetition with the same batch id a day later."""
    table = SOURCES[name]
    ingestion = ingest.Ingestion(t.lake("recovery"), SOURCE_SYSTEM, {name: table})
    rows = t.source(name)
    (first, _, limit), (second, _, _) = BATCHES[:2]
    ingestion.run(lambda *_: rows.where(F.col(table.watermark) < F.lit(limit).cast("date")), first, INGESTED_AT[0])
    uncommitted = ingest.newer_rows(rows, table.watermark, ingestion.watermark(name))
    ingest.write_batch(ingest.with_audit(uncommitted, second, SOURCE_SYSTEM, INGESTED_AT[1]),
                       ingestion.lake.bronze_path(table), INGESTED_AT[1])
    ingestion.run(lambda *_: rows, second, INGESTED_AT[1] + timedelta(days=1))
    return ingest.raw_rows(ingestion.lake, table).select(*table.columns)


def empty_batches(t: Tables) -> DataFrame:
    """The fees, and a run that finds none after them: it is logged, but has no folder."""
    ingestion = ingest.Ingestion(t.lake("empty"), SOURCE_SYSTEM, {COMISIONES: SOURCES[COMISIONES]})
    for number in range(2):
        ingestion.run(lambda table, _last: t.source(table.name), f"b{number}", INGESTED_AT[number])
    return ingest.flat_run_log(ingestion.run_log()).select(
        "batch_id", F.col("rows").alias("filas"), F.col("path").isNotNull().alias("escrita"))


def isolated_failure(t: Tables) -> DataFrame:
    """A run in which one table fails: the others are committed, the run log has the error."""
    ingestion = ingest.Ingestion(t.lake("failing"), SOURCE_SYSTEM, {n: SOURCES[n] for n in (CLIENTES, OBLIGACIONES, PRODUCTOS)})

    def read(table, _last):
        if table.name == OBLIGACIONES:
            raise OSError("connection lost")
        return t.source(table.name)

    with suppress(ingest.IngestionFailed):
        ingestion.run(read, "b0", INGESTED_AT[0])
    log = ingestion.run_log()
    failed = log.select(F.explode("errors").alias("e")).select("e.table", "e.error", F.lit(None).cast("bigint").alias("filas"))
    done = ingest.flat_run_log(log).select("tabla", F.lit("ok").alias("estado"), F.col("rows").alias("filas"))
    return done.unionByName(failed.toDF("tabla", "estado", "filas"))


def truncate_and_load(t: Tables) -> DataFrame:
    """Raw tables loaded twice hold their rows once; a table that was never ingested says so and stays away."""
    ingestion = three_runs(t, SUCURSALES, COMISIONES)
    lines = []
    for name in (SUCURSALES, COMISIONES, PRODUCTOS):
        table = SOURCES[name]
        for _ in range(2):
            result = ingest.load_raw(ingestion, table)
        state = F.lit(result["status"]).alias("estado")
        if result["path"]:
            key = F.sum(F.length(table.key)).alias("largo_clave")
            lines.append(ingest.raw_rows(ingestion.lake, table).agg(F.count(F.lit(1)).alias("filas"), key).select(
                F.lit(name).alias("tabla"), state, "filas", "largo_clave"))
        else:
            none = F.lit(None).cast("bigint")
            lines.append(t.spark.range(1).select(F.lit(name).alias("tabla"), state, none.alias("filas"), none.alias("largo_clave")))
    return reduce(DataFrame.unionByName, lines)


def all_formats(t: Tables) -> DataFrame:
    """The branches through every file format, and what an unknown one is answered."""
    table, parts = SOURCES[SUCURSALES], []
    for file_format in ("csv", "json", "parquet"):
        path = shared_folder(t.spark, file_format)
        files.write_table(t.source(SUCURSALES), path, table, file_format)
        parts.append(files.read_table(t.spark, path, table, file_format).select(F.lit(file_format).alias("formato"), "*"))
    try:
        files.read_table(t.spark, path, table, "xml")
    except ValueError as error:
        refused = t.spark.createDataFrame([(str(error),)], "cod_suc string").select(
            F.lit("xml").alias("formato"), "cod_suc", *(F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema if f.name != "cod_suc"))
        parts.append(refused)
    return reduce(DataFrame.unionByName, parts)


def ranged_extract(t: Tables, parts: int = 8) -> DataFrame:
    """The movements by ranges of date and id, each a scan of its own, and whether the row's part keeps within twice its share."""
    table, path = SOURCES[MOVIMIENTOS], shared_folder(t.spark, "ranges")
    files.write_table(t.source(MOVIMIENTOS), path, table)
    stored = files.read_table(t.spark, path, table)
    rows = ranges.read_parts(stored, ranges.key_parts(stored.select("fec_mov", "id_mov"), ("fec_mov", "id_mov"), parts), "parte")
    limit = 2 * stored.count() / parts
    sizes = rows.groupBy("parte").agg((F.count(F.lit(1)) <= limit).alias("parte_acotada"))
    # one row per part, whatever the table's size: dealt out by part, the rows of each would lie in one task
    return rows.join(F.broadcast(sizes), "parte").drop("parte")


def late_rows(t: Tables) -> DataFrame:
    """Three runs that re-read five days: some rows of the days before a limit arrive a run late, rows dated 2031 in the first."""
    table = SOURCES[MOVIMIENTOS]
    ingestion = ingest.Ingestion(t.lake("late"), SOURCE_SYSTEM, {MOVIMIENTOS: table}, overlap_days=5)
    late = F.pmod(F.xxhash64("id_mov"), F.lit(5)) == 0
    run_of, day = F.lit(len(BATCHES)), F.col("fec_mov")
    for number, (_, _, limit) in reversed(list(enumerate(BATCHES[:-1], 1))):
        end = F.lit(limit).cast("date")
        own = F.when(late & (F.date_sub(end, 3) <= day), number + 1).otherwise(number)
        run_of = F.when(day < end, own).otherwise(run_of)
    rows = t.source(MOVIMIENTOS).withColumn("_run", F.when(day > F.lit(AS_OF).cast("date"), 1).otherwise(run_of))
    for number, ((batch_id, _, _), at) in enumerate(zip(BATCHES, INGESTED_AT), 1):
        ingestion.run(lambda *_, n=number: rows.where(F.col("_run") <= n), batch_id, at)
    return ingest.raw_rows(ingestion.lake, table).select(*table.columns)


def next_watermarks(t: Tables) -> DataFrame:
    parts = []
    for name in (MOVIMIENTOS, COMISIONES):
        column = SOURCES[name].watermark
        batch = ingest.newer_rows(t.source(name), column, "2024-12-31")
        parts.append(ingest.next_watermark(batch, column, "2024-12-31").select(F.lit(name).alias("tabla"), "*"))
    return reduce(DataFrame.unionByName, parts)


def round_trip(t: Tables, name: str) -> DataFrame:
    path = shared_folder(t.spark, "files")
    files.write_table(t.source(name), path, SOURCES[name])
    return files.read_table(t.spark, path, SOURCES[name])


def partition_counts(t: Tables) -> DataFrame:
    table = SOURCES[MOVIMIENTOS]
    stored = three_runs(t, MOVIMIENTOS).lake.bronze(table)
    return stored.groupBy("year", "month", "day", "batch_id").agg(F.count(F.lit(1)).alias("n"))


_BATCH_TIMES = " ".join(f"WHEN '{b[0]}' THEN TIMESTAMP '{b[1][:19]}'" for b in BATCHES)
register("bronze_full_extract", lambda t: ingest.newer_rows(t.source(CLIENTES), "fec_alta", None), "FROM src_cli")
register("bronze_incremental_extract", lambda t: ingest.newer_rows(t.source(MOVIMIENTOS), "fec_mov", "2025-03-01"),
         "FROM src_mov WHERE fec_mov > DATE '2025-03-01'", "vr_mov")
register("bronze_next_watermark", next_watermarks,
         " UNION ALL ".join(f"SELECT '{n}' AS tabla, max({c}) AS last_value FROM src_{s} "
                            f"WHERE {c} > DATE '2024-12-31'"
                            for n, c, s in ((MOVIMIENTOS, "fec_mov", "mov"), (COMISIONES, "fec_cobro", "com"))))
register("bronze_recovery", lambda t: after_a_dead_run(t, COMISIONES), "FROM src_com", "vr_comision")
register("bronze_empty_batch", empty_batches,
         "SELECT 'b0' AS batch_id, count(*) AS filas, TRUE AS escrita FROM src_com UNION ALL SELECT 'b1', 0, FALSE")
register("bronze_failure_isolation", isolated_failure,
         " UNION ALL ".join(f"SELECT '{n}' AS tabla, 'ok' AS estado, count(*) AS filas FROM src_{oracle.SHORT[n]}" for n in (CLIENTES, PRODUCTOS))
         + f" UNION ALL SELECT '{OBLIGACIONES}', 'connection lost', NULL")
register("raw_truncate_load", truncate_and_load,
         " UNION ALL ".join(f"SELECT '{n}' AS tabla, 'ok' AS estado, count(*) AS filas, sum(length({SOURCES[n].key}))::BIGINT AS largo_clave "
                            f"FROM src_{oracle.SHORT[n]}" for n in (SUCURSALES, COMISIONES))
         + f" UNION ALL SELECT '{PRODUCTOS}', 'sin_datos', NULL, NULL")
register("source_parquet_roundtrip", lambda t: round_trip(t, OBLIGACIONES), "FROM src_obl",
         "vr_aprobado vr_desembolsado sdo_capital vr_cuota")
register("source_format_dispatch", all_formats,
         " UNION ALL ".join(f"SELECT '{f}' AS formato, * FROM src_suc" for f in ("csv", "json", "parquet"))
         + " UNION ALL SELECT 'xml', 'unsupported format: xml', NULL, NULL, NULL, NULL, NULL, NULL, NULL", "latitud longitud")
register("extract_ranges", ranged_extract, "SELECT *, TRUE AS parte_acotada FROM src_mov", "vr_mov")
register("late_rows", late_rows, "FROM src_mov", "vr_mov")
register("bronze_audit_columns",
         lambda t: ingest.with_audit(t.source(OBLIGACIONES), BATCHES[-1][0], SOURCE_SYSTEM, INGESTED_AT[-1]),
         "FROM raw_obl", "vr_aprobado vr_desembolsado sdo_capital vr_cuota")
register("bronze_partition_layout", partition_counts,
         "SELECT strftime(day_of, '%Y') AS year, strftime(day_of, '%m') AS month, strftime(day_of, '%d') AS day, "
         f"batch_id, count(*) AS n FROM (SELECT *, CASE batch_id {_BATCH_TIMES} END AS day_of FROM raw_mov) "
         "GROUP BY ALL")
register("raw_latest_batch", lambda t: raw_rows(t, CLIENTES), "FROM raw_cli")
register("raw_all_batches", lambda t: raw_rows(t, MOVIMIENTOS), "FROM raw_mov", "vr_mov")
register("source_csv_roundtrip", lambda t: round_trip(t, PRODUCTOS), "FROM src_prod",
         "tasa_ea cuota_min comision_admin")
register("source_json_roundtrip", lambda t: round_trip(t, CLIENTES), "FROM src_cli")
register("source_row_counts", lambda t: quality.table_counts(t.all_sources),
         " UNION ALL ".join(f"SELECT '{n}' AS tabla, count(*) AS filas_totales FROM src_{s}"
                            for n, s in oracle.SHORT.items()))
register(
    "nullable_int_repair",
    lambda t: t.source(CLIENTES).select(
        "id_cli",
        F.when(F.col("score_buro") % 7 == 0, "n/a").otherwise(F.col("score_buro").cast("double").cast("string"))
        .alias("texto"),
    ).select("id_cli", "texto", repaired_int(F.col("texto")).alias("score_buro")),
    "SELECT id_cli, if(score_buro % 7 = 0, 'n/a', score_buro::VARCHAR || '.0') AS texto, "
    "if(score_buro % 7 = 0, NULL, score_buro) AS score_buro FROM src_cli",
)
register(
    "num_cuenta",
    lambda t: t.source(OBLIGACIONES).select(
        "id_oblig", rules.account_number(F.col("id_cli"), F.col("cod_prod")).alias("num_cuenta")),
    "SELECT id_oblig, '8' || substr(id_cli, 4) || substr(cod_prod, 4) AS num_cuenta FROM src_obl",
)


def snapshot_history(t: Tables) -> DataFrame:
    """Yesterday's snapshot, then today's from two ratings, then today's again from another two."""
    lake, path = t.lake("snapshots"), "gold/kpi_cartera_diaria"
    runs = (
        (CONTEXT.as_of - timedelta(days=1), F.lit(True)),
        (CONTEXT.as_of, F.col("calif_riesgo_fuente") != "VIGILANCIA"),
        (CONTEXT.as_of, F.col("calif_riesgo_fuente") != "NORMAL"),
    )
    for number, (day, condition) in enumerate(runs):
        new = gold.kpi_cartera_diaria(t.cartera.where(condition), t.dim_clientes, replace(CONTEXT, as_of=day))
        keys = layers.MODELS["kpi_cartera_diaria"].snapshot_keys
        merge_snapshot(lake, new, f"{lake.root}/{path}", "fecha_corte", keys, f"{lake.root}/staging/{number}")
    return t.spark.read.schema(new.schema).parquet(f"{lake.root}/{path}")


_RISK_KPI = _CTES["kpi"].replace("FROM t_obl", "FROM (FROM t_obl WHERE calif_riesgo <> '{}') t_obl")
register(
    "kpi_snapshot_upsert", snapshot_history,
    f"""SELECT * REPLACE (fecha_corte - 1 AS fecha_corte) FROM kpi
        UNION ALL FROM ({_RISK_KPI.format('NORMAL')})
        UNION ALL SELECT o.* FROM ({_RISK_KPI.format('VIGILANCIA')}) o
        WHERE NOT EXISTS (FROM t_obl l JOIN t_cli c USING (id_cli)
                          WHERE l.calif_riesgo <> 'NORMAL' AND l.cod_prod = o.cod_prod
                            AND c.cod_segmento IS NOT DISTINCT FROM o.cod_segmento AND c.ciudad_res = o.ciudad)""",
    "monto_total_cartera monto_en_mora",
)

def distinct_by_batches(t: Tables) -> DataFrame:
    """Distinct loans and late clients of the snapshot, merged from the bitmaps of three batches; one sends loans of another again."""
    clients = t.dim_clientes.select("id_cli", "cod_segmento", F.col("ciudad_res").alias("ciudad"))
    rows = t.cartera.join(clients, "id_cli")
    state = DistinctCounts(t.lake("distinct"), "cartera", ("cod_prod", "cod_segmento", "ciudad"), {
        "total_obligaciones_activas": ("id_oblig", "TRUE"), "clientes_con_mora": ("id_cli", "dias_mora_act > 0")})
    part = F.pmod(F.xxhash64("id_oblig"), F.lit(3))
    for number, chosen in enumerate((part == 0, part == 1, part != 1)):
        state.apply(rows.where(chosen), f"lote-{number}")
    return state.counts()


register("kpi_distinct_merged", distinct_by_batches,
         "SELECT cod_prod, cod_segmento, ciudad, total_obligaciones_activas, clientes_con_mora FROM kpi")


def profiles_from_footers(t: Tables) -> DataFrame:
    """Rows and missing values of the ingested tables, out of the footers of their batches."""
    ingestion = three_runs(t, *SOURCES)
    log = ingestion.run_log()
    tables = {name: (ingest.batch_paths(table, log), table.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "))
              for name, table in SOURCES.items()}
    return footers.profiles(t.spark, tables, quality.WATCHED_NULLS)


register("dq_from_footers", profiles_from_footers,
         "SELECT tabla, NULL::VARCHAR AS columna, filas_totales AS filas, NULL::BIGINT AS nulos FROM totals UNION ALL "
         + " UNION ALL ".join(f"SELECT '{n}', '{c}', count(*), count(*) - count({c}) FROM raw_{oracle.SHORT[n]}"
                              for n, columns in quality.WATCHED_NULLS.items() for c in columns))


def clustered_files(t: Tables, files_written: int = 48) -> DataFrame:
    """How a filter on the first value of each cluster column fares: at most a third of the files that it touches without the order."""
    columns, folder = ("cod_prod", "cod_canal"), shared_folder(t.spark, "clustered")
    t.source(MOVIMIENTOS).repartition(files_written).write.parquet(f"{folder}/plain")
    plain = t.spark.read.parquet(f"{folder}/plain")
    clustered(plain, columns, files_written).write.parquet(f"{folder}/ordered")

    def touched(kind: str) -> DataFrame:
        rows = t.spark.read.parquet(f"{folder}/{kind}")
        spans = rows.groupBy(F.input_file_name()).agg(
            F.count(F.lit(1)).alias("n"), *(F.min(c).alias(c) for c in columns), *(F.max(c).alias(f"_{c}") for c in columns))
        firsts = rows.agg(*(F.min(c).alias(f"first_{c}") for c in columns))
        hit = [F.struct(F.lit(c).alias("columna"), (F.col(f"first_{c}") >= F.col(c)).cast("int").alias("hit"), "n") for c in columns]
        return spans.join(firsts, F.col("n") > 0).select(F.inline(F.array(*hit))).groupBy("columna").agg(
            F.sum("hit").alias(f"archivos_{kind}"), F.sum("n").alias(f"filas_{kind}"))

    return touched("ordered").join(touched("plain"), "columna").select(
        "columna", (3 * F.col("archivos_ordered") <= F.col("archivos_plain")).alias("hasta_un_tercio"), F.col("filas_ordered").alias("filas"))


register("clustered_files", clustered_files,
         "SELECT unnest(['cod_prod', 'cod_canal']) AS columna, TRUE AS hasta_un_tercio, (SELECT count(*) FROM src_mov) AS filas")


def stream_of_first_copies(t: Tables) -> DataFrame:
    """The fees through the deduplicating feed; between its calls the source sends a batch again under another id."""
    table = SOURCES[COMISIONES]
    ingestion = three_runs(t, COMISIONES)
    target = f"{ingestion.lake.root}/feed"
    feed_first_copies(ingestion.lake, table, target, "90 days")
    again = ingestion.lake.bronze(table).where(F.col("batch_id") == BATCHES[1][0]).select(*table.columns)
    at = INGESTED_AT[-1] + timedelta(days=1)
    ingest.write_batch(ingest.with_audit(again, "batch-again", SOURCE_SYSTEM, at), ingestion.lake.bronze_path(table), at)
    feed_first_copies(ingestion.lake, table, target, "90 days")
    return t.spark.read.schema(table.bronze_schema).parquet(target).select(*table.columns)


register("stream_first_copies", stream_of_first_copies, "FROM src_com", "vr_comision")

# monitoring
_CTES["volumes"] = " UNION ALL ".join(
    f"SELECT 'run-' || strftime({c}, '%Y-%m') AS batch_id, strftime({c}, '%Y-%m-01T02:00:00+00:00') AS started_at, "
    f"'{n}' AS tabla, count(*) AS rows FROM src_{s} GROUP BY ALL"
    for n, c, s in ((MOVIMIENTOS, "fec_mov", "mov"), (COMISIONES, "fec_cobro", "com")))
_CTES["volume_means"] = """
    SELECT cur.*, count(old.rows) AS k, sum(old.rows) AS total
    FROM volumes cur JOIN volumes old ON old.tabla = cur.tabla
    WHERE old.batch_id IN (SELECT DISTINCT v.batch_id FROM volumes v WHERE v.started_at < cur.started_at
                           ORDER BY v.batch_id DESC LIMIT 7)
    GROUP BY ALL"""
register("run_log_flat", lambda t: ingest.flat_run_log(t.run_log).select("batch_id", "started_at", "tabla", "mode", "rows"),
         "SELECT batch_id, started_at, tabla, 'incremental' AS mode, rows FROM volumes")
register(
    "run_log_json",
    lambda t: t.run_log.select(F.to_json(F.struct("*")).alias("doc"))
    .select(F.from_json("doc", ingest.RUN_LOG_SCHEMA).alias("log"))
    .select("log.batch_id", F.try_element_at("log.tables", F.lit(MOVIMIENTOS))["rows"].alias("rows")),
    f"SELECT batch_id, max(rows) FILTER (tabla = '{MOVIMIENTOS}') AS rows FROM volumes GROUP BY ALL",
)
register("volume_history_last7", lambda t: monitor.latest_volumes(t.volumes),
         "FROM volumes WHERE batch_id IN (SELECT DISTINCT v.batch_id FROM volumes v ORDER BY 1 DESC LIMIT 7)")
register(
    "volume_anomaly", lambda t: monitor.volume_anomalies(t.volumes),
    f"""SELECT batch_id, started_at, tabla, rows AS current_rows, {oracle.half_up('total', 'k')} AS avg_last_7_runs,
               {oracle.half_up_pct('abs(rows * k - total)', 'total')} AS pct_diff
        FROM volume_means WHERE k >= 3 AND abs(rows * k - total) * 10 > total * 3""",
)


def logged_volume_events(t: Tables) -> DataFrame:
    """The events that ingestion itself has written: the fees of five months, the last of them halved."""
    ingestion = ingest.Ingestion(t.lake("volumes"), SOURCE_SYSTEM, {COMISIONES: SOURCES[COMISIONES]})
    rows, first = t.source(COMISIONES), date(2024, 1, 1)
    for number in range(5):
        start, end = (date(first.year, 1 + n, 1) for n in (number, number + 1))
        month = rows.where((F.col("fec_cobro") >= F.lit(start)) & (F.col("fec_cobro") < F.lit(end)))
        if number == 4:
            month = month.where(F.substring("id_comision", -1, 1).isin("0", "1", "2", "3"))
        ingestion.run(lambda *_, month=month: month, f"b{number}", datetime.fromisoformat(f"{start}T02:00:00+00:00"))
    events = t.spark.read.schema(monitor.EVENT_SCHEMA).parquet(ingestion.lake.path("ops", "pipeline_events"))
    return events.select("event_type", "created_at", *(F.col("details")[c].alias(c) for c in ("table", "current_rows", "avg_last_7_runs", "pct_diff")))


def failed_stage_event(t: Tables) -> DataFrame:
    """What a daily run leaves that fails in Bronze: the event, and how many rows the other tables have committed."""
    ingestion = ingest.Ingestion(t.lake("failed"), SOURCE_SYSTEM, {n: SOURCES[n] for n in (PRODUCTOS, SUCURSALES)})

    def read(table, _last):
        if table.name == SUCURSALES:
            raise OSError("connection lost")
        return t.source(table.name)

    with suppress(ingest.IngestionFailed):
        layers.run_pipeline(ingestion, read, CONTEXT)
    events = t.spark.read.schema(monitor.EVENT_SCHEMA).parquet(ingestion.lake.path("ops", "pipeline_events"))
    committed = ingest.raw_rows(ingestion.lake, SOURCES[PRODUCTOS]).count()
    return events.select("event_type", F.col("details")["task_name"].alias("etapa"),
                         F.col("details")["error_message"].contains(SUCURSALES).alias("nombra_la_tabla"),
                         F.lit(committed).cast("bigint").alias("filas_confirmadas"))


_MONTHS = " UNION ALL ".join(
    f"SELECT {n} AS n, count(*) AS filas FROM src_com WHERE fec_cobro >= DATE '2024-01-01' + INTERVAL {n} MONTH "
    f"AND fec_cobro < DATE '2024-01-01' + INTERVAL {n + 1} MONTH"
    + (" AND right(id_comision, 1) IN ('0', '1', '2', '3')" if n == 4 else "") for n in range(5))
register("volume_events", logged_volume_events, f"""
    FROM (WITH m AS ({_MONTHS}),
    p AS (SELECT m.n, m.filas, count(o.filas) AS k, sum(o.filas) AS total FROM m JOIN m o ON o.n < m.n GROUP BY ALL)
    SELECT 'VOLUME_ANOMALY' AS event_type, '2024-0' || (n + 1) || '-01T02:00:00+00:00' AS created_at, '{COMISIONES}' AS "table",
           filas::VARCHAR AS current_rows, printf('%.2f', {oracle.half_up('total', 'k')}) AS avg_last_7_runs,
           printf('%.2f', {oracle.half_up_pct('abs(filas * k - total)', 'total')}) AS pct_diff
    FROM p WHERE filas > 0 AND k >= 3 AND total > 0 AND abs(filas * k - total) * 10 > total * 3)""")
register("failure_event", failed_stage_event,
         "SELECT 'TASK_FAILURE' AS event_type, 'bronze' AS etapa, TRUE AS nombra_la_tabla, count(*) AS filas_confirmadas FROM src_prod")
register("pipeline_summary", lambda t: monitor.pipeline_summary(t.movimientos, t.transacciones, t.cartera, t.errores),
         "SELECT (SELECT count(*) FROM t_mov) AS silver_movimientos, (SELECT count(*) FROM f_mov) AS gold_transacciones,"
         " (SELECT count(*) FROM f_obl) AS gold_cartera, (SELECT count(*) FROM rejects) AS quality_errors")
register("null_rate_profile", lambda t: quality.null_rate_profile(t.all_sources),
         " UNION ALL ".join(
             f"SELECT '{n}' AS tabla, count(*) AS filas, "
             + oracle.half_up_pct(" + ".join(f"count(*) - count({c})" for c in SOURCES[n].columns),
                                  f"count(*) * {len(SOURCES[n].columns)}")
             + f" AS pct_nulos_promedio FROM src_{s}" for n, s in oracle.SHORT.items()))
register("pii_mask_check", lambda t: quality.mask_check(t.clientes),
         " UNION ALL ".join(
             f"SELECT '{c}' AS columna, count({c}) AS valores, "
             f"count(*) FILTER (length({c}) <> 64 OR {c} SIMILAR TO '.*[^0-9a-f].*') AS sin_mascara FROM t_cli"
             for c in ("nomb_cli_hash", "apell_cli_hash", "num_doc_hash")))

# table tests: those of the models, and the same kinds on raw tables, which do fail
_TWIN_TABLES = {
    "stg_clientes": "t_cli", "stg_productos": "t_prod", "stg_sucursales": "t_suc", "stg_movimientos": "t_mov",
    "stg_obligaciones": "t_obl", "stg_comisiones": "t_com", "dim_clientes": "d_cli", "dim_productos": "d_prod",
    "fact_transacciones": "f_mov", "fact_cartera": "f_obl", "fact_rentabilidad_cliente": "f_rent",
    "kpi_cartera_diaria": "kpi", **{n: f"raw_{s}" for n, s in oracle.SHORT.items()},
    "dim_canal": "(SELECT unnest(['APP', 'WEB', 'CORRESPONSAL', 'OFICINA', 'CAJERO']) AS cod_canal, "
                 "unnest(['DIGITAL', 'DIGITAL', 'FISICO', 'FISICO', 'FISICO']) AS tipo_canal)",
    "dim_geografia": "(SELECT unnest(['BOG', 'MED', 'CAL', 'BAQ', 'BGA', 'CDMX', 'GDL', 'MTY', 'LIM', 'AQP', 'SCL', "
                     "'VAP', 'BUE', 'COR']) AS cod_ciudad)",
}
RAW_TESTS: tuple[checks.Test, ...] = (
    NotNull(CLIENTES, "num_doc"), NotNull(OBLIGACIONES, "id_cli"), Unique(MOVIMIENTOS, "id_mov"),
    Unique(OBLIGACIONES, "cod_prod"), Accepted(MOVIMIENTOS, "cod_canal", ("APP", "WEB")),
    Accepted(CLIENTES, "cod_segmento", ("BAS", "STD")), Related(MOVIMIENTOS, "id_cli", "stg_clientes", "id_cli"),
    Related(COMISIONES, "id_cli", "stg_clientes", "id_cli"),
    checks.NoRows("vr_mov_positivo", MOVIMIENTOS, "vr_mov <= 0"),
    checks.NoRows("dias_mora_no_negativo", OBLIGACIONES, "dias_mora_act < 0"),
)


def twin_of_test(test: checks.Test) -> str:
    table, column = _TWIN_TABLES[test.table], getattr(test, "column", "")
    if isinstance(test, NotNull):
        found = f"SELECT count(*) - count({column}) FROM {table}"
    elif isinstance(test, Accepted):
        values = ", ".join(f"'{v}'" for v in test.values)
        found = f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({values})"
    elif isinstance(test, checks.NoRows):
        found = f"SELECT count(*) FROM {table} WHERE {test.condition}"
    elif isinstance(test, Unique):
        found = f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL " \
                "GROUP BY 1 HAVING count(*) > 1)"
    else:
        found = f"SELECT count(*) FROM {table} x WHERE {column} IS NOT NULL AND NOT EXISTS " \
                f"(SELECT 1 FROM {_TWIN_TABLES[test.parent]} p WHERE p.{test.parent_column} = x.{column})"
    return f"SELECT '{test.name}' AS prueba, ({found}) AS fallas"


def register_tests(name: str, *kinds: type, only: str = "") -> None:
    chosen = [x for x in (*layers.ALL_TESTS, *RAW_TESTS) if isinstance(x, kinds) and x.name.startswith(only)]
    tables = {x.table for x in chosen} | {x.parent for x in chosen if isinstance(x, Related)}
    register(name, lambda t: checks.run_tests({n: t.model(n) for n in tables}, chosen),
             " UNION ALL ".join(map(twin_of_test, chosen)))


register_tests("test_not_null", NotNull)
register_tests("test_unique", Unique)
register_tests("test_accepted_values", Accepted)
register_tests("test_relationships", Related)
register_tests("test_vr_mov_positivo", checks.NoRows, only="vr_mov")
register_tests("test_dias_mora", checks.NoRows, only="dias_mora")


def pipeline_tests(t: Tables) -> DataFrame:
    """The whole daily run into a lake of its own, then its tests on the stored tables."""
    ingestion = ingest.Ingestion(t.lake("pipeline"), SOURCE_SYSTEM)
    warehouse = layers.run_pipeline(ingestion, lambda table, _last: t.source(table.name), CONTEXT, test=False)
    return warehouse.test_results()


register("dq_test_results", pipeline_tests, " UNION ALL ".join(map(twin_of_test, layers.ALL_TESTS)))

# controlled defects
SHARE = 0.01


def _columns(short: str) -> list[str]:
    return SOURCES[{s: n for n, s in oracle.SHORT.items()}[short]].columns


def _digest(short: str, seed: str) -> str:
    return f"md5(concat_ws('|', {', '.join(f"ifnull({c}::VARCHAR, '')" for c in _columns(short))}, '{seed}'))"


def _ranked(short: str, seed: str) -> str:
    """Source rows with digest, rank and size of the sample, for the twins."""
    columns = ", ".join(f"{c} NULLS FIRST" for c in _columns(short))
    return (f"(SELECT *, row_number() OVER (ORDER BY h, {columns}) AS rank FROM (SELECT *, "
            f"{_digest(short, seed)} AS h, floor(count(*) OVER () * {SHARE}::DOUBLE) AS size FROM src_{short}))")


def _number(start: int, low: int, high: int) -> str:
    return f"({low} + ('0x' || substr(h, {start}, 8))::BIGINT % {high - low + 1})::INT"


register("inject_duplicados",
         lambda t: faults.repeat_rows(t.source(MOVIMIENTOS), SHARE, MOVIMIENTOS, "id_mov", "dup").table,
         f"FROM src_mov UNION ALL SELECT * EXCLUDE (h, rank, size) FROM {_ranked('mov', 'dup')} "
         "WHERE rank <= size", "vr_mov")
register("inject_fechas",
         lambda t: faults.shift_dates(t.source(MOVIMIENTOS), SHARE, "fec_mov", MOVIMIENTOS, "id_mov",
                                      date(2025, 7, 31), "fec").table,
         f"""SELECT * EXCLUDE (h, rank, size) REPLACE (CASE WHEN rank > size THEN fec_mov
                 WHEN rank <= size // 2 THEN DATE '2025-07-31' + {_number(9, *faults.FUTURE_DAYS)}
                 ELSE DATE '2015-01-01' - {_number(17, *faults.PAST_DAYS)} END AS fec_mov)
             FROM {_ranked('mov', 'fec')}""", "vr_mov")
register("inject_fk",
         lambda t: faults.orphan_keys(t.source(COMISIONES), SHARE, "id_cli", COMISIONES, "id_comision", "fk").table,
         "SELECT * EXCLUDE (h, rank, size) REPLACE (CASE WHEN rank > size THEN id_cli "
         f"ELSE '{faults.ORPHAN_PREFIX}' || ({faults.FIRST_ORPHAN - 1} + rank)::VARCHAR END AS id_cli) FROM {_ranked('com', 'fk')}",
         "vr_comision")
register("inject_signo",
         lambda t: faults.flip_signs(t.source(MOVIMIENTOS), SHARE, "vr_mov", MOVIMIENTOS, "id_mov", "sig").table,
         "SELECT * EXCLUDE (h, rank, size) REPLACE (if(rank > size, vr_mov, -abs(vr_mov)) AS vr_mov) "
         f"FROM {_ranked('mov', 'sig')}", "vr_mov")
register("inject_saldo",
         lambda t: faults.inflate_balances(t.source(OBLIGACIONES), SHARE, "sdo_capital", "vr_aprobado", OBLIGACIONES,
                                           "id_oblig", "sal").table,
         f"""SELECT * EXCLUDE (h, rank, size) REPLACE (if(rank > size, sdo_capital::DOUBLE,
                 {oracle.half_up(oracle.cents('vr_aprobado') + ' * ' + _number(9, *faults.INFLATION_PERCENT), '10000')})
                 AS sdo_capital) FROM {_ranked('obl', 'sal')}""",
         "vr_aprobado vr_desembolsado vr_cuota")
_BLANKED = ("num_cuotas_pend", "calif_riesgo")
register("inject_nulos",
         lambda t: faults.blank_values(t.source(OBLIGACIONES), 0.05, list(_BLANKED), "nul"),
         "SELECT * REPLACE (" + ", ".join(
             f"CASE WHEN ('0x' || substr({_digest('obl', f'nul|{c}')}, 1, 8))::BIGINT >= {int(0.05 * 2**32)} "
             f"THEN {c} END AS {c}" for c in _BLANKED) + ") FROM src_obl",
         "vr_aprobado vr_desembolsado sdo_capital vr_cuota")
register(
    "anomaly_log_summary",
    lambda t: faults.counts_by_kind(
        inject_all(t.all_sources, date(2025, 7, 31), "log", shared_folder(t.spark, "faults")).log),
    """SELECT tipo_anomalia, sum(floor(n::DOUBLE * share::DOUBLE))::BIGINT AS n FROM (
           SELECT 'DUPLICADO_EXACTO' AS tipo_anomalia, 0.003 AS share, count(*) AS n FROM src_mov
           UNION ALL SELECT k, s, c + floor(c::DOUBLE * 0.003::DOUBLE)
                     FROM (VALUES ('FECHA_FUERA_DE_RANGO', 0.002), ('FK_HUERFANA', 0.0015),
                                  ('CAMPO_INCONSISTENTE', 0.002)) v(k, s), (SELECT count(*) AS c FROM src_mov)
           UNION ALL SELECT k, 0.002, c FROM (VALUES ('FECHA_FUERA_DE_RANGO'), ('CAMPO_INCONSISTENTE')) v(k),
                                             (SELECT count(*) AS c FROM src_obl)
           UNION ALL SELECT 'FK_HUERFANA', 0.0015, count(*) FROM src_com)
       GROUP BY ALL""",
)
