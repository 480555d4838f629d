"""The six source tables, derived from the TPC-H-like driver tables (see FIXTURES.md, section 3).

Each table is a list of (column, expression). The expressions use only SQL that Spark and DuckDB
read alike, so the oracle derives the same rows from the same files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SUCURSALES

AS_OF = "2025-12-31"
SOURCE_SYSTEM = "core-bancario"
# Three ingestion runs. Rows of the incremental tables belong to the first run whose
# limit date they precede; full tables are taken from the last run.
BATCHES = (
    ("batch-000000000001", "2025-10-31T02:00:00+00:00", "2024-07-01"),
    ("batch-000000000002", "2025-11-30T02:00:00+00:00", "2025-01-01"),
    ("batch-000000000003", "2025-12-31T02:00:00+00:00", None),
)


def _padded(prefix: str, number: str, width: int) -> str:
    """At least ``width`` digits; a longer number keeps all of its digits."""
    digits = f"cast({number} as string)"
    return f"concat('{prefix}', lpad({digits}, cast(greatest({width}, length({digits})) as int), '0'))"


def _choice(selector: str, *values: str) -> str:
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1]))
    return f"case {selector} {arms} else '{values[-1]}' end"


def _day(first: str, offset: str) -> str:
    return f"date '{first}' + cast({offset} as int)"


CLIENT_EXPRESSIONS = [
    ("id_cli", _padded("CLI", "c_custkey", 6)),
    ("nomb_cli", "c_name"),
    ("apell_cli", "n_name"),
    ("tip_doc", _choice("c_custkey % 10", "CE", "PASAPORTE", "DNI", "CC")),
    ("num_doc", "case when c_custkey % 211 <> 5 then cast(10000000 + c_custkey * 7919 as string) end"),
    ("fec_nac", f"case when c_custkey % 223 <> 7 then {_day('1945-01-01', '(c_custkey * 397) % 21900')} end"),
    ("fec_alta", _day("2015-01-01", "(c_custkey * 53) % 3400")),
    ("cod_segmento",
     "case when c_custkey % 97 = 3 then null when c_mktsegment = 'AUTOMOBILE' then 'ELT' "
     "when c_mktsegment = 'BUILDING' then 'STD' when c_mktsegment = 'FURNITURE' then 'PRM' else 'BAS' end"),
    ("score_buro", "case when c_custkey % 20 <> 1 then cast(150 + (c_custkey * 31) % 801 as int) end"),
    ("ciudad_res", "case when c_custkey % 20 <> 2 then n_name end"),
    ("depto_res", "r_name"),
    ("estado_cli",
     "case when c_custkey % 33 = 0 then 'BLOQUEADO' when c_custkey % 14 = 0 then 'INACTIVO' else 'ACTIVO' end"),
    ("canal_adquis",
     "case when c_custkey % 20 <> 3 then "
     + _choice("c_custkey % 4", "APP", "WEB", "CORRESPONSAL", "REFERIDO") + " end"),
]

PRODUCT_EXPRESSIONS = [
    ("cod_prod", _padded("PRD", "p_partkey", 6)),
    ("desc_prod", "p_name"),
    ("tip_prod", _choice("p_partkey % 8", "CRED_LIBRE_INVERSION", "CRED_ROTATIVO", "TARJETA_DIGITAL",
                         "CUENTA_AHORRO_DIGITAL", "PAGO_PSE", "TRANSFERENCIA_ACH", "CORRESPONSALIA", "RECARGA")),
    ("tasa_ea",
     "cast(case when p_partkey % 8 <= 2 then (1800 + (p_partkey * 13) % 2000) / 100.0 "
     "when p_partkey % 8 = 3 then (50 + (p_partkey * 7) % 350) / 100.0 else 0 end as decimal(6,2))"),
    ("plazo_max_meses", "case when p_partkey % 8 = 0 then cast(12 + p_partkey % 49 as int) end"),
    ("cuota_min",
     "cast(case when p_partkey % 8 <= 2 then 40000 + (p_partkey * 101) % 260000 else 0 end as decimal(14,2))"),
    ("comision_admin",
     "case when p_partkey % 20 <> 4 then cast(1500 + (p_partkey * 37) % 50000 as decimal(14,2)) end"),
    ("estado_prod", "case when p_partkey % 10 = 9 then 'INACTIVO' else 'ACTIVO' end"),
]

BRANCH_EXPRESSIONS = [
    ("cod_suc", _padded("SUC", "s_suppkey", 4)),
    ("nom_suc", "s_name"),
    ("tip_punto",
     "case when s_suppkey % 20 < 3 then 'OFICINA' when s_suppkey % 20 < 7 then 'CAJERO' else 'CORRESPONSAL' end"),
    ("ciudad", "n_name"),
    ("depto", "r_name"),
    ("latitud", "case when s_suppkey % 20 <> 5 then cast((s_suppkey * 37) % 60 - 30 as decimal(9,6)) end"),
    ("longitud", "case when s_suppkey % 20 <> 6 then cast((s_suppkey * 53) % 120 - 110 as decimal(9,6)) end"),
    ("activo", "s_suppkey % 20 <> 9"),
]

MOVEMENT_EXPRESSIONS = [
    ("id_mov", _padded("MOV", "l_orderkey * 10 + l_linenumber", 9)),
    ("id_cli",
     f"case when l_orderkey % 167 = 3 then {_padded('CLIX', 'l_orderkey', 5)} "
     f"else {_padded('CLI', 'o_custkey', 6)} end"),
    ("cod_prod", _padded("PRD", "l_partkey", 6)),
    ("num_cuenta",
     f"concat('8', {_padded('', 'o_custkey', 6)}, {_padded('', 'l_partkey', 6)})"),
    ("fec_mov",
     f"case when l_orderkey % 251 = 7 then {_day('2031-01-01', 'l_partkey % 300')} "
     f"when l_orderkey % 251 = 8 then {_day('2008-01-01', 'l_partkey % 300')} "
     f"else {_day('2024-01-01', '(l_orderkey * 7 + l_linenumber * 31 + l_partkey) % 540')} end"),
    ("hra_mov",
     "concat(lpad(cast((l_partkey + l_linenumber * 5) % 24 as string), 2, '0'), ':', "
     "lpad(cast(l_suppkey % 60 as string), 2, '0'), ':', lpad(cast(l_orderkey % 60 as string), 2, '0'))"),
    ("vr_mov",
     "cast(cast(l_extendedprice as decimal(16,2)) * case when l_orderkey % 251 = 11 then -1 else 1 end "
     "as decimal(16,2))"),
    ("tip_mov", _choice("(l_orderkey + l_linenumber) % 7", "PAGO_PSE", "TRANSFERENCIA_ACH", "RECARGA",
                        "AVANCE_EFECTIVO", "COMPRA_TARJETA", "RETIRO_CORRESPONSAL", "ABONO_CUENTA")),
    ("cod_canal", "case l_returnflag when 'A' then 'APP' when 'N' then 'WEB' else 'CORRESPONSAL' end"),
    ("cod_ciudad",
     "case when l_partkey % 20 <> 6 then " + _choice("l_suppkey % 5", "BOG", "MED", "CDMX", "LIM", "SCL") + " end"),
    ("cod_estado_mov",
     "case when l_orderkey % 25 = 0 then 'FALLIDA' when l_orderkey % 50 = 1 then 'PENDIENTE' else 'EXITOSA' end"),
    ("id_dispositivo",
     f"case when l_returnflag <> 'R' then {_padded('dev', '(l_partkey * 7919) % 100000', 13)} end"),
]

LOAN_EXPRESSIONS = [
    ("id_oblig", _padded("OBL", "o_orderkey", 8)),
    ("id_cli", f"case when o_orderkey % 167 <> 5 then {_padded('CLI', 'o_custkey', 6)} end"),
    ("cod_prod", _padded("PRD", "((o_orderkey * 11) % 20) * 8 + o_orderkey % 3", 6)),
    ("vr_aprobado", "cast(o_totalprice as decimal(16,2))"),
    ("vr_desembolsado", "cast(floor(o_totalprice * (85 + o_orderkey % 16) / 100) as decimal(16,2))"),
    ("sdo_capital",
     "cast(floor(o_totalprice * (case when o_orderkey % 251 = 13 then 150 else 5 + o_orderkey % 85 end) / 100) "
     "as decimal(16,2))"),
    ("vr_cuota", "cast(floor(o_totalprice / 24) as decimal(14,2))"),
    ("fec_desembolso",
     "case when o_orderkey % 251 = 7 then date '2031-01-01' when o_orderkey % 251 = 8 then date '2008-01-01' "
     f"else {_day('2016-01-01', '(o_orderkey * 19) % 3000')} end"),
    ("fec_venc", _day("2016-01-01", "(o_orderkey * 19) % 3000 + 720")),
    ("dias_mora_act",
     "cast(case when o_orderkey % 4 = 0 then (o_orderkey * 17) % 200 + 1 else 0 end as int)"),
    ("num_cuotas_pend", "case when o_orderkey % 20 <> 7 then cast(o_orderkey % 24 as int) end"),
    ("calif_riesgo", _choice("o_orderkey % 3", "NORMAL", "VIGILANCIA", "INCUMPLIMIENTO")),
]

FEE_EXPRESSIONS = [
    ("id_comision", _padded("COM", "o_orderkey", 8)),
    ("id_cli",
     f"case when o_orderkey % 167 = 9 then {_padded('CLIX', 'o_orderkey', 5)} "
     f"else {_padded('CLI', 'o_custkey', 6)} end"),
    ("cod_prod", _padded("PRD", "(o_orderkey * 11) % 200", 6)),
    ("fec_cobro", _day("2024-01-01", "(o_orderkey * 11) % 540")),
    ("vr_comision", "cast(floor(o_totalprice / 100) as decimal(14,2))"),
    ("tip_comision",
     "case when o_orderkey % 20 <> 6 then case substr(o_orderpriority, 1, 1) when '1' then 'MANEJO' "
     "when '2' then 'RETIRO' when '3' then 'TRANSFERENCIA' when '4' then 'SEGURO_VOLUNTARIO' "
     "else 'SMS_ALERTA' end end"),
    ("estado_cobro", "case when o_orderkey % 20 = 0 then 'REVERSADO' else 'EXITOSO' end"),
]

EXPRESSIONS = {
    CLIENTES: CLIENT_EXPRESSIONS, PRODUCTOS: PRODUCT_EXPRESSIONS, SUCURSALES: BRANCH_EXPRESSIONS,
    MOVIMIENTOS: MOVEMENT_EXPRESSIONS, OBLIGACIONES: LOAN_EXPRESSIONS, COMISIONES: FEE_EXPRESSIONS,
}

LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


def audit_expressions(watermark: str | None) -> list[tuple[str, str]]:
    """Audit columns of a row: those of its run, found by date for the incremental tables."""

    def by_run(position: int) -> str:
        if not watermark:
            return f"'{BATCHES[-1][position]}'"
        arms = " ".join(f"when {watermark} < date '{b[2]}' then '{b[position]}'" for b in BATCHES[:-1])
        return f"case {arms} else '{BATCHES[-1][position]}' end"

    return [("ingestion_ts", by_run(1)), ("source_system", f"'{SOURCE_SYSTEM}'"), ("batch_id", by_run(0))]


def _geography(read: Callable[[str], DataFrame]) -> DataFrame:
    return read("nation").join(read("region"), F.expr("n_regionkey = r_regionkey"))


def _repeated_lines(lines: DataFrame) -> DataFrame:
    """Every line once, and the lines of each 333rd order a second time."""
    copies = F.when(F.expr("l_orderkey % 333 = 0"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.withColumn("copy", F.explode(copies)).drop("copy")


def source_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the six source tables (without audit columns)."""

    def read(table: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{table}.parquet")

    if name == CLIENTES:
        base = read("customer").join(_geography(read), F.expr("c_nationkey = n_nationkey"))
    elif name == PRODUCTOS:
        base = read("part")
    elif name == SUCURSALES:
        base = read("supplier").join(_geography(read), F.expr("s_nationkey = n_nationkey"))
    elif name == MOVIMIENTOS:
        lines = read("lineitem").select(*LINE_COLUMNS)
        # both sides are large: shuffled by order at every size, which also deals the rows of a small file out to all cores;
        # orders are two numbers each, so a hash table of a part of them is small, and the lines need no sort
        orders = read("orders").select("o_orderkey", "o_custkey").hint("shuffle_hash")
        base = _repeated_lines(lines.join(orders, F.expr("l_orderkey = o_orderkey")))
    else:
        base = read("orders").select(*ORDER_COLUMNS).repartition("o_orderkey")
    return base.selectExpr(*(f"{e} as {c}" for c, e in EXPRESSIONS[name]))


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as it stands after ingestion, with its audit columns."""
    from cauce.schemas import SOURCES

    audit = [f"{e} as {c}" for c, e in audit_expressions(SOURCES[name].watermark)]
    return source_table(spark, folder, name).selectExpr("*", *audit)
