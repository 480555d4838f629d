"""DuckDB twins of the registered queries, assembled from named common table expressions.

Written from the semantics, not from the Spark plans: window frames over the rows themselves instead
of day totals, FULL JOIN instead of stacking, EXISTS instead of marker joins, whole numbers instead of
decimals wherever a tie could round either way.
"""

from __future__ import annotations

import re

from cauce.functions import rules
from cauce.schemas import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SOURCES, SUCURSALES
from cauce.sources.driver_tables import AS_OF, EXPRESSIONS, audit_expressions

GEO = "JOIN nation ON {fk} = n_nationkey JOIN region ON n_regionkey = r_regionkey"
ORIGINS = {
    CLIENTES: "customer " + GEO.format(fk="c_nationkey"),
    PRODUCTOS: "part",
    SUCURSALES: "supplier " + GEO.format(fk="s_nationkey"),
    MOVIMIENTOS: "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 333 = 0) "
                 "JOIN orders ON l_orderkey = o_orderkey",
    OBLIGACIONES: "orders",
    COMISIONES: "orders",
}
SHORT = {CLIENTES: "cli", PRODUCTOS: "prod", SUCURSALES: "suc", MOVIMIENTOS: "mov", OBLIGACIONES: "obl",
         COMISIONES: "com"}
TODAY = f"DATE '{AS_OF}'"
FLOOR = "DATE '2015-01-01'"
PERMILLE = [int(share * 1000) for *_, share in (*rules.ARREARS, rules.WORST_ARREARS)]


def half_up(numerator: str, denominator: str, digits: int = 2) -> str:
    """numerator / denominator of non-negative whole numbers, ties away from zero, as DOUBLE."""
    n, d, step = f"({numerator})::HUGEINT", f"({denominator})::HUGEINT", 10**digits
    return f"(CASE WHEN {d} <> 0 THEN ((2 * {step} * {n} + {d}) // (2 * {d}))::DOUBLE / {step} END)"


def half_up_pct(numerator: str, denominator: str) -> str:
    return half_up(f"100 * ({numerator})", denominator)


def cents(amount: str) -> str:
    return f"({amount} * 100)::HUGEINT"


def build_ctes(salt: str, run_ts: str) -> dict[str, str]:
    """Name -> body of every shared table expression."""
    ctes: dict[str, str] = {}
    for table, expressions in EXPRESSIONS.items():
        columns = ", ".join(f"{e} AS {c}" for c, e in expressions)
        audit = ", ".join(f"{e} AS {c}" for c, e in audit_expressions(SOURCES[table].watermark))
        ctes[f"src_{SHORT[table]}"] = f"SELECT {columns} FROM {ORIGINS[table]}"
        ctes[f"raw_{SHORT[table]}"] = f"SELECT *, {audit} FROM src_{SHORT[table]}"

    def digest(column: str) -> str:
        return f"sha256({column} || '{salt}')"

    ctes["t_cli"] = f"""
        SELECT DISTINCT id_cli, {digest('nomb_cli')} AS nomb_cli_hash, {digest('apell_cli')} AS apell_cli_hash,
               tip_doc, {digest('num_doc')} AS num_doc_hash, fec_nac, fec_alta, cod_segmento, score_buro,
               (score_buro IS NULL) AS score_buro_es_nulo, ifnull(ciudad_res, 'DESCONOCIDA') AS ciudad_res,
               (ciudad_res IS NULL) AS ciudad_res_imputada, depto_res, estado_cli,
               ifnull(canal_adquis, 'NO_REGISTRADO') AS canal_adquis, ingestion_ts, source_system, batch_id
        FROM raw_cli WHERE num_doc IS NOT NULL AND fec_nac IS NOT NULL"""
    ctes["t_prod"] = """
        SELECT DISTINCT * REPLACE (ifnull(comision_admin, 0) AS comision_admin),
               (plazo_max_meses IS NOT NULL) AS es_plazo_aplicable,
               (comision_admin IS NULL) AS comision_admin_imputada
        FROM raw_prod"""
    ctes["t_suc"] = """
        SELECT DISTINCT *, NOT (latitud IS NULL OR longitud IS NULL) AS tiene_geolocalizacion FROM raw_suc"""
    ctes["uniq_mov"] = """
        SELECT * FROM raw_mov
        QUALIFY row_number() OVER (
            PARTITION BY id_mov, id_cli, cod_prod, num_cuenta, fec_mov, hra_mov, tip_mov, cod_canal, cod_estado_mov
            ORDER BY ingestion_ts, vr_mov DESC NULLS LAST, cod_ciudad NULLS LAST, id_dispositivo NULLS LAST) = 1"""
    ctes["good_mov"] = f"""
        SELECT * FROM uniq_mov
        WHERE fec_mov >= {FLOOR} AND fec_mov <= {TODAY} AND vr_mov > 0
          AND id_cli IN (SELECT id_cli FROM t_cli) AND cod_prod IN (SELECT cod_prod FROM t_prod)"""
    ctes["mov_frames"] = f"""
        SELECT *, count(*) OVER prior AS n, sum({cents('vr_mov')}) OVER prior AS s,
               sum({cents('vr_mov')} * {cents('vr_mov')}) OVER prior AS q
        FROM good_mov
        WINDOW prior AS (PARTITION BY id_cli ORDER BY (fec_mov - DATE '1970-01-01')
                         RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)"""
    ctes["mov_stats"] = """
        SELECT * EXCLUDE (n, s, q), CASE WHEN n > 0 THEN s::DOUBLE / 100 / n END AS promedio_movil_30d,
               CASE WHEN n > 1 THEN sqrt((n * q - s * s)::DOUBLE / (n::DOUBLE * (n - 1)::DOUBLE)) / 100 END
                   AS stddev_movil_30d
        FROM mov_frames"""
    ctes["t_mov"] = """
        SELECT * REPLACE (ifnull(cod_ciudad, 'DESCONOCIDA') AS cod_ciudad),
               (cod_ciudad IS NULL) AS cod_ciudad_imputada,
               (id_dispositivo IS NULL) AS sin_dispositivo_registrado,
               ifnull(stddev_movil_30d > 0 AND vr_mov::DOUBLE > promedio_movil_30d + 3 * stddev_movil_30d, FALSE)
                   AS ind_sospechoso
        FROM mov_stats"""
    ctes["t_obl"] = f"""
        SELECT DISTINCT *, (num_cuotas_pend IS NULL) AS num_cuotas_pend_es_nulo FROM raw_obl
        WHERE fec_desembolso >= {FLOOR} AND fec_desembolso <= {TODAY}
          AND {cents('sdo_capital')} * 100 <= {cents('vr_aprobado')} * 105
          AND id_cli IN (SELECT id_cli FROM t_cli) AND cod_prod IN (SELECT cod_prod FROM t_prod)"""
    ctes["t_com"] = """
        SELECT DISTINCT * REPLACE (ifnull(tip_comision, 'SIN_CLASIFICAR') AS tip_comision),
               (tip_comision IS NULL) AS tip_comision_imputado
        FROM raw_com
        WHERE id_cli IN (SELECT id_cli FROM t_cli) AND cod_prod IN (SELECT cod_prod FROM t_prod)"""

    def orphans(short: str, key: str, table: str) -> str:
        return f"""
        SELECT '{table}' AS tabla, {key} AS id_registro, 'FK_HUERFANA' AS tipo_error,
               'id_cli=' || id_cli || ' o cod_prod=' || cod_prod || ' no existen en las dimensiones' AS motivo
        FROM raw_{short} r
        WHERE NOT (EXISTS (FROM t_cli c WHERE c.id_cli = r.id_cli)
                   AND EXISTS (FROM t_prod p WHERE p.cod_prod = r.cod_prod))"""

    def bad_dates(short: str, key: str, table: str, day: str) -> str:
        return f"""
        SELECT '{table}', {key}, 'FECHA_FUERA_DE_RANGO', '{day}=' || {day}::VARCHAR || ' fuera del rango válido'
        FROM raw_{short} WHERE {day} < {FLOOR} OR {day} > {TODAY}"""

    ctes["orphan_rows"] = " UNION ALL ".join(
        [orphans("mov", "id_mov", MOVIMIENTOS), orphans("obl", "id_oblig", OBLIGACIONES),
         orphans("com", "id_comision", COMISIONES)])
    ctes["rejects"] = f"""
        FROM orphan_rows
        UNION ALL {bad_dates('mov', 'id_mov', MOVIMIENTOS, 'fec_mov')}
        UNION ALL {bad_dates('obl', 'id_oblig', OBLIGACIONES, 'fec_desembolso')}
        UNION ALL SELECT '{MOVIMIENTOS}', id_mov, 'CAMPO_INCONSISTENTE',
                         'vr_mov=' || vr_mov::VARCHAR || ' (monto inválido)' FROM raw_mov WHERE NOT vr_mov > 0
        UNION ALL SELECT '{OBLIGACIONES}', id_oblig, 'CAMPO_INCONSISTENTE',
                         'sdo_capital=' || sdo_capital::VARCHAR || ' > vr_aprobado=' || vr_aprobado::VARCHAR
                  FROM raw_obl WHERE {cents('sdo_capital')} * 100 > {cents('vr_aprobado')} * 105"""
    ctes["errors"] = f"SELECT *, TIMESTAMP '{run_ts}' AS fecha_deteccion FROM rejects"
    ctes["rejected"] = "SELECT tabla, count(DISTINCT id_registro) AS filas_rechazadas FROM rejects GROUP BY ALL"
    ctes["totals"] = " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, count(*) AS filas_totales FROM raw_{s}" for t, s in SHORT.items())
    ctes["summary"] = f"""
        SELECT tabla, filas_totales, ifnull(filas_rechazadas, 0) AS filas_rechazadas,
               {half_up_pct('filas_totales - ifnull(filas_rechazadas, 0)', 'filas_totales')} AS pct_conformes
        FROM totals LEFT JOIN rejected USING (tabla)"""
    watched = {CLIENTES: ["score_buro", "ciudad_res", "canal_adquis"], PRODUCTOS: ["comision_admin"],
               SUCURSALES: ["latitud"], MOVIMIENTOS: ["id_dispositivo", "cod_ciudad"],
               OBLIGACIONES: ["num_cuotas_pend"], COMISIONES: ["tip_comision"]}
    ctes["null_pct"] = " UNION ALL ".join(
        f"SELECT '{t}.{c}' AS columna, {half_up_pct(f'count(*) - count({c})', 'count(*)')} AS pct_nulos "
        f"FROM raw_{SHORT[t]}" for t, columns in watched.items() for c in columns)
    ctes["dq_report"] = f"""
        SELECT *, TIMESTAMP '{run_ts}' AS corrida_ts FROM (
            SELECT tabla, metrica, valor FROM (
                SELECT tabla, filas_totales::DOUBLE AS filas_totales, filas_rechazadas::DOUBLE AS filas_rechazadas,
                       pct_conformes FROM summary)
            UNPIVOT (valor FOR metrica IN (filas_totales, filas_rechazadas, pct_conformes))
            UNION ALL SELECT columna, 'pct_nulos', pct_nulos FROM null_pct)"""

    ctes["d_cli"] = f"""
        SELECT * EXCLUDE (nomb_cli_hash, apell_cli_hash, ciudad_res_imputada),
               nomb_cli_hash || '|' || apell_cli_hash AS nombre_completo_hash,
               date_part('year', {TODAY}) - date_part('year', fec_nac) AS edad,
               ifnull(MAP {{'BAS': 'Básico', 'STD': 'Estándar', 'PRM': 'Premium', 'ELT': 'Elite'}}[cod_segmento],
                      'Sin clasificar') AS segmento_desc
        FROM t_cli"""
    ctes["d_prod"] = f"""
        SELECT cod_prod, desc_prod AS nombre_producto, tip_prod AS tipo_producto,
               CASE WHEN tip_prod IN {rules.CREDIT_TYPES} THEN 'CREDITO'
                    ELSE if(tip_prod = 'CUENTA_AHORRO_DIGITAL', 'AHORRO', 'TRANSACCIONAL') END AS familia_producto,
               tasa_ea AS tasa_efectiva_anual,
               round((pow(1 + tasa_ea::DOUBLE / 100, 1.0::DOUBLE / 12) - 1) * 100, 4)::DECIMAL(10,4)
                   AS tasa_mensual_equivalente,
               plazo_max_meses AS plazo_maximo_meses, es_plazo_aplicable, cuota_min AS cuota_minima,
               comision_admin AS comision_administracion, estado_prod AS estado_producto,
               ingestion_ts, source_system, batch_id
        FROM t_prod"""
    ctes["f_mov"] = f"""
        SELECT m.* EXCLUDE (cod_ciudad_imputada, id_dispositivo, sin_dispositivo_registrado), familia_producto,
               {half_up(cents('vr_mov'), '405000')} AS vr_mov_usd,
               (isodow(fec_mov) <= 5 AND hra_mov >= '07:00:00' AND hra_mov < '21:00:00') AS horario_habil
        FROM t_mov m JOIN d_prod USING (cod_prod)"""
    ctes["f_obl"] = f"""
        SELECT o.* EXCLUDE (calif_riesgo), calif_riesgo AS calif_riesgo_fuente,
               ['Al día', 'Rango 1', 'Rango 2', 'Rango 3', 'Deteriorado'][grade] AS bucket_mora,
               substr('ABCDE', grade, 1) AS calif_regulatoria, permille::DOUBLE / 1000 AS provision_pct,
               {half_up(cents('sdo_capital') + ' * permille', '100000')} AS provision_estimada
        FROM (SELECT *, {PERMILLE}[grade] AS permille
              FROM (SELECT *, CASE WHEN dias_mora_act BETWEEN 0 AND 90
                                   THEN 1 + (dias_mora_act + 29) // 30 ELSE 5 END AS grade FROM t_obl)) o"""
    ctes["interest"] = f"""
        SELECT id_cli, strftime(fec_mov, '%Y-%m') AS periodo,
               sum(vr_mov * (tasa_mensual_equivalente / 100)::DECIMAL(9,6)) AS ingreso_intereses
        FROM good_mov JOIN d_prod USING (cod_prod)
        WHERE familia_producto = 'CREDITO' AND tip_mov IN {rules.INTEREST_MOVEMENTS} GROUP BY ALL"""
    ctes["fees"] = """
        SELECT id_cli, strftime(fec_cobro, '%Y-%m') AS periodo, sum(vr_comision) AS ingreso_comisiones
        FROM t_com WHERE estado_cobro = 'EXITOSO' GROUP BY ALL"""
    ctes["income"] = """
        SELECT id_cli, periodo, ifnull(ingreso_intereses, 0) AS ingreso_intereses,
               ifnull(ingreso_comisiones, 0) AS ingreso_comisiones
        FROM interest FULL JOIN fees USING (id_cli, periodo)"""
    ctes["f_rent"] = """
        SELECT id_cli, periodo, round(ingreso_intereses, 2) AS ingreso_intereses,
               round(ingreso_comisiones, 2) AS ingreso_comisiones,
               round(ingreso_intereses + ingreso_comisiones, 2) AS ingreso_total,
               round(sum(ingreso_intereses + ingreso_comisiones) OVER (
                   PARTITION BY id_cli ORDER BY periodo ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 2) AS cltv_12m
        FROM income"""
    ctes["kpi"] = f"""
        SELECT {TODAY} AS fecha_corte, cod_prod, cod_segmento, ciudad_res AS ciudad,
               count(DISTINCT id_oblig) AS total_obligaciones_activas, sum(sdo_capital) AS monto_total_cartera,
               ifnull(sum(sdo_capital) FILTER (dias_mora_act > 0), 0) AS monto_en_mora,
               {half_up_pct(f"ifnull(sum({cents('sdo_capital')}) FILTER (dias_mora_act > 0), 0)",
                            f"sum({cents('sdo_capital')})")} AS tasa_mora_pct,
               count(DISTINCT id_cli) FILTER (dias_mora_act > 0) AS clientes_con_mora
        FROM t_obl JOIN d_cli USING (id_cli) GROUP BY ALL"""
    return ctes


def assemble(select: str, ctes: dict[str, str]) -> str:
    """``select`` preceded by the table expressions it needs, in order of dependency."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(ctes[name])
                needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in needed) + "\n" + select


def as_doubles(sql: str, columns: str) -> str:
    """``sql`` with the named (decimal) columns as DOUBLE, the way the Spark side presents them."""
    replaced = ", ".join(f"{c}::DOUBLE AS {c}" for c in columns.split())
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})" if replaced else sql
