from __future__ import annotations

from cauce.catalog import LINEAGE, column_catalog, lineage
from cauce.plans.layers import MODELS
from cauce.queries import Tables
from cauce.session import shuffle_partitions


def test_catalog_covers_every_computed_column(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    models = {n: t.model(n) for n in MODELS if n not in ("err_calidad_datos", "dq_report_silver")}
    rows = {(r["tabla"], r["campo"]): r for r in column_catalog(spark, models).collect()}
    assert all((table, column) in rows for column, table, _, _ in LINEAGE) and lineage(spark).count() == 11
    assert rows["stg_clientes", "num_doc_hash"]["sensible"] == "sí (hash)"
    assert rows["stg_clientes", "num_doc_hash"]["origen"] == "TB_CLIENTES_CORE.num_doc"
    assert rows["fact_transacciones", "vr_mov"]["sensible"] == "sí"
    assert rows["fact_transacciones", "id_cli"]["origen"] == "TB_CLIENTES_CORE.id_cli"
    assert rows["fact_transacciones", "vr_mov_usd"]["origen"] == "TB_MOV_FINANCIEROS.vr_mov"
    assert not {"nomb_cli", "apell_cli", "num_doc"} & {c for _, c in rows}


def test_shuffle_partitions():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10 * 1024**4) == 81920
    assert shuffle_partitions(100 * 1024**4) == 819_200
