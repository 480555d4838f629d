"""Movements are joined to their orders without a sort, and keep every row."""

from __future__ import annotations

from cauce.schemas import MOVIMIENTOS
from cauce.sources.driver_tables import source_table


def _stored(spark, folder):
    lines = [(k, n, 5, 6, 10.0, "A") for k in (1, 2, 333) for n in (1, 2)] + [(9, 1, 5, 6, 1.0, "N"), (None, 1, 5, 6, 1.0, "N")]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, "
                          "l_extendedprice double, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    orders = [(1, 7), (2, 7), (2, 8), (333, None), (None, 3)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{folder}/orders.parquet")


def test_lines_meet_their_orders_without_a_sort(spark, tmp_path):
    _stored(spark, tmp_path)
    movements = source_table(spark, str(tmp_path), MOVIMIENTOS)
    plan = movements._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan.replace("SortMerge", "Sort")
    # two lines each of order 1, of both rows of order 2, and twice of order 333; order 9 and missing keys have no partner
    assert sorted((r["id_mov"], r["n"]) for r in movements.groupBy("id_mov").agg({"*": "count"}).toDF("id_mov", "n").collect()) == [
        ("MOV000000011", 1), ("MOV000000012", 1), ("MOV000000021", 2), ("MOV000000022", 2), ("MOV000003331", 2), ("MOV000003332", 2)]
