"""Steps that must not grow faster than their input: what a task reads, holds and computes."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from types import SimpleNamespace

from pyspark.sql import functions as F

from cauce import queries
from cauce.operators import checks
from cauce.operators.checks import Related
from cauce.operators.distinct_counts import DistinctCounts
from cauce.operators.rolling import trailing_deviation
from cauce.operators.sampling import ranked_samples, row_digest
from cauce.plans import silver
from cauce.plans.incremental import IncrementalMovements
from cauce.schemas import CLIENTES, MOVIMIENTOS, PRODUCTOS, SOURCES
from cauce.sources.lake import Lake
from tests.frames import raw
from tests.test_skew import final_plan, no_broadcast


def test_parts_of_an_extract_are_not_gathered(spark):
    """The size of a part goes to its rows; dealt out by part, the rows of each would lie in one task."""
    table = SOURCES[MOVIMIENTOS]
    rows = table.project(raw(spark, MOVIMIENTOS, *({"id_mov": f"M{i}"} for i in range(400))))
    with no_broadcast(spark):
        found = queries.ranged_extract(SimpleNamespace(spark=spark, source=lambda _name: rows))
        plan = final_plan(found)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert found.count() == 400 and found.where("parte_acotada").count() == 400


def test_bitmaps_of_many_groups_stay_as_small_as_their_ids(spark, tmp_path):
    state = DistinctCounts(Lake(spark, str(tmp_path)), "x", ("g",), {"ids": ("id", "TRUE")})
    rows = spark.range(6000).selectExpr("cast(id % 1500 as string) AS g", "concat('id', id) AS id")
    state.apply(rows, "b0")
    maps = spark.read.parquet(state._path("mapas"))
    assert maps.schema["_bits"].dataType.simpleString() == "bigint"  # a word of 64 bits
    assert maps.count() <= 6000 + 1500
    state.apply(rows.where("id < 'id3'"), "b1")
    assert {r.ids for r in state.counts().collect()} == {4}


def test_sampling_makes_a_rows_text_once_for_all_digests(spark, tmp_path):
    df = spark.range(5000).selectExpr("cast(id % 4000 as int) AS a", "if(id % 9 = 0, null, cast(id % 4000 as string)) AS b")
    shares = {"p": 0.01, "q": 0.02, "r": 1.0}
    found = ranked_samples(df, {k: v for k, v in shares.items() if k != "r"}, {"p": "s1", "q": "s2"},
                           lambda n: {"p": int(n * 0.01), "q": int(n * 0.02)}, str(tmp_path / "near"))
    plan = found.far._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws") == 1 and "conv(" not in plan
    order = lambda seed: [F.md5(F.concat_ws("|", F.coalesce(F.col("a").cast("string"), F.lit("")), F.coalesce("b", F.lit("")), F.lit(seed))), "a"]
    for name, seed, size in (("p", "s1", 50), ("q", "s2", 100)):
        want = [r.a for r in df.orderBy(*order(seed)).limit(size).collect()]
        assert [r.a for r in found.picked(name).orderBy("_rank").collect()] == want
    assert found.far.unionByName(found.near.select("a", "b")).groupBy("a", "b").count().exceptAll(df.groupBy("a", "b").count()).isEmpty()
    assert df.select(row_digest(["a", "b"], "s1")).exceptAll(df.select(order("s1")[0])).isEmpty()
    whole = ranked_samples(df, {"r": 1.0}, {"r": "s"}, lambda n: {"r": n}, str(tmp_path / "all"))
    assert whole.far.isEmpty() and whole.picked("r").count() == 5000


def test_two_numbers_go_to_the_join_of_the_statistics(spark, ctx):
    parents = silver.stg_clientes(raw(spark, CLIENTES, {}), ctx), silver.stg_productos(raw(spark, PRODUCTOS, {}))
    rows = raw(spark, MOVIMIENTOS, *({"id_mov": f"M{i}", "fec_mov": date(2025, 3, 1 + i), "vr_mov": Decimal(i + 1)} for i in range(4)))
    found = silver.stg_movimientos(rows, *parents, ctx)
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]
    assert "stddev_movil_30d" in above and "trailing_" not in above
    got = {r.id_mov: (r.promedio_movil_30d, r.stddev_movil_30d) for r in found.collect()}
    assert got == {"M0": (None, None), "M1": (1.0, None), "M2": (1.5, 0.5**0.5), "M3": (2.0, 1.0)}


def test_wide_rows_are_not_sorted_for_their_statistics(spark, ctx):
    parents = silver.stg_clientes(raw(spark, CLIENTES, {}), ctx), silver.stg_productos(raw(spark, PRODUCTOS, {}))
    rows = raw(spark, MOVIMIENTOS, *({"id_mov": f"M{i}", "fec_mov": date(2025, 3, 1 + i)} for i in range(4)))
    with no_broadcast(spark):
        plan = final_plan(silver.stg_movimientos(rows, *parents, ctx))
    assert "ShuffledHashJoin" in plan and not any("SortMergeJoin" in line and "Inner" in line for line in plan.splitlines())


def test_spreads_of_longs_and_of_decimals_are_the_same(spark):
    """Frames below and above the limit of longs, and close to it: the exact deviation, rounded once."""
    frames = [[7], [3, 3], [1, 2, 4], [-5, 0, 12], [10**9] * 2 + [10**9 + 1], [15 * 10**8, 15 * 10**8 - 1], [22 * 10**8, 0, 1], [10**15, 10**15 - 3],
              [0, 0], [2 * 10**9, 2 * 10**9 + 1], [10**16 - 1, 1]]
    rows = [(i, len(f), Decimal(sum(f)), Decimal(sum(x * x for x in f))) for i, f in enumerate(frames)]
    df = spark.createDataFrame(rows, "i int, trailing_n bigint, trailing_sum decimal(36,0), trailing_squares decimal(38,0)")
    found = df.select("i", trailing_deviation().alias("d"))
    assert found._jdf.queryExecution().analyzed().toString().count("CASE WHEN") == 2  # enough rows, and short enough for longs
    for r in found.collect():
        f = frames[r.i]
        n, spread = len(f), len(f) * sum(x * x for x in f) - sum(f) ** 2
        assert r.d == (None if n < 2 else (float(spread) / (n * (n - 1.0))) ** 0.5 / 100), f


def test_names_of_relationships_do_not_travel_with_the_rows(spark):
    child = spark.createDataFrame([("a", "x"), ("b", None)], "k string, l string")
    parent = spark.createDataFrame([("a",)], "pk string")
    found = checks.run_tests({"child": child, "p": parent}, [Related("child", "k", "p", "pk"), Related("child", "l", "p", "pk")])
    assert "relationships." not in found._jdf.queryExecution().analyzed().toString()
    assert {r.prueba: r.fallas for r in found.collect()} == {"relationships.child.k.p": 1, "relationships.child.l.p": 1}


def test_settled_rows_of_a_batch_are_not_staged_again(spark, ctx, tmp_path):
    """A batch's winners lie with its changes already; a row that takes another's place is still taken in, and taken off."""
    clients, products = silver.stg_clientes(raw(spark, CLIENTES, {}), ctx), silver.stg_productos(raw(spark, PRODUCTOS, {}))
    state = IncrementalMovements(Lake(spark, str(tmp_path)), ctx)
    late = raw(spark, MOVIMIENTOS, {"vr_mov": Decimal(9)}, {"id_mov": "M2", "fec_mov": date(2025, 3, 9)}, {"id_mov": "M3", "fec_mov": date(2025, 3, 20)})
    early = raw(spark, MOVIMIENTOS, {"vr_mov": Decimal(7), "ingestion_ts": "2025-11-01T00:00:00+00:00"})
    state.apply(late, "b1", products)
    state.apply(early, "b0", products)
    assert not any("unicos" in name and "kept" not in name for name in state.lake.names(state._path("_preparado")))
    assert {(r.fec_mov, r._n, r._s) for r in state.totals().collect()} == {
        (date(2025, 3, 1), 1, 700), (date(2025, 3, 9), 1, 10_000), (date(2025, 3, 20), 1, 10_000)}
    want = silver.stg_movimientos(late.unionByName(early), clients, products, ctx)
    assert state.stg_movimientos(clients, products).exceptAll(want).isEmpty() and want.count() == 3
