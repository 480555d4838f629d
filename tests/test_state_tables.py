"""Mergeable distinct counts, counts from footers, clustered files, relationships in one pass, and the deduplicating feed."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cauce.operators import checks
from cauce.operators.checks import Related
from cauce.operators.clustering import clustered, interleaved, rank, rank_bounds
from cauce.operators.distinct_counts import DistinctCounts
from cauce.plans import ingest
from cauce.schemas import MOVIMIENTOS, SOURCES
from cauce.sources import footers
from cauce.sources.lake import Lake, Layout, merge_snapshot, read_model, write_model
from cauce.streaming.dedup_feed import feed_first_copies
from tests.frames import raw

AT = datetime(2025, 3, 1, 2, tzinfo=timezone.utc)


def test_distinct_counts_merge(spark, tmp_path):
    state = DistinctCounts(Lake(spark, str(tmp_path)), "x", ("g", "h"), {"ids": ("id", "TRUE"), "late": ("id", "n > 5"), "others": ("o", "n < 9")})
    rows = [(f"g{i % 3}" if i % 7 else None, i % 2, f"id{i * i % 211}" if i % 13 else None, i % 10, f"o{i % 5}") for i in range(2000)]
    batches = [rows[:700], rows[500:1500], rows[1400:], [("only", 1, None, 9, None)]]
    schema = "g string, h int, id string, n int, o string"
    for order in ([0, 1], [2, 1, 3, 0]):  # later, and again
        for k in order:
            state.apply(spark.createDataFrame(batches[k], schema), f"b{k}")
        seen = defaultdict(lambda: (set(), set(), set()))
        for g, h, i, n, o in [r for k in {0, 1, *order} for r in batches[k]]:
            ids, late, others = seen[g, h]
            ids |= {i} - {None}
            late |= {i} - {None} if n > 5 else set()
            others |= {o} - {None} if n < 9 else set()
        got = {(r.g, r.h): (r.ids, r.late, r.others) for r in state.counts().collect()}
        assert got == {k: tuple(map(len, v)) for k, v in seen.items()}
    some = {(r.g, r.h): r.ids for r in state.counts(["b0"]).collect()}
    assert sum(some.values()) < sum(v[0] for v in got.values()) and got["only", 1] == (0, 0, 0)
    numbers = state._numbers("id")
    assert numbers.count() == numbers.select("id").distinct().count() == numbers.select("number").distinct().count()


def test_counts_from_footers(spark, tmp_path):
    spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, cast(id as string)) AS t", "if(id < 100, null, date'2025-01-01') AS d",
                                 "cast(id as decimal(16,2)) AS a").repartition(5).write.parquet(str(tmp_path / "t"))
    schema = "id bigint, t string, d date, a decimal(16,2)"
    found = footers.counted(spark, [str(tmp_path / "t")], schema, ["t", "d"])
    assert tuple(found.first()) == (1000, 857, 900)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(t), COUNT(d)]" in plan.replace("`", "") and "ReadSchema: struct<count" in plan
    lines = footers.profiles(spark, {"x": ([str(tmp_path / "t")], schema), "none": ([], schema)}, {"x": ["t"], "none": ["d"]}).collect()
    assert {tuple(r) for r in lines} == {("x", None, 1000, None), ("x", "t", 1000, 143), ("none", None, 0, None), ("none", "d", 0, 0)}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_clustered_files_are_narrow_in_both_columns(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id", "concat('P', lpad(cast(id * 7919 % 500 as string), 4, '0')) AS p",
                                        "concat('C', cast(id * 31 % 5 as string)) AS c", "if(id % 9 = 0, null, cast(id % 400 as int)) AS n")
    df.write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    clustered(plain, ["p", "c", "n"], 64).write.parquet(str(tmp_path / "ordered"))
    ordered = spark.read.parquet(str(tmp_path / "ordered"))
    assert ordered.exceptAll(plain).isEmpty() and ordered.count() == 20_000
    spans = ordered.groupBy(F.input_file_name()).agg(*(f(c).alias(f"{f.__name__}_{c}") for c in "pcn" for f in (F.min, F.max))).collect()
    for column, value in (("p", "P0123"), ("c", "C3"), ("n", 77)):
        touched = [r for r in spans if r[f"min_{column}"] is not None and r[f"min_{column}"] <= value <= r[f"max_{column}"]]
        assert 0 < 2 * len(touched) <= len(spans)
    assert rank_bounds(plain.limit(0), "p") == []


def test_interleaved_bits(spark):
    df = spark.range(16).selectExpr("cast(id div 4 as int) AS a", "cast(id % 4 as int) AS b")
    got = {(r.a, r.b): r.k for r in df.select("a", "b", interleaved([F.col("a"), F.col("b")], 2).alias("k")).collect()}
    assert got == {(a, b): (a & 2) * 4 + (b & 2) * 2 + (a & 1) * 2 + (b & 1) for a, b in got}
    ranks = spark.createDataFrame([("a",), ("m",), ("z",), (None,)], "v string").select(rank("v", ["c", "m"], 4)).collect()
    assert [r[0] for r in ranks] == [0, 10, 10, 0]


def test_relationships_of_a_table_share_one_pass(spark):
    child = spark.createDataFrame([("a", "x", 1)] * 50 + [("b", None, 2), ("c", "y", 3), (None, "z", 4)], "k string, l string, n int")
    parents = {"p": spark.createDataFrame([("a",), ("b",), (None,)], "pk string"), "q": spark.createDataFrame([("x",)], "qk string")}
    tests = [Related("child", "k", "p", "pk"), Related("child", "l", "q", "qk"), Related("child", "k", "q", "qk")]
    found = checks.run_tests({"child": child, **parents}, tests)
    assert {r.prueba: r.fallas for r in found.collect()} == dict(zip([t.name for t in tests], [1, 2, 52]))
    empty = checks.run_tests({"child": child.limit(0), **parents}, tests)
    assert sorted(r.fallas for r in empty.collect()) == [0, 0, 0]


def test_one_scan_for_all_relationships(spark, tmp_path):
    for name, rows in (("child", [("a", "x")]), ("p", [("a", "x")])):
        spark.createDataFrame(rows, "k string, l string").write.parquet(str(tmp_path / name))
    tables = {n: spark.read.parquet(str(tmp_path / n)) for n in ("child", "p")}
    plan = checks.run_tests(tables, [Related("child", "k", "p", "k"), Related("child", "l", "p", "l")])._jdf.queryExecution().optimizedPlan().toString()
    assert sum("parquet" in line and "Relation" in line for line in plan.splitlines()) == 3  # the child once, the parent per relationship


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_feed_of_first_copies(spark, lake):
    """A batch sent again within the bound adds nothing, one row of it changed is new; beyond the bound copies are new rows."""
    table, target = SOURCES[MOVIMIENTOS], f"{lake.root}/feed"
    rows = table.project(raw(spark, MOVIMIENTOS, *({"id_mov": f"M{i}", "fec_mov": date(2025, 2, 1 + i), "cod_ciudad": None} for i in range(5))))

    def batch(df, name, at):
        ingest.write_batch(ingest.with_audit(df, name, "core", at), lake.bronze_path(table), at)
        feed_first_copies(lake, table, target, "7 days", 2)
        return spark.read.schema(table.bronze_schema).parquet(target)
    assert batch(rows.unionByName(rows.limit(2)), "b0", AT).count() == 5
    assert batch(rows, "b1", AT + timedelta(days=3)).count() == 5
    changed = rows.withColumn("cod_ciudad", F.when(F.col("id_mov") == "M3", "BOG"))
    assert batch(changed, "b2", AT + timedelta(days=4)).count() == 6
    got = batch(rows.withColumn("id_mov", F.concat(F.lit("N"), "id_mov")), "b3", AT + timedelta(days=20))
    assert got.count() == 11 and got.select(*table.columns).distinct().count() == 11
    got = batch(rows, "b4", AT + timedelta(days=21))  # state of b0 has gone
    assert got.count() == 16 and got.where("batch_id = 'b0'").count() == 5
    feed_first_copies(lake, table, target, "7 days")
    assert spark.read.parquet(target).count() == 16
    with pytest.raises(ValueError, match="full"):
        feed_first_copies(lake, SOURCES["TB_CLIENTES_CORE"], target)


def test_files_of_the_lake_are_compressed_with_zstd(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "date '2025-01-01' as day")
    write_model(rows, str(tmp_path / "model"))
    write_model(rows, str(tmp_path / "dated"), Layout("day", ("id",)))
    merge_snapshot(Lake(spark, str(tmp_path)), rows, str(tmp_path / "snapshot"), "day", ("id",), str(tmp_path / "staging"))
    files = [p.name for p in Path(tmp_path).rglob("part-*.parquet")]
    assert len({p.relative_to(tmp_path).parts[0] for p in Path(tmp_path).rglob("part-*.parquet")}) == 4
    assert all(name.endswith(".zstd.parquet") for name in files)
    assert read_model(spark, str(tmp_path / "dated")).count() == 100
