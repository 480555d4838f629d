"""Key ranges: every row in one part, parts of similar sizes, whatever the keys are."""

from __future__ import annotations

from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.operators.ranges import _after, key_parts, numbered_parts, read_parts

DAY = date(2024, 1, 1)


def sizes(df, keys, parts, splittable=True):
    found = key_parts(df.select(*keys), keys, parts)
    rows = numbered_parts(df, found).groupBy("_id").agg(F.count("*").alias("n"), F.first("part").alias("part")).collect()
    assert len(rows) == df.count() and all(r.n == 1 for r in rows)  # each row in exactly one part
    counts = Counter(r.part for r in rows)
    if splittable:
        assert max(counts.values()) <= 2 * len(rows) / parts + 1
        assert len(found) <= 2 * parts + 2 * len(keys)
    return found, counts


def frame(spark, ids, days=None):
    days = days or [None] * len(ids)
    return spark.createDataFrame([(k, i, d) for k, (i, d) in enumerate(zip(ids, days))], "_id long, id string, dia date")


TEXTS = {
    "numbers": [f"MOV{i:09d}" for i in range(5000)],
    "growing": [f"CLI{i}" for i in range(1, 5000)],
    "skewed": [f"A{i % 3}" for i in range(10)] + [f"ZZZZZZZZ{i:05d}" for i in range(4000)],
    "nested": [("ab" * (i % 40)) + f"{i:04d}" for i in range(4000)],
    "odd": ["", "'", "\\", "a'b\\c", "\u00e9", "\u65e5\u672c", "\U0001f600", "\ud7ff", "\uffff"] * 3 + [chr(0x4E00 + i) * 2 for i in range(1500)],
    "null": [None] * 700 + [f"K{i:05d}" for i in range(1300)],
}


@pytest.mark.parametrize("name", TEXTS)
def test_text_ranges(spark, name):
    ids = TEXTS[name]
    splittable = name not in ("odd", "null")
    found, counts = sizes(frame(spark, ids), ["id"], 8, splittable)
    if name == "null":
        assert max(n for part, n in counts.items() if not found[part].bounds[0].missing) <= 2 * len(ids) / 8 + 1
    if name == "odd":
        assert max(counts.values()) <= 2 * len(ids) / 8 + 30


def test_hot_values_are_cut_by_the_next_key(spark):
    """A third of all rows on one day, a sixth without a day."""
    rng = np.random.default_rng(4)
    days = [DAY] * 2000 + [None] * 1000 + [DAY + timedelta(days=int(d)) for d in rng.integers(-400, 400, 3000)]
    found, _ = sizes(frame(spark, [f"ID{i:07d}" for i in rng.permutation(6000)], days), ["dia", "id"], 12)
    assert sum(len(p.bounds) == 2 for p in found) >= 5


def test_equal_rows_and_empty_tables(spark):
    sizes(frame(spark, ["same"] * 500), ["id"], 4, splittable=False)
    sizes(frame(spark, [None] * 50), ["id", "dia"], 4, splittable=False)
    found, _ = sizes(frame(spark, ["x"] * 600 + ["y"] * 10, [DAY + timedelta(days=i % 200) for i in range(610)]), ["id", "dia"], 6)
    assert key_parts(frame(spark, []), ["id", "dia"], 4)[0].spark_sql() == "id IS NULL"


def test_ranges_are_pushed_down(spark, tmp_path):
    df = frame(spark, [f"ID{i:07d}" for i in range(1000)], [DAY + timedelta(days=i) for i in range(1000)])
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = key_parts(stored, ["dia"], 4)
    read = read_parts(stored, found)
    assert read.count() == 1000 and read.distinct().count() == 1000
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(dia), GreaterThanOrEqual(dia") >= 3


def test_a_sample_decides_sizes_only(spark):
    ids = [f"ID{i:07d}" for i in range(4000)]
    df = frame(spark, ids)
    found = key_parts(df.where("_id % 10 = 3"), ["id"], 8)
    counts = numbered_parts(df, found).groupBy("part").count().collect()
    assert sum(r["count"] for r in counts) == 4000 and max(r["count"] for r in counts) <= 1000


def test_next_text():
    assert _after("ab") == "ac" and _after("a\U0010ffff") == "b" and _after("\U0010ffff") is None and _after("\ud7ff") == "\ue000"
