"""Full outer merge: missing measures and missing keys."""

from __future__ import annotations

from cauce.operators.merging import merge_measures


def test_missing_measures_and_keys(spark):
    left = spark.createDataFrame([("a", 1, 5), ("b", 1, None), (None, 1, 2)], "k string, p int, x int")
    right = spark.createDataFrame([("a", 1, None), ("c", 1, 7), (None, 1, 3)], "k string, p int, y int")
    got = sorted(map(tuple, merge_measures(left, right, ("k", "p")).collect()), key=str)
    assert got == sorted(
        [("a", 1, 5, 0), ("b", 1, 0, 0), ("c", 1, 0, 7), (None, 1, 2, 0), (None, 1, 0, 3)], key=str)
