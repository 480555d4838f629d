"""Keys derived from numbers keep all digits."""

from __future__ import annotations

import duckdb

from cauce.sources.driver_tables import _padded


def test_numbers_past_the_width(spark):
    numbers = [7, 9999, 10000, 10009, 100000, 123456789012]
    expected = ["S0007", "S9999", "S10000", "S10009", "S100000", "S123456789012"]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    assert [r[0] for r in df.selectExpr(_padded("S", "n", 4)).collect()] == expected
    for n, key in zip(numbers, expected):
        assert duckdb.sql(f"select {_padded('S', f'{n}::bigint', 4)}").fetchall() == [(key,)]
