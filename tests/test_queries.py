"""Every registered query against its twin, value by value, on the smallest driver tables."""

from __future__ import annotations

import compare
import pytest

from cauce.queries import QUERIES, TWINS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_twin(spark, duck, name):
    assert compare.differences(spark, duck, FOLDER, name) == ""


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1373
    # the training-data queries are registered too, and some of them have no SQL
    assert QUERIES.keys() <= __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
