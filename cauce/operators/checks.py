"""Declarative table tests: each yields its name and the number of failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.numbers import count_where


@dataclass(frozen=True)
class NotNull:
    """No row lacks the column. Failures are rows."""

    table: str
    column: str

    @property
    def name(self) -> str:
        return f"not_null.{self.table}.{self.column}"

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Accepted:
    """Every present value is in the list. Failures are rows."""

    table: str
    column: str
    values: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"accepted_values.{self.table}.{self.column}"

    def failing(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class NoRows:
    """No row satisfies the condition. Failures are rows."""

    label: str
    table: str
    condition: str

    @property
    def name(self) -> str:
        return f"{self.label}.{self.table}"

    def failing(self) -> Column:
        return F.expr(self.condition)


@dataclass(frozen=True)
class Unique:
    """No value occurs twice; missing values do not count. Failures are values."""

    table: str
    column: str

    @property
    def name(self) -> str:
        return f"unique.{self.table}.{self.column}"


@dataclass(frozen=True)
class Related:
    """Every present value exists in the parent. Failures are rows."""

    table: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"relationships.{self.table}.{self.column}.{self.parent}"


RowTest = NotNull | Accepted | NoRows
Test = RowTest | Unique | Related


def _line(test: Test, failures: Column) -> Column:
    return F.struct(F.lit(test.name).alias("prueba"), failures.alias("fallas"))


def _row_tests(df: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    """All row tests of a table in one pass over it."""
    lines = F.array(*[_line(t, count_where(t.failing())) for t in tests])
    return df.agg(lines.alias("_lines")).select(F.inline("_lines"))


def _unique(df: DataFrame, test: Unique) -> DataFrame:
    repeated = df.where(F.col(test.column).isNotNull()).groupBy(test.column).agg(F.count(F.lit(1)).alias("_n"))
    return repeated.where("_n > 1").agg(F.lit(test.name).alias("prueba"), F.count(F.lit(1)).alias("fallas"))


def _related(child: DataFrame, parents: Mapping[str, DataFrame], tests: Sequence[Related]) -> DataFrame:
    """Rows without a parent, for all relationships of a table in one pass over it and one join.

    The keys of all tests are stacked and counted first: one row per test and key is shuffled and looked up, whatever it
    stands for. A test goes along as its number, and as its name at the end only.
    """
    stacked = child.select(F.explode(F.array(*(
        F.struct(F.lit(k).alias("_test"), F.col(t.column).cast("string").alias("_key")) for k, t in enumerate(tests)))).alias("_k")).select("_k.*")
    keys = stacked.where(F.col("_key").isNotNull()).groupBy("_test", "_key").agg(F.count(F.lit(1)).alias("_rows"))
    known = reduce(DataFrame.unionByName, (
        parents[t.parent].select(F.lit(k).alias("_test"), F.col(t.parent_column).cast("string").alias("_key")) for k, t in enumerate(tests)))
    lost = keys.join(known, ["_test", "_key"], "left_anti").groupBy("_test").agg(F.sum("_rows").alias("_lost"))
    names = child.sparkSession.createDataFrame([(k, t.name) for k, t in enumerate(tests)], "_test int, prueba string")
    return names.join(lost, "_test", "left").select("prueba", F.coalesce("_lost", F.lit(0)).cast("bigint").alias("fallas"))


def run_tests(tables: Mapping[str, DataFrame], tests: Sequence[Test]) -> DataFrame:
    """One line per test: (prueba, fallas)."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[RowTest]] = {}
    by_child: dict[str, list[Related]] = {}
    for test in tests:
        if isinstance(test, Unique):
            parts.append(_unique(tables[test.table], test))
        elif isinstance(test, Related):
            by_child.setdefault(test.table, []).append(test)
        else:
            by_table.setdefault(test.table, []).append(test)
    parts += [_row_tests(tables[t], group) for t, group in by_table.items()]
    parts += [_related(tables[t], tables, group) for t, group in by_child.items()]
    return reduce(DataFrame.unionByName, parts)
