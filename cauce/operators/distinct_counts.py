"""Distinct counts that merge: exact bitmaps over dense numbers, one set of them per batch.

Every id gets a number once, when it first comes; a dictionary keeps them. Numbers run up in ``LANES`` lanes by a hash of the id, so
they are given out in parallel and stay dense. A batch leaves a word of 64 bits per group and 64 numbers, if any of them is there:
a group's bitmap takes as many rows as it has ids at most, however many groups share the numbers. The count over any
batches is the number of bits of their words put together; no row of a batch is read again, and an id that comes in several
batches counts once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.sources.lake import Lake

LANES = 64
WORD_BITS = 6  # of a number, within a word of 64


@dataclass(frozen=True)
class DistinctCounts:
    """Counts of different ids per group. ``measures``: name -> (column of the id, condition as SQL)."""

    lake: Lake
    name: str
    groups: tuple[str, ...]
    measures: Mapping[str, tuple[str, str]]

    def _path(self, part: str) -> str:
        return self.lake.path("conteos", f"{self.name}/{part}")

    def _numbers(self, column: str) -> DataFrame:
        spark, path = self.lake.spark, self._path(f"numeros_{column}")
        schema = "id string, number bigint, lote string"
        return spark.read.schema(schema).parquet(path) if self.lake.exists(path) else spark.createDataFrame([], schema)

    def _numbered(self, column: str, ids: DataFrame, batch_id: str) -> DataFrame:
        """(id, number) of all ids so far; new ones are added to the dictionary, so a repeated batch adds none."""
        known = self._numbers(column)
        lane = F.pmod(F.xxhash64("id"), F.lit(LANES))
        new = ids.join(known, "id", "left_anti").withColumn("_lane", lane)
        used = known.groupBy(F.pmod("number", F.lit(LANES)).alias("_lane")).agg((F.max("number") + LANES).alias("_first"))
        turn = F.row_number().over(Window.partitionBy("_lane").orderBy("id")) - 1
        numbers = new.withColumn("_turn", turn).join(used, "_lane", "left").select(
            "id", (F.coalesce("_first", "_lane") + F.col("_turn") * LANES).alias("number"), F.lit(batch_id).alias("lote"))
        numbers.write.mode("append").partitionBy("lote").parquet(self._path(f"numeros_{column}"))
        return self._numbers(column).select("id", "number")

    def apply(self, rows: DataFrame, batch_id: str) -> None:
        """Take in a batch; repeating one replaces its bitmaps."""
        parts = []
        for measure, (column, condition) in self.measures.items():
            ids = rows.where(condition).where(F.col(column).isNotNull()).select(*self.groups, F.col(column).alias("id")).distinct()
            numbered = ids.join(self._numbered(column, ids.select("id").distinct(), f"{batch_id}-{measure}"), "id")
            bit = F.expr(f"shiftleft(1L, cast(number & {(1 << WORD_BITS) - 1} as int))")
            parts.append(numbered.groupBy(*self.groups, F.shiftright("number", WORD_BITS).alias("_word")).agg(
                F.bit_or(bit).alias("_bits")).withColumn("_measure", F.lit(measure)))
        # groups without any id of a measure keep a row
        there = rows.select(*self.groups).distinct().withColumns(
            {"_word": F.lit(None).cast("bigint"), "_bits": F.lit(None).cast("bigint"), "_measure": F.lit(None).cast("string")})
        for part in parts:
            there = there.unionByName(part)
        (
            there.withColumn("lote", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("lote").parquet(self._path("mapas"))
        )

    def counts(self, batches: Sequence[str] | None = None) -> DataFrame:
        """The groups with a column per measure, over all batches or some of them."""
        maps = self.lake.spark.read.parquet(self._path("mapas"))
        if batches is not None:
            maps = maps.where(F.col("lote").isin(*batches))
        united = maps.groupBy(*self.groups, "_measure", "_word").agg(F.bit_or("_bits").alias("_bits"))

        def count(measure: str) -> Column:
            own = F.when(F.col("_measure") == measure, F.bit_count("_bits")).otherwise(0)
            return F.sum(own).cast("bigint").alias(measure)

        return united.groupBy(*self.groups).agg(*map(count, self.measures))
