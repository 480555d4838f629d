"""Movements and their trailing statistics, kept up to date batch by batch.

State, all of it below one folder and partitioned by month:

* ``unicos``: the row that wins of each movement key, as ``silver.unique_movements`` chooses it;
* ``cambios``: what a batch has changed, the winners that came and those that went;
* ``totales``: per client and day the count, sum and sum of squares of a batch's changes, those that went with a minus.
  They are mergeable: a day's totals are the sum over the batches;
* ``ventana``: per client and day of movements the totals of the days before, which the statistics are made of.

A batch reads the months of its own movements and of the days that its changes reach; nothing else is read or written. A
late row changes the days after it, within reach, and no others. Batches may come in any order, and the result is
that of a rebuild from all rows. A batch that failed is repeated under its id before any other: its changes are settled by the
first attempt that wrote them, and every later step replaces what an earlier attempt has left. ``hechos`` has a mark of each batch
that has gone through.

Products and clients are those at the time of the batch; when they change, rebuild.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.context import RunContext
from cauce.operators.rolling import daily_totals
from cauce.plans import silver
from cauce.schemas import MOVIMIENTOS, SOURCES
from cauce.sources.lake import Lake, merge_snapshot

KEY, DAY, AMOUNT = "id_cli", "fec_mov", "vr_mov"
MONTH = "mes"
NO_MONTH = 0
TOTALS = f"{KEY} string, {DAY} date, _n bigint, _s decimal(38,0), _q decimal(38,0), {MONTH} int, batch_id string"
WINDOW = f"{KEY} string, {DAY} date, trailing_n bigint, trailing_sum decimal(38,0), trailing_squares decimal(38,0), {MONTH} int"


def _month(day: Column | str) -> Column:
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(NO_MONTH))


def _reach(days: DataFrame, first: int, last: int) -> list[int]:
    """Months that lie between ``first`` and ``last`` days after any of the days."""
    around = F.explode(F.sequence(F.date_add(DAY, first), F.date_add(DAY, last))).alias("_day")
    reached = days.where(F.col(DAY).isNotNull()).select(DAY).distinct().select(around).select(_month("_day").alias("m"))
    return [r["m"] for r in reached.distinct().collect()]


@dataclass(frozen=True)
class IncrementalMovements:
    """The state below ``lake.root/incremental/name`` and the plans that change and read it."""

    lake: Lake
    ctx: RunContext
    name: str = "movimientos"

    def _path(self, part: str) -> str:
        return self.lake.path("incremental", f"{self.name}/{part}")

    def _read(self, part: str, schema: str, months: list[int] | None = None) -> DataFrame:
        spark, path = self.lake.spark, self._path(part)
        df = spark.read.schema(schema).parquet(path) if self.lake.exists(path) else spark.createDataFrame([], schema)
        return df if months is None else df.where(F.col(MONTH).isin(months))

    @property
    def _row_schema(self) -> str:
        fields = [f"{f.name} {f.dataType.simpleString()}" for f in SOURCES[MOVIMIENTOS].bronze_schema]
        return ", ".join([*fields, f"{MONTH} int"])

    def winners(self) -> DataFrame:
        """One row per movement, as of all batches so far."""
        return self._read("unicos", self._row_schema).drop(MONTH)

    def apply(self, batch: DataFrame, batch_id: str, productos: DataFrame) -> None:
        """Take in raw movements. Repeating a batch that has gone through changes nothing."""
        done = self.lake.names(self._path("hechos"))
        if batch_id in done:
            return
        begun = {n.removeprefix("lote=") for n in self.lake.names(self._path("cambios"))}
        if others := begun - done - {batch_id}:
            raise RuntimeError(f"repeat the unfinished batch first: {sorted(others)}")
        changes = self._settled_changes(batch, batch_id)
        if not changes.isEmpty():
            came = changes.where("_sign = 1").select(*SOURCES[MOVIMIENTOS].bronze_schema.names, MONTH)
            merge_snapshot(self.lake, came, self._path("unicos"), MONTH, (MONTH, *silver.MOVEMENT_KEY),
                           self._path(f"_preparado/{batch_id}-unicos"), stored=True)
            self._add_totals(changes, batch_id, productos)
            self._renew_window(changes, batch_id)
        self.lake.mark(self._path(f"hechos/{batch_id}"))

    def _settled_changes(self, batch: DataFrame, batch_id: str) -> DataFrame:
        """Winners that came (_sign 1) and went (-1), written once for the batch."""
        path = f"{self._path('cambios')}/lote={batch_id}"
        schema = f"{self._row_schema}, _sign int"
        if not self.lake.exists(f"{path}/_SUCCESS"):
            names = SOURCES[MOVIMIENTOS].bronze_schema.names
            fresh = batch.select(*names).withColumn(MONTH, _month(DAY))
            months = [r[0] for r in fresh.select(MONTH).distinct().collect()]
            same = [F.col(f"o.{c}").eqNullSafe(F.col(f"f.{c}")) for c in silver.MOVEMENT_KEY]
            old = self._read("unicos", self._row_schema, months).alias("o").join(fresh.alias("f"), same, "left_semi")
            both = old.withColumn("_old", F.lit(1)).unionByName(fresh.withColumn("_old", F.lit(0)))
            # an old winner goes before an equal row of the batch, so that equal rows change nothing
            now = silver.unique_movements(both, extra_order=[F.col("_old").desc()])
            came = now.where("_old = 0").drop("_old").withColumn("_sign", F.lit(1))
            beaten = [F.col(f"o.{c}").eqNullSafe(F.col(f"w.{c}")) for c in silver.MOVEMENT_KEY]
            went = old.join(came.alias("w"), beaten, "left_semi").withColumn("_sign", F.lit(-1))
            came.unionByName(went).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return self.lake.spark.read.schema(schema).parquet(path)

    def _add_totals(self, changes: DataFrame, batch_id: str, productos: DataFrame) -> None:
        good = silver.acceptable(changes, productos, self.ctx)
        totals = daily_totals(good, KEY, DAY, AMOUNT, F.col("_sign"))
        (
            totals.select(KEY, DAY, F.col("_n").cast("bigint").alias("_n"), *(F.col(c).cast("decimal(38,0)").alias(c) for c in ("_s", "_q")),
                          _month(DAY).alias(MONTH), F.lit(batch_id).alias("batch_id"))
            .hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH, "batch_id").parquet(self._path("totales"))
        )

    def totals(self, months: list[int] | None = None) -> DataFrame:
        """Count, sum and sum of squares per client and day over all batches; zeros where all rows have gone."""
        return self._read("totales", TOTALS, months).groupBy(KEY, DAY).agg(*(F.sum(c).alias(c) for c in ("_n", "_s", "_q")))

    def _renew_window(self, changes: DataFrame, batch_id: str) -> None:
        """The trailing totals of the days that the changes reach."""
        days = silver.TRAILING_DAYS
        changed = self._read("totales", TOTALS, _reach(changes, 0, 0)).where(F.col("batch_id") == batch_id).select(KEY, DAY)
        near = self.totals(_reach(changes, -days, days)).join(changed.select(KEY).distinct(), KEY, "left_semi")
        marked = near.join(changed.withColumn("_changed", F.lit(1)), [KEY, DAY], "left")
        of_client = Window.partitionBy(KEY).orderBy(F.unix_date(DAY))
        before, reach = of_client.rangeBetween(-days, -1), of_client.rangeBetween(-days, 0)
        sums = [F.sum(a).over(before).alias(b) for a, b in (("_n", "trailing_n"), ("_s", "trailing_sum"), ("_q", "trailing_squares"))]
        renewed = marked.select(KEY, DAY, *sums, F.max("_changed").over(reach).alias("_reached")).where("_reached = 1").select(
            KEY, DAY, "trailing_n", F.col("trailing_sum").cast("decimal(38,0)").alias("trailing_sum"),
            F.col("trailing_squares").cast("decimal(38,0)").alias("trailing_squares"), _month(DAY).alias(MONTH))
        merge_snapshot(self.lake, renewed, self._path("ventana"), MONTH, (MONTH, KEY, DAY), self._path(f"_preparado/{batch_id}-ventana"))

    def window(self) -> DataFrame:
        return self._read("ventana", WINDOW).drop(MONTH)

    def stg_movimientos(self, clientes: DataFrame, productos: DataFrame) -> DataFrame:
        """The trusted movements out of the state: equal to ``silver.stg_movimientos`` over all raw rows."""
        return silver.with_statistics(silver.acceptable(self.winners(), productos, self.ctx), self.window(), clientes)
