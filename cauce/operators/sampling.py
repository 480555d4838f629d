"""An exact, reproducible sample of a share of the rows, without a global sort."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

BUCKETS = 65536
COPIES_PER_TASK_ROW = 100_000


def row_digest(columns: Sequence[str], seed: str) -> Column:
    """A hex digest that orders rows at random but always alike.

    Over all columns of a row, so that rows which share a key, or have none, spread over all digests.
    """
    return _seeded(_row_text(columns), seed)


def _row_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def _seeded(text: Column, seed: str) -> Column:
    return F.md5(F.concat(text, F.lit(f"|{seed}")))


def digest_number(digest: Column, start: int) -> Column:
    """Eight hex digits of a digest, from the 1-based position on, as a number below 2**32."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


@dataclass(frozen=True)
class Sample:
    """``near`` holds the sampled rows (``_rank`` 1..size) and a few others (``_rank`` NULL), each
    with its ``_digest``; ``far`` holds all remaining rows. Together they are the whole table."""

    size: int
    near: DataFrame
    far: DataFrame

    @property
    def picked(self) -> DataFrame:
        return self.near.where(F.col("_rank").isNotNull())


def exact_sample(df: DataFrame, share: float, seed: str) -> Sample:
    """The ``int(rows * share)`` rows with the lowest digest of row and seed, ranked.

    A first pass counts rows per digest bucket; these 65536 counts at most are all that reaches the
    driver. They tell which buckets can hold sampled rows. Only those rows, about the sampled share,
    are shuffled and ranked, in one window per bucket; the other rows pass through untouched.

    Rows equal in all columns are ranked as one row with a multiplicity, so a group of copies of any
    size is one row in the window; afterwards it is dealt out again in blocks.
    """
    columns = df.columns
    digest = row_digest(columns, seed)
    bucket = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")
    counts = {r["_bucket"]: r["count"] for r in df.groupBy(bucket.alias("_bucket")).count().collect()}
    size = int(sum(counts.values()) * share)
    offsets, before = {}, 0
    for number in sorted(counts):
        if before >= size:
            break
        offsets[number] = before
        before += counts[number]
    last = max(offsets, default=-1)

    spark = df.sparkSession
    starts = spark.createDataFrame(list(offsets.items()), "_bucket int, _before bigint")
    rows = (
        df.where(bucket <= last)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumns({"_digest": digest, "_bucket": bucket})
        .join(starts, "_bucket")
    )
    order = [F.col("_digest").asc()] + [F.col(c).asc_nulls_first() for c in columns]
    so_far = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.withColumn("_start", F.col("_before") + F.sum("_copies").over(so_far) - F.col("_copies"))
    blocks = ranked.withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(COPIES_PER_TASK_ROW)))
    ).repartition(spark.sparkContext.defaultParallelism)
    end = F.least(F.col("_from") + COPIES_PER_TASK_ROW, F.col("_copies"))
    copies = blocks.withColumn("_copy", F.explode(F.sequence(F.col("_from") + 1, end)))
    rank = F.col("_start") + F.col("_copy")
    near = copies.select(*columns, "_digest", F.when(rank <= size, rank).alias("_rank"))
    return Sample(size, near, df.where(bucket > last))


@dataclass(frozen=True)
class Samples:
    """Several samples of one table. ``near`` holds all sampled rows and a few others, with ``_rank_<name>`` (NULL where the sample
    has not picked the row) and ``_digest_<name>``; ``far`` holds the remaining rows. Together they are the whole table."""

    sizes: Mapping[str, int]
    near: DataFrame
    far: DataFrame

    def picked(self, name: str) -> DataFrame:
        """The rows of one sample, with its ``_rank`` and ``_digest``."""
        return self.near.where(F.col(f"_rank_{name}").isNotNull()).withColumns(
            {"_rank": F.col(f"_rank_{name}"), "_digest": F.col(f"_digest_{name}")})


def _below(digest: Column, part: float) -> Column:
    """Whether the first eight digits, as a number, are below that part of 2**32; compared as texts of one length."""
    limit = int(part * 2**32)
    return F.substring(digest, 1, 8) < f"{limit:08x}" if limit < 2**32 else F.lit(True)


def ranked_samples(
    df: DataFrame, shares: Mapping[str, float], seeds: Mapping[str, str], sizes: Callable[[int], Mapping[str, int]], path: str
) -> Samples:
    """The rows with the lowest digests for each of several seeds, ranked, in two reads of the table.

    The first read counts the rows and writes those whose digest is low enough for any sample to ``path``: a quarter more
    than the share, and a thousandth of the table. That nearly always holds every sampled row; if one of the samples turns out
    short, four times as many are written. Ranks come from the written rows alone: rows equal in all columns are one
    row with a multiplicity, buckets of digests are ranked apart, and their offsets are a prefix sum over 65536 counts. The
    second read is that of ``far``, left to the caller. ``sizes`` says how many rows each sample takes, given the table's number.
    """
    columns, spark, wider = df.columns, df.sparkSession, 1.0
    digests = {name: row_digest(columns, seed) for name, seed in seeds.items()}
    while True:
        limits = {name: min(1.0, wider * (1.25 * share + 0.001)) for name, share in shares.items()}
        low = {name: _below(digests[name], limits[name]) for name in shares}
        # the row's text, the dear part, is made once for all digests: a lambda's argument is evaluated once
        some = F.exists(F.array(_row_text(columns)), lambda text: reduce(or_, (_below(_seeded(text, seeds[n]), limits[n]) for n in shares)))
        observed = Observation()
        (
            df.observe(observed, F.count(F.lit(1)).alias("n")).where(some)
            .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        )
        stored = spark.read.schema(df.schema).parquet(path)
        wanted = dict(sizes(observed.get["n"]))
        held = stored.agg(*(F.count_if(c).alias(name) for name, c in low.items())).first()
        if all(held[name] >= wanted[name] for name in wanted) or min(limits.values()) == 1.0:
            break
        wider *= 4

    rows = stored.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumns({f"_digest_{n}": d for n, d in digests.items()})
    order = [F.col(c).asc_nulls_first() for c in columns]
    for name in shares:
        digest = F.col(f"_digest_{name}")
        bucket = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int").alias("_bucket")
        own = rows.where(_below(digest, limits[name])).select(*columns, "_copies", f"_digest_{name}", bucket)
        counts = own.groupBy("_bucket").agg(F.sum("_copies").alias("_n"))
        earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # 65536 rows at most
        starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        so_far = Window.partitionBy("_bucket").orderBy(digest, *order).rowsBetween(Window.unboundedPreceding, 0)
        ranked = own.join(starts, "_bucket").withColumn(
            f"_start_{name}", F.col("_before") + F.sum("_copies").over(so_far) - F.col("_copies")).select(f"_digest_{name}", f"_start_{name}")
        rows = rows.join(ranked, f"_digest_{name}", "left")  # a digest stands for one row, copies being one
    blocks = rows.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(COPIES_PER_TASK_ROW))))
    end = F.least(F.col("_from") + COPIES_PER_TASK_ROW, F.col("_copies"))
    copies = blocks.repartition(spark.sparkContext.defaultParallelism).withColumn("_copy", F.explode(F.sequence(F.col("_from") + 1, end)))
    rank = {name: F.col(f"_start_{name}") + F.col("_copy") for name in shares}
    near = copies.select(*columns, *(f"_digest_{n}" for n in shares), *(F.when(rank[n] <= wanted[n], rank[n]).alias(f"_rank_{n}") for n in shares))
    return Samples(wanted, near, df.where(~some))
