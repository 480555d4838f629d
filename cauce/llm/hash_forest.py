"""Approximate nearest neighbours by a hash-prefix forest.

Equal vectors are one class; of its rows only as many as can appear in a result (``k`` + 1 of the smallest ids) are kept, so a
group of copies of any size is one entry. In each tree a class has a hash string: one bit for each of ``BITS`` seeded
hyperplanes, cut at the median of a sample. A tree is the classes sorted by these strings. It lies in partitions by the
strings' first ``depth`` bits; a query goes to the one partition of each tree that holds its own prefix. There it descends to
its longest matching prefix by binary search, and ascends, one bit at a time, until the range holds as many classes as a
partition should; all classes of the range are compared exactly, in double precision. The trees of a query ascend alike, since the same
number is asked of all. A query that has found fewer than ``k`` rows in all trees ascends to the root and is compared with everything.

``depth``, the number of trees and of classes that a range should hold come from the data: for ``SAMPLE_QUERIES`` queries the true
neighbours are found in one pass, and the classes that share their prefixes are counted in another. The deepest prefix is
taken at which at most ``TREES`` trees reach ``recall`` of these neighbours, in partitions of four times ``k`` classes on average at least. Vectors in
clusters allow deep prefixes and few trees; vectors without any structure (independent directions in 64 dimensions) only shallow ones.
Rows that are shuffled: vectors times trees, and queries times trees. A partition that holds more than ``BLOCK`` classes
all the same is cut into blocks, each of which its queries visit.

Defined results: vectors that are null, zero, or hold null or non-finite components, ids that are null, and vectors of
another length than the most common one take no part; ties go to the smaller vec_id; rows that repeat a vec_id are rows of their own:
each is a candidate for the other, and each, if it is a query, has its own ten; fewer candidates than k give fewer
rows; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cauce.llm.common import stored, table

BITS = 32
TREES = 12
BLOCK = 16_384
SAMPLE = 4_096
SAMPLE_QUERIES = 64
U = np.uint64


class Planes:
    """Hyperplanes and cuts of all trees."""

    def __init__(self, sample: np.ndarray, seed: int) -> None:
        self.planes = np.random.default_rng(seed).standard_normal((TREES, sample.shape[1], BITS))
        self.cuts = np.median(sample @ self.planes, axis=1)

    def strings(self, vectors: np.ndarray, trees: int) -> np.ndarray:
        """Hash strings by tree and vector."""
        places = U(1) << np.arange(BITS - 1, -1, -1, dtype=U)
        return np.stack([((vectors @ self.planes[t] > self.cuts[t]).astype(U) * places).sum(1, dtype=U) for t in range(trees)])


def _stack(column: pa.Array, wide: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, wide).astype(np.float64)


def _placed(planes: Planes, wide: int, trees: int, depth: int):
    """Each row once a tree: tree, prefix, string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for t, h in enumerate(planes.strings(_stack(batch.column("vec"), wide), trees)):
                    same = np.full(len(h), t, np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(same), pa.array((h >> U(BITS - depth)).astype(np.int64)), pa.array(h.astype(np.int64)), *batch.columns],
                        ["tree", "prefix", "h", *batch.schema.names])
    return run


def _nearest_of(far: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest, and of all equal to the last of them."""
    return np.arange(len(far)) if len(far) <= k else np.flatnonzero(far <= np.partition(far, k - 1)[k - 1])


def _compared(k: int, least: int, depth: int):
    """The k + 1 nearest classes to each query among those of one partition (or of one block of it)."""
    def run(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            rows = rows.sort_values(["h", "first", "cid"], ignore_index=True)
            vectors, asked = (np.stack(x.vec.to_numpy()).astype(np.float64) for x in (rows, queries))
            h, q, cid, first = rows.h.to_numpy(U), queries.h.to_numpy(U), rows.cid.to_numpy(), rows["first"].to_numpy()
            low, high = np.zeros(len(q), np.int64), np.full(len(q), len(h))
            least_here = max(4 * k, least // int(rows.blocks.iloc[0]))
            for bits in range(depth + 1, BITS + 1):  # the longest prefix whose range still holds enough
                free = U((1 << (BITS - bits)) - 1)
                a, b = np.searchsorted(h, q & ~free), np.searchsorted(h, q | free, side="right")
                longer = (b - a) >= least_here
                low, high = np.where(longer, a, low), np.where(longer, b, high)
                if not longer.any():
                    break
            for own, vec, a, b in zip(queries.cid, asked, low, high):
                far = np.sqrt(((vectors[a:b] - vec) ** 2).sum(1))
                near = _nearest_of(far, k + 1)
                found = sorted(zip(far[near].tolist(), first[a:b][near].tolist(), cid[a:b][near].tolist()))[:k + 1]
                out += [(own, c, f, d) for d, f, c in found]
        return pd.DataFrame(out, columns=["query", "cid", "first", "score"]).astype(
            {"query": "int64", "cid": "int64", "first": "int64", "score": "float64"})
    return run


def _true_neighbours(classes: DataFrame, sample: list, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(number of the query, neighbour's vector) of the sampled queries and their k nearest classes; one pass over all."""
    asked = np.array([r.vec for r in sample], float)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            vectors, cid = np.stack(frame.vec.to_numpy()).astype(np.float64), frame.cid.to_numpy()
            for number, (own, vec) in enumerate(zip(sample, asked)):
                far = ((vectors - vec) ** 2).sum(1)
                far[cid == own.cid] = np.inf
                near = np.argsort(far, kind="stable")[:k]
                near = near[np.isfinite(far[near])]
                yield pd.DataFrame({"number": number, "far": far[near], "vec": list(vectors[near])})
    found = classes.select("cid", "vec").mapInPandas(run, "number int, far double, vec array<double>").withColumn(
        "turn", F.row_number().over(Window.partitionBy("number").orderBy("far"))).where(F.col("turn") <= k).collect()
    return np.array([r.number for r in found], np.int64), [np.array(r.vec) for r in found]


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the prefix that strings share."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def _prefix_counts(classes: DataFrame, planes: Planes, sample: list, wide: int) -> np.ndarray:
    """How many classes share at least so many bits with each sampled query in each tree: (query, tree, bits); one pass over all."""
    strings = planes.strings(np.array([r.vec for r in sample], float), TREES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(sample), TREES, BITS + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                for t, h in enumerate(planes.strings(_stack(batch.column("vec"), wide), TREES)):
                    for q in range(len(sample)):
                        counts[q, t] += np.bincount(_shared_bits(h, strings[t, q]), minlength=BITS + 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], ["at", "n"])
    found = classes.select("vec").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((len(sample), TREES, BITS + 1), np.int64)
    for r in found:
        counts.ravel()[r["at"]] = r.n
    return counts[:, :, ::-1].cumsum(2)[:, :, ::-1]


def chosen_depth(shared: np.ndarray, of: np.ndarray, counts: np.ndarray, classes: int, k: int, recall: float) -> tuple[int, int, int]:
    """(depth, trees, least): the deepest partitions in which at most TREES trees find this share of the sampled neighbours.

    ``shared``: bits that each pair of a query (number ``of``) and a true neighbour shares, by tree; ``counts`` as
    ``_prefix_counts`` gives them. A pair is found where it shares the longest prefix, of ``depth`` bits or more, that
    ``least`` classes have.
    """
    most = int(np.log2(max(classes / (4 * k), 1)))
    for depth in range(min(most, BITS), 0, -1):
        for wider in (1, 4, 16, 64):
            least = wider * (classes >> depth)
            enough = (counts >= least) & (np.arange(BITS + 1) > depth)
            longest = np.where(enough.any(2), BITS - enough[:, :, ::-1].argmax(2), depth)
            met = np.logical_or.accumulate(shared >= longest[of].T, axis=0).mean(1)
            if len(of) and met[-1] >= recall:
                return depth, int(np.argmax(met >= recall)) + 1, least
    return 0, 1, classes


def _searched(classes: DataFrame, questions: DataFrame, planes: Planes, wide: int, k: int, depth: int, trees: int, least: int) -> DataFrame:
    """(query, cid, score) of the nearest classes that the trees hold for each query, each once."""
    schema = f"tree int, prefix long, h long, cid long, first long, vec {dict(classes.dtypes)['vec']}"
    rows, asked = (df.select("cid", "first", "vec").mapInArrow(_placed(planes, wide, trees, depth), schema) for df in (classes, questions))
    large = stored(rows.groupBy("tree", "prefix").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("long").alias("blocks")).where("blocks > 1"),
                   "forest-blocks")
    some = not large.isEmpty()
    cut = lambda df: (df.join(large, ["tree", "prefix"], "left") if some else df.withColumn("blocks", F.lit(1).cast("long"))).withColumn(
        "blocks", F.coalesce("blocks", F.lit(1)))
    placed = cut(rows).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    sent = cut(asked).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    keys = ["tree", "prefix", "block"]
    found = placed.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(
        _compared(k, least, depth), "query long, cid long, first long, score double")
    once = found.groupBy("query", "cid", "first").agg(F.min("score").alias("score"))
    return once.withColumn("turn", F.row_number().over(Window.partitionBy("query").orderBy("score", "first", "cid"))).where(
        F.col("turn") <= k + 1).drop("turn")


def _fitted(classes: DataFrame, planes: Planes, sample: list, wide: int, n: int, k: int, recall: float) -> tuple[int, int, int]:
    if not sample:
        return 0, 1, n
    of, near = _true_neighbours(classes, sample, k)
    if not len(of):
        return 0, 1, n
    strings = planes.strings(np.array([r.vec for r in sample], float), TREES)
    shared = _shared_bits(strings[:, of], planes.strings(np.array(near), TREES))
    return chosen_depth(shared, of, _prefix_counts(classes, planes, sample, wide), n, k, recall)


def nearest(vectors: DataFrame, query_ids: Column, k: int = 10, recall: float = 0.95, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that ``query_ids`` (a condition on vec_id) selects."""
    kind = dict(vectors.dtypes)["embedding"]
    kind = kind if kind == "array<float>" else "array<double>"
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("vec")).where(
        "vec_id IS NOT NULL AND vec IS NOT NULL AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
        "AND exists(vec, x -> x != 0)")
    length = valid.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    wide = length[0] if length else 0
    valid = valid.where(F.size("vec") == wide)
    smallest = valid.withColumn("turn", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("turn") <= k + 1)
    classes = stored(smallest.groupBy("vec").agg(F.min("vec_id").alias("first"), F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn(
        "cid", F.xxhash64("vec")), "classes")
    asked = stored(valid.where(query_ids).groupBy(F.col("vec_id").alias("query_id"), "vec").agg(F.count("*").alias("copies")).join(
        classes.select("vec", "cid", "first"), "vec").select("query_id", "copies", "cid", "first", "vec"), "queries")
    questions = asked.select("cid", "first", "vec").dropDuplicates(["cid"])
    n, rows = classes.agg(F.count("*"), F.sum(F.size("ids"))).first()
    by_hash = F.xxhash64("cid", F.lit(seed))
    sample = classes.select("cid", "vec").orderBy(by_hash, "cid").limit(SAMPLE).collect()
    ranked = None
    if sample:
        planes = Planes(np.array([r.vec for r in sample], float), seed)
        tried = questions.orderBy(by_hash, "cid").limit(SAMPLE_QUERIES).collect()
        depth, trees, least = _fitted(classes, planes, tried, wide, n, k, recall)
        ranked = stored(_ranked(asked, classes, _searched(classes, questions, planes, wide, k, depth, trees, least), k), "nearest")
        found = ranked.groupBy("query_id", "cid").agg(F.count("*").alias("n"))
        short = asked.join(found, ["query_id", "cid"], "left").where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k), F.lit(rows - 1)) * F.col("copies"))
        short = short.select(*asked.columns)
        if depth and not short.isEmpty():
            short = stored(short, "short")
            again = _searched(classes, short.select("cid", "first", "vec").dropDuplicates(["cid"]), planes, wide, k, 0, 1, n)
            ranked = ranked.join(short, ["query_id", "cid"], "left_anti").unionByName(_ranked(short, classes, again, k))
    if ranked is None:
        ranked = _ranked(asked, classes, classes.selectExpr("cid AS query", "cid", "first", "0.0D AS score").limit(0), k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _ranked(asked: DataFrame, classes: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """query_id, cid (the query's class), rank, vec_id, score of the rows of the found classes, without the query's own row."""
    several = classes.where(F.size("ids") > 1).select("cid", "ids")
    rows = found.join(several, "cid", "left").withColumn("vec_id", F.explode(F.coalesce("ids", F.array("first")))).select(
        "query", "vec_id", "score", (F.col("cid") == F.col("query")).alias("own"))
    best = rows.withColumn("turn", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).where(F.col("turn") <= k + 1)
    # the query's own row is one of those of its class and id
    mine = Window.partitionBy("query_id", "cid").orderBy(F.col("self").desc(), "turn")
    others = asked.select("query_id", "copies", "cid").join(best.withColumnRenamed("query", "cid"), "cid").withColumn(
        "self", (F.col("own") & (F.col("vec_id") == F.col("query_id"))).cast("int")).withColumn("at", F.row_number().over(mine)).where(
        (F.col("self") == 0) | (F.col("at") > 1))
    order = Window.partitionBy("query_id", "cid").orderBy("score", "vec_id", "turn")
    return others.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("query_id", "cid", "rank", "vec_id", "score")


def op10_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
