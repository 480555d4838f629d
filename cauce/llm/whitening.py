"""Embedding whitening over an exact scatter matrix, added up from bit-sliced columns.

A component ``c`` becomes the whole number ``floor(scale * c) + offset``. Rows are taken in blocks. In a block each
dimension is shifted by its minimum, and every bit plane of the shifted numbers is packed across the rows into 64-bit words. The
cross-product of two dimensions is the sum of ``2^(p+q)`` times the population count of plane p AND plane q. Shifts are
taken back in whole numbers, blocks are added up in whole numbers (three limbs a sum, added by Spark), and so is the
centring: ``n * M - S * S'`` is exact. Only then the matrix becomes double, and ``eigh`` gives its components.

What comes to the driver is a matrix of the dimensions, whatever the number of rows; every row is read by the scatter, by
the check of the whitened rows, and by the output.

Defined results: vectors that are null, empty, or hold null or non-finite entries take no part, nor do those of another
length than the most common one (of equally common ones the shortest); numbers beyond 2^62 are held at 2^62; components whose
eigenvalue is zero to double precision cannot be whitened and are left out, so equal or too few vectors give fewer components or
no rows; null ids and repeated rows are rows like any others; a deviation beyond 64 bits is null; an empty table gives no
rows. Columns besides vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.common import table

SCALE = 64
OFFSET = 1_000_000
BLOCK = 1 << 14
LIMB = 48
HELD = float(1 << 62)


def whole_numbers(vectors: np.ndarray, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    """floor(scale * c) + offset as 64-bit integers."""
    return np.clip(np.floor(vectors.astype(np.float64) * scale), -HELD, HELD).astype(np.int64) + offset


def planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes (one row of 64-bit words each), with dimension and weight (the place) of each; rows fill up with zeros."""
    words, dims, places = [], [], []
    for d, column in enumerate(np.ascontiguousarray(shifted.T)):
        for p in range(int(column.max()).bit_length()):
            bits = np.packbits(((column >> np.uint64(p)) & np.uint64(1)).astype(np.uint8))
            words.append(np.pad(bits, (0, -len(bits) % 8)).view(np.uint64))
            dims.append(d)
            places.append(p)
    return np.array(words), np.array(dims, np.int64), np.array(places, np.int64)


def scatter(x: np.ndarray) -> tuple[int, list[int], np.ndarray]:
    """(rows, sums by dimension, matrix of cross-products), in whole numbers of any size, of a block of 64-bit integers."""
    rows, wide = x.shape
    low = [int(v) for v in x.min(0)]
    shifted = (x - x.min(0)).view(np.uint64)  # differences of 64-bit integers are exact without a sign
    words, dims, places = planes(shifted)
    cross = np.zeros((wide, wide), object)
    sums = [0] * wide
    for k in range(len(words)):
        both = np.bitwise_count(words[k:] & words[k]).sum(1, dtype=np.int64)
        sums[dims[k]] += int(both[0]) << int(places[k])
        for place in np.unique(places[k:]):  # planes of one place belong to different dimensions
            at = places[k:] == place
            of = dims[k:][at]
            weighted = both[at].astype(object) * (1 << int(places[k] + place))
            cross[dims[k], of] += weighted
            cross[of, dims[k]] += np.where(dims[k:][at] == dims[k], weighted if place != places[k] else 0, weighted)
    own = np.array(sums, object)
    m = np.array(low, object)
    cross = cross + np.outer(m, own) + np.outer(own, m) + rows * np.outer(m, m)
    return rows, [int(s + rows * v) for s, v in zip(own, m)], cross


def _vectors(batches: Iterator[pa.RecordBatch], wide: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            piece = batch.slice(start, BLOCK)
            flat = piece.column("embedding").flatten().to_numpy(zero_copy_only=False)
            yield piece, flat.reshape(-1, wide)


def _partials(wide: int, scale: int, offset: int):
    """One row (i, j, limbs) per entry of the upper triangle, i = -1 for the sums and j = -1 with it for the count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, cross = 0, np.zeros(wide, object), np.zeros((wide, wide), object)
        for _, vectors in _vectors(batches, wide):
            if len(vectors):
                n, s, c = scatter(whole_numbers(vectors, scale, offset))
                count, sums, cross = count + n, sums + np.array(s, object), cross + c
        if not count:
            return
        i, j = np.triu_indices(wide)
        values = [count, *sums.tolist(), *cross[i, j].tolist()]
        mask = (1 << LIMB) - 1
        yield pa.RecordBatch.from_arrays([
            pa.array([-1] * (wide + 1) + i.tolist(), pa.int32()), pa.array([-1, *range(wide), *j.tolist()], pa.int32()),
            pa.array([v & mask for v in values], pa.int64()), pa.array([(v >> LIMB) & mask for v in values], pa.int64()),
            pa.array([v >> 2 * LIMB for v in values], pa.int64())], ["i", "j", "l0", "l1", "l2"])
    return run


@dataclass
class Model:
    """Exact count and sums, and what whitens: eigenvalues, directions (columns, divided by the root) and explained shares."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    explained: np.ndarray


def exact_scatter(vectors: DataFrame, wide: int, scale: int = SCALE, offset: int = OFFSET) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, cross-products) of all rows as Python integers; comes to the driver as (wide + 1)^2 / 2 rows."""
    wider = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("l0", "l1", "l2")]
    found = vectors.select("embedding").mapInArrow(_partials(wide, scale, offset), "i int, j int, l0 long, l1 long, l2 long").groupBy(
        "i", "j").agg(*wider).collect()
    n, sums, cross = 0, [0] * wide, np.zeros((wide, wide), object)
    for r in found:
        value = int(r.l0) + (int(r.l1) << LIMB) + (int(r.l2) << 2 * LIMB)
        if r.j < 0:
            n = value
        elif r.i < 0:
            sums[r.j] = value
        else:
            cross[r.i, r.j] = cross[r.j, r.i] = value
    return n, sums, cross


def components_of(n: int, sums: list[int], cross: np.ndarray, most: int) -> Model:
    """Centres in whole numbers, then the eigenvectors by falling eigenvalue; zero eigenvalues are left out."""
    s = np.array(sums, object)
    centred = n * cross - np.outer(s, s)
    matrix = np.array([[v / (n * n) for v in row] for row in centred.tolist()], float)  # integers divide with one rounding
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = values > len(values) * np.finfo(float).eps * max(values[0], 0.0)
    trace = sum(int(centred[k, k]) for k in range(len(sums))) / (n * n)
    kept = np.flatnonzero(some)[:most]
    return Model(n, sums, values[kept], vectors[:, kept] / np.sqrt(values[kept]), values[kept] / trace if trace else values[kept])


def _rows(model: Model, scale: int, offset: int, vectors: np.ndarray) -> tuple[list, np.ndarray]:
    """(deviations, whitened rows) of a block."""
    x = whole_numbers(vectors, scale, offset)
    if not len(x):
        return [], np.empty((0, len(model.values)))
    most = model.n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, model.sums))
    apart = x * model.n - np.array(model.sums, np.int64) if most < 1 << 62 else x.astype(object) * model.n - np.array(model.sums, object)
    far = max(abs(int(apart.min())), abs(int(apart.max())))
    exact = apart if len(model.sums) * far * far < 1 << 63 else apart.astype(object)
    deviation = [int(v) if int(v) < 1 << 63 else None for v in (exact * exact).sum(1)]
    return deviation, (apart / model.n).astype(float) @ model.directions


def _moments(model: Model, wide: int, scale: int, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(model.values)
        total, cross = np.zeros(size), np.zeros((size, size))
        for _, vectors in _vectors(batches, wide):
            z = _rows(model, scale, offset, vectors)[1]
            total, cross = total + z.sum(0), cross + z.T @ z
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(-1, size), size), pa.int32()), pa.array(np.tile(np.arange(size), size + 1), pa.int32()),
            pa.array(np.concatenate([total, cross.ravel()]))], ["i", "j", "v"])
    return run


def _whitened(model: Model, wide: int, scale: int, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(model.values)
        for piece, vectors in _vectors(batches, wide):
            deviation, z = _rows(model, scale, offset, vectors)
            made = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * size), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([piece.column("vec_id"), pa.array(deviation, pa.int64()), made], ["vec_id", "deviation", "z"])
    return run


def whiten(vectors: DataFrame, most: int = 32, scale: int = SCALE, offset: int = OFFSET) -> tuple[DataFrame, Model | None, float]:
    """(rows: vec_id, deviation, z as an array by component), the model, and the largest entry of cov(z) - identity."""
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        "embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    length = valid.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    wide = length[0] if length else 0
    valid = valid.where(F.size("embedding") == wide)
    model = components_of(*exact_scatter(valid, wide, scale, offset), most) if wide else None
    if model is None or not len(model.values):
        return valid.limit(0).selectExpr("vec_id", "0L AS deviation", "embedding AS z"), model, 0.0
    size = len(model.values)
    sums = valid.select("embedding").mapInArrow(_moments(model, wide, scale, offset), "i int, j int, v double").groupBy("i", "j").agg(
        F.sum("v").alias("v")).collect()  # components^2 rows
    seen = np.zeros((size + 1, size))
    for r in sums:
        seen[r.i, r.j] = r.v / model.n  # i = -1, the means, is the last row
    error = float(np.abs(seen[:-1] - np.outer(seen[-1], seen[-1]) - np.eye(size)).max())
    return valid.mapInArrow(_whitened(model, wide, scale, offset), "vec_id long, deviation long, z array<double>"), model, error


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model, error = whiten(table(spark, sf_dir, "embeddings"))
    explained = F.array(*(F.lit(float(e)) for e in model.explained)) if model and len(model.explained) else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
