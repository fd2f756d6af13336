"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Every entry c becomes the integer x = floor(64 c) + 1000000. The fit list holds each different x vector once.
Entries are shifted by the smallest one of their dimension, so they are small and not negative, and a dimension
is written as bit planes: plane b packs bit b of many rows into words. The sum over rows of y_i y_j is then the
sum over planes of 2^(a + b) popcount(plane a of i AND plane b of j), in which only counts are added up by the
tasks and over them; a task returns D (D + 1) / 2 pairs x planes numbers, whatever its rows. The driver puts the
counts together as Python integers, centres them as integers (n sum(xy) - sum(x) sum(y)) and only then divides.
Components are the eigenvectors of the result.

Defined results: rows whose vector is null, empty or holds null or non-finite entries are dropped; so are
vectors of another length than the most frequent one (of equally frequent ones the longest); components
without variance (below ``RANK`` of the largest eigenvalue) are left out, so an empty or constant table gives
no rows; of an eigenvector the largest entry is positive; with tied eigenvalues any basis will do; 64 c beyond
2^62 counts as 2^62; repeated rows are returned each; a deviation beyond 64 bits is null in ``deviation`` and
exact in ``deviation_exact`` (null there beyond 38 digits); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from formline.session import store

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
RANK = 1e-11
ROWS = 4096
EDGE = float(2**62)


def quantised(vector: Column) -> Column:
    """floor(64 c) + 1000000 of every entry, as long."""
    held = lambda c: F.least(F.greatest(c.cast("double") * SCALE, F.lit(-EDGE)), F.lit(EDGE))
    return F.transform(vector, lambda c: F.floor(held(c)).cast("long") + F.lit(SHIFT))


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``_id`` and ``_x`` of the rows with finite entries."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
    return rows.select(F.col(vec_id).alias("_id"), quantised(v).alias("_x"))


def matrices(batches: Iterator[pa.RecordBatch], size: int, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most ``ROWS`` rows with the list column as a matrix."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            yield batch, batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def extents(fit: DataFrame, size: int) -> tuple[int, list[int], list[int]]:
    """Rows of the fit list, and the smallest and largest entry of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n = None, None, 0
        for _, x in matrices(batches, size, 0):
            low = x.min(0) if low is None else np.minimum(low, x.min(0))
            high = x.max(0) if high is None else np.maximum(high, x.max(0))
            n += len(x)
        if n:
            columns = [np.arange(size), low, high, np.full(size, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_d", "_low", "_high", "_n"])

    found = fit.select("_x").mapInArrow(run, "_d bigint, _low bigint, _high bigint, _n bigint")
    rows = found.groupBy("_d").agg(F.min("_low"), F.max("_high"), F.sum("_n")).orderBy("_d").collect()  # a row per dimension
    return (rows[0][3] if rows else 0), [r[1] for r in rows], [r[2] for r in rows]


def bit_planes(y: np.ndarray, planes: list[int]) -> np.ndarray:
    """A row of 64-bit words per plane of each dimension: bit r of the words is the plane's bit in row r of ``y``."""
    pad = -len(y) % 64
    bits = np.concatenate([(y[:, d, None] >> np.arange(p, dtype=np.uint64)) & np.uint64(1) for d, p in enumerate(planes)], 1)
    bits = np.pad(bits.astype(np.uint8).T, ((0, 0), (0, pad)))
    return np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view(np.uint64)


def scatter(fit: DataFrame, low: list[int], high: list[int]) -> tuple[list[int], list[list[int]]]:
    """Exact sums of y_i and of y_i y_j over the fit list, y being x less the smallest entry of its dimension."""
    size = len(low)
    planes = [max(int(h - o).bit_length(), 1) for o, h in zip(low, high)]
    of = np.repeat(np.arange(size), planes)  # dimension and weight of each plane
    weight = np.concatenate([np.arange(p) for p in planes])
    least = np.array(low, np.int64)
    # A pair of planes adds to (smaller dimension, larger dimension, weight); those are numbered.
    i, j = np.triu_indices(len(of))
    twice = np.where((of[i] == of[j]) & (i != j), 2, 1)
    names = np.stack([of[i], of[j], weight[i] + weight[j]], 1)
    keys, slot = np.unique(names, axis=0, return_inverse=True)
    row_starts = np.concatenate(([0], np.cumsum(np.arange(len(of), 0, -1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, ones, seen = np.zeros(len(i), np.int64), np.zeros(len(of), np.int64), False
        for _, x in matrices(batches, size, 0):
            seen = True
            words = bit_planes((x - least).view(np.uint64), planes)
            for a in range(len(of)):
                both = np.bitwise_count(words[a:] & words[a]).sum(1, dtype=np.int64)
                pairs[row_starts[a] : row_starts[a + 1]] += both
                ones[a] += both[0]
        if seen:
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, slot, pairs * twice)
            columns = [
                np.concatenate([keys[:, 0], of]),
                np.concatenate([keys[:, 1], np.full(len(of), -1)]),
                np.concatenate([keys[:, 2], weight]),
                np.concatenate([counts, ones]),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["_i", "_j", "_w", "_n"])

    counted = fit.select("_x").mapInArrow(run, "_i bigint, _j bigint, _w bigint, _n bigint")
    sums, products = [0] * size, [[0] * size for _ in range(size)]
    added = counted.groupBy("_i", "_j", "_w").agg(F.sum("_n").alias("_n"))
    for row in added.where(F.col("_n") > 0).collect():  # the size of the model: pairs of dimensions x planes
        if row["_j"] < 0:
            sums[row["_i"]] += row["_n"] << row["_w"]
        else:
            products[row["_i"]][row["_j"]] += row["_n"] << row["_w"]
    for a in range(size):
        for b in range(a):
            products[a][b] = products[b][a]
    return sums, products


@dataclass
class Whitening:
    """n rows with sums S of x; unit eigenvectors (columns) by falling eigenvalue; their share of the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    span: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact; plain integers where 64 bits could run over."""
        if self.n * (abs(self.span) + 1) < 2**62:
            # x lies within span of the mean of its dimension, so remainders of 2^64 come out right.
            with np.errstate(over="ignore"):
                sums = np.array([s % 2**64 for s in self.sums], np.uint64)
                return (x.view(np.uint64) * np.uint64(self.n % 2**64) - sums).view(np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ self.vectors / np.sqrt(self.values)


def fit_whitening(fit: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    n, low, high = extents(fit, size)
    if not n:
        return None
    sums, products = scatter(fit, low, high)
    centred = [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    covariance = np.array([[c / (n * n) for c in row] for row in centred])  # integers divide with one rounding
    trace = sum(centred[i][i] for i in range(size)) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    alive = values > RANK * max(values[0], 0.0)
    values, vectors = values[alive], vectors[:, alive]
    if not len(values) or trace <= 0:
        return None
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
    whole = [s + n * o for s, o in zip(sums, low)]
    return Whitening(n, whole, vectors * signs, values, values / trace, max(h - o for o, h in zip(low, high)))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance less the identity."""
    size, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for _, x in matrices(batches, size, 0):
            w = model.project(model.centred(x))
            total += np.vstack([w.T @ w, w.sum(0)[None]])
        at, to = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(c.ravel()) for c in (at, to, total)], ["_i", "_j", "_v"])

    sums = np.zeros((k + 1, k))
    added = fit.select("_x").mapInArrow(run, "_i bigint, _j bigint, _v double").groupBy("_i", "_j").agg(F.sum("_v"))
    for i, j, v in added.collect():  # components squared
        sums[i, j] = v
    mean = sums[k] / model.n
    return float(np.abs(sums[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per usable row and component: ``vec_id`` and the columns of ``OUT``."""
    spark = vectors.sparkSession
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows = usable(vectors, vec_id, vector)
    lengths = rows.groupBy(F.size("_x").alias("_size")).agg(F.count(F.lit(1)).alias("_n"))
    common = lengths.orderBy(F.desc("_n"), F.desc("_size")).first()
    size = common["_size"] if common else 0
    rows = rows.where(F.size("_x") == size)
    # Copies are combined before the shuffle, so a vector that very many rows share is one row per task.
    fit = store(rows.select("_x").distinct(), "whitening-fit")
    model = fit_whitening(fit, size, components) if size else None
    schema = f"_id {kind}, {OUT}"
    if model is None:
        return spark.createDataFrame([], schema).withColumnRenamed("_id", vec_id)
    error = identity_error(fit, model)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches, size, 1):
            centred = model.centred(x)
            whitened = model.project(centred)
            if centred.dtype == object or size * (model.n * (model.span + 1)) ** 2 >= 2**63:
                centred = centred.astype(object)
            exact = (centred**2).sum(1).tolist()
            each = np.repeat(np.arange(len(x)), k)
            spread = [int(exact[i]) for i in each.tolist()]
            columns = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), model.n)),
                pa.array([v if v < 2**63 else None for v in spread], pa.int64()),
                pa.array(whitened.ravel()),
                pa.array(np.tile(model.explained, len(x))),
                pa.array(np.full(len(each), error)),
                pa.array([v if v < 10**38 else None for v in spread], pa.decimal128(38, 0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_id", *(c.split()[0] for c in OUT.split(", "))])

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", vec_id)
