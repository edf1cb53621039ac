"""Whitening embeddings by pivoted Cholesky and one-sided Jacobi.

Vectors are put on a grid of whole numbers, and each distinct one counts once for the mean
and the covariance. Their centred scatter, one small matrix, is gathered from the tasks. Its
pivoted Cholesky factor is rotated from the right until its columns are at right angles:
their squared norms are the eigenvalues, and the columns themselves, at length one, the
components, so the factor is never multiplied out again and small eigenvalues keep their
digits. Rank that the factor doesn't have gives no component.

Sums of whole numbers are exact. The driver and every task hold a few matrices of the
vectors' dimension, whatever the number of rows: each task sums its own, ``GATHERED`` tasks
sum those, and the driver adds up at most that many.

Left out are rows whose vector is null, empty, or has null or non-finite entries or such as
don't fit the grid (``LARGEST``), and rows of another dimension than the most frequent one
(of equally frequent ones the largest). Repeated rows and null keys keep a row each. Without
two different vectors there are no components and no rows. Equal eigenvalues have components
in no fixed order. A ``deviation`` beyond a long, which takes some ten million distinct
vectors or entries in the thousands, is null. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedquality.llm.text import map_batches, read
from feedquality.session import stage

#: Steps of the grid in one unit, and the components that are returned.
GRID, COMPONENTS = 256, 4
#: Entries have to be below this on the grid.
LARGEST = 1 << 52
#: Pivots below this share of the largest are rounding and end the factor.
RANK = 1e-12
#: Tasks that sum what the others found.
GATHERED = 32
#: Bits of an entry that are summed apart, so that sums can't overflow.
LOW = 26
#: Columns this close to right angles, as a cosine, are left; and sweeps in which that is reached.
ANGLE, SWEEPS = 1e-15, 60

WHITENED = [
    T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
]


class Model(NamedTuple):
    """Sums and the components, a column each, with their eigenvalues, largest first."""

    n: int
    sums: list[int]
    mean: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact squared distance of each ``n * x`` from the sums."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        exact = np.int64 if most ** 2 * len(self.sums) < 2 ** 63 else object
        d = x.astype(exact) * self.n - np.array(self.sums, exact)
        return [v if v < 2 ** 63 else None for v in (d * d).sum(axis=1).tolist()]


def on_grid(vector: Column) -> Column:
    """The vector as whole numbers; null for one that is left out."""
    steps = F.transform(vector, lambda v: v.cast("double") * GRID)
    good = F.forall(steps, lambda s: s.isNotNull() & (F.abs(s) < LARGEST))
    return F.when(good & (F.size(vector) > 0), F.transform(steps, lambda s: F.floor(s)))


def matrix(column: pa.Array) -> np.ndarray:
    """A batch of vectors, none null and all of one dimension, as rows."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def summed(df: DataFrame, column: str, function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``function`` over all batches of vectors, None without any. It gives arrays of one shape
    and type; whole numbers come back as Python's, without bounds."""
    def task(batches: Iterator[pa.RecordBatch], array: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> Iterator:
        total = None
        for batch in batches:
            for found in array(batch):
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pylist([{"sum": total.tobytes(), "shape": list(total.shape), "type": total.dtype.str}])

    def again(row: dict) -> np.ndarray:
        return np.frombuffer(row["sum"], row["type"]).reshape(row["shape"])

    schema = T.StructType.fromDDL("sum binary, shape array<int>, type string")
    cast = pa.schema([("sum", pa.binary()), ("shape", pa.list_(pa.int32())), ("type", pa.string())])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (b.cast(cast) for b in task(batches, lambda b: iter([function(matrix(b.column(0)))] if len(b) else [])))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (b.cast(cast) for b in task(batches, lambda b: map(again, b.to_pylist())))

    parts = map_batches(map_batches(df.select(column), own, schema).repartition(GATHERED), gathered, schema).collect()
    found = [again(r.asDict()) for r in parts]
    return sum(f.astype(object) if f.dtype.kind == "i" else f for f in found) if found else None


def pivoted_cholesky(a: np.ndarray, rank: float = RANK) -> np.ndarray:
    """A factor of ``a`` (it times its transpose is ``a``): lower triangular but for the order of its rows,
    with a column for each pivot that is more than rounding."""
    a, size = a.copy(), len(a)
    order, factor = np.arange(size), np.zeros((size, size))
    rest = a.diagonal().copy()
    least, k = rank * rest.max(initial=0.0), 0
    while k < size:
        p = k + int(np.argmax(rest[k:]))
        if rest[p] <= least:
            break
        for rows in (order, rest, factor, a, a.T):
            rows[[k, p]] = rows[[p, k]]
        factor[k, k] = np.sqrt(rest[k])
        factor[k + 1:, k] = (a[k + 1:, k] - factor[k + 1:, :k] @ factor[k, :k]) / factor[k, k]
        rest[k + 1:] -= factor[k + 1:, k] ** 2
        k += 1
    unordered = np.empty((size, k))
    unordered[order] = factor[:, :k]
    return unordered


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors of the factor times its transpose, the largest first.

    A sweep turns every two columns to right angles; the columns are paired as in a tournament,
    so that the pairs of a round have nothing in common and turn together.
    """
    columns = factor.T.copy()  # a row here is a column of the factor
    m = len(columns)
    ring = [*range(m), *[-1] * (m % 2)]
    rounds = []
    for _ in range(len(ring) - 1):
        pairs = [(p, q) for p, q in zip(ring[:len(ring) // 2], ring[:len(ring) // 2 - 1:-1], strict=True) if min(p, q) >= 0]
        rounds.append(tuple(np.array(pairs, int).reshape(-1, 2).T))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    for _ in range(SWEEPS):
        turned = False
        for p, q in rounds:
            a, b = columns[p], columns[q]
            aa, bb, ab = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            open_ = np.abs(ab) > ANGLE * np.sqrt(aa * bb)
            if not open_.any():
                continue
            turned = True
            p, q, a, b = p[open_], q[open_], a[open_], b[open_]
            half = (bb - aa)[open_] / (2 * ab[open_])
            tan = np.where(half >= 0, 1.0, -1.0) / (np.abs(half) + np.hypot(1.0, half))
            cos = 1 / np.hypot(1.0, tan)
            sin = (cos * tan)[:, None]
            cos = cos[:, None]
            columns[p], columns[q] = cos * a - sin * b, sin * a + cos * b
        if not turned:
            break
    values = (columns * columns).sum(1)
    order = np.argsort(-values, kind="stable")
    columns, values = columns[order], values[order]
    vectors = (columns / np.sqrt(values)[:, None]).T
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(np.take_along_axis(vectors, largest[None], 0) < 0, -1.0, 1.0)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of the distinct vectors in column ``x``; None where nothing varies."""
    def parts(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> LOW).sum(axis=0), (x & ((1 << LOW) - 1)).sum(axis=0)])

    found = summed(distinct, "x", parts)
    if found is None:
        return None
    n, size = int(found[0]), len(found) // 2
    sums = [int(high) * (1 << LOW) + int(low) for high, low in zip(found[1:size + 1], found[size + 1:], strict=True)]
    mean = np.array([s / n for s in sums])

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ centred

    covariance = summed(distinct, "x", scatter) / n
    values, vectors = one_sided_jacobi(pivoted_cholesky(covariance))
    if not len(values):
        return None
    return Model(n, sums, mean, vectors[:, :components], values[:components], float(np.trace(covariance)))


def identity_error(distinct: DataFrame, model: Model) -> float:
    """How far the covariance of the whitened vectors is from the identity, measured over all of them."""
    def moments(x: np.ndarray) -> np.ndarray:
        w = model.whiten(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    found = summed(distinct, "x", moments) / model.n
    return float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(len(found[-1]))).max())


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """A row for each row that is not left out and each component: the key, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    spark = rows.sparkSession
    gridded = rows.select(F.col(key).alias("key"), on_grid(F.col(vector)).alias("x")).filter("x is not null")
    schema = T.StructType([T.StructField("key", gridded.schema["key"].dataType), *WHITENED])
    size = gridded.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    gridded = gridded.filter(F.size("x") == (size["size"] if size else 0))
    distinct = stage(gridded.select("x").distinct(), "distinct-vectors")
    model = fit(distinct, components)
    if model is None:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    shared = spark.sparkContext.broadcast((model, identity_error(distinct, model)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, error = shared.value
        m = len(model.values)
        for batch in batches:
            x, n = matrix(batch.column(1)), len(batch)
            if n:
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(np.arange(n), m))),
                    pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * m, model.n)),
                    pa.array([d for d in model.deviations(x) for _ in range(m)], pa.int64()),
                    pa.array(model.whiten(x).reshape(-1)),
                    pa.array(np.tile(model.values / model.trace, n)),
                    pa.array(np.full(n * m, error))], names=schema.names)

    return map_batches(gridded, each, schema).withColumnRenamed("key", key)


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(read(spark, sf, "embeddings"))
