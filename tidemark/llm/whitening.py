"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Vectors are quantised to integers, x = floor(256 * c).  Mean and scatter are
taken over the *fit list*, every distinct integer vector once, by Spark jobs
that add up one small partial per task.  Rows are centred before multiplying:
at the integer next to the mean, so that products and sums of ordinary data
are whole numbers below 2**53 and come out the same in any order; the rest of
the centring, less than one half per dimension, follows from the exact sums.

The scatter (dimensions squared, whatever the number of rows) is factored on
the driver: ``pivoted_cholesky`` takes the largest remaining diagonal entry
each time and stops at the numerical rank; ``one_sided_jacobi`` rotates pairs
of columns of that triangular factor until all are orthogonal.  The squared
column norms are the eigenvalues, the normalised columns the components; the
scatter itself is never diagonalised.

Defined results: vectors that are null or hold a null, NaN or infinite entry,
or one whose integer does not fit a long, give no rows; so do vectors whose
length is not the table's most frequent one among these (the longer of equally
frequent ones) and empty vectors.  Rows that repeat a vec_id or have none are
transformed each for itself.  Only components of positive variance exist: a
table of equal vectors gives no rows, nor does an empty one.  ``deviation`` is
null where it exceeds a long.  Components have their largest entry positive;
equal eigenvalues leave their plane's basis to the rotations.  Only vec_id and
embedding are read, so further columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SCALE = 256.0
#: Rows multiplied at once inside a task.
ROWS = 4096
LONG = 1 << 63


class Whitening(NamedTuple):
    """Components as rows, by falling eigenvalue."""
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


# ------------------------------------------------------------------- the algebra

def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, factor): a[order][:, order] = factor @ factor.T with a lower
    triangular factor of as many columns as ``a`` has numerical rank."""
    a, d = a.copy(), len(a)
    order, rank = np.arange(d), 0
    floor = d * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= floor:
            break
        order[[k, p]] = order[[p, k]]
        a[[k, p]] = a[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        a[k, k] = np.sqrt(a[k, k])
        a[k + 1:, k] /= a[k, k]
        a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k + 1:, k])
        rank = k + 1
    return order, np.tril(a)[:, :rank]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times rotations of column pairs, its columns orthogonal.

    A sweep meets every pair once; the disjoint pairs of a round rotate
    together (the columns sit around a table and move one seat a round)."""
    b = factor.copy()
    r = b.shape[1]
    if r < 2:
        return b
    seats = np.arange(r + r % 2)
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            p, q = seats[:len(seats) // 2], seats[:len(seats) // 2 - 1:-1]
            real = (p < r) & (q < r)
            p, q = p[real], q[real]
            x, y = b[:, p], b[:, q]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(alpha * beta)
            turn = np.abs(gamma) > 1e-16 * size
            worst = max(worst, float(np.max(np.abs(gamma) / np.where(size > 0, size, 1), initial=0.0)))
            zeta = (beta - alpha) / (2 * np.where(turn, gamma, 1))
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.hypot(1, t)
            b[:, p], b[:, q] = c * x - c * t * y, c * t * x + c * y
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst < 1e-15:
            break
    return b


def components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (rows) and eigenvalues by falling eigenvalue."""
    order, factor = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(factor)
    rows = np.zeros((turned.shape[1], len(scatter)))
    norms = np.sqrt((turned * turned).sum(0))
    rows[:, order] = (turned / norms).T
    fall = np.argsort(-norms, kind="stable")
    rows, norms = rows[fall], norms[fall]
    largest = rows[np.arange(len(rows)), np.abs(rows).argmax(1)] if len(rows) else np.zeros(0)
    return rows * np.where(largest < 0, -1.0, 1.0)[:, None], norms ** 2


# ---------------------------------------------------------------- the Spark jobs

def quantised(vectors: DataFrame, width: int | None = None) -> DataFrame:
    """(vec_id, x) of the vectors that take part; ``width`` if it is known."""
    scaled = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE))
    fits = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c.cast("double")) * SCALE < float(LONG)))
    rows = vectors.select("vec_id", "embedding").where(F.coalesce(F.size("embedding") > 0, F.lit(False)))
    rows = rows.where(F.coalesce(fits, F.lit(False))).select("vec_id", scaled.cast("array<bigint>").alias("x"))
    if width is None:
        most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        width = most["d"] if most else 0
    return rows.where(F.size("x") == width)


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _fit_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension: the high and low halves apart."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for _, x in _matrices(batches, d):
            n += len(x)
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(d, dtype=np.int32)), "n": pa.array([n] * d, pa.int64()),
                                          "high": pa.array(high), "low": pa.array(low)})

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = (fit.mapInArrow(add, "at int, n bigint, high bigint, low bigint")
            .groupBy("at").agg(F.sum("n").alias("n"), *wide).orderBy("at").collect())
    return (rows[0]["n"] if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _add_up(df: DataFrame, partial, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the matrices that ``partial`` makes, one per task: entries meet
    in Spark as (place, value) rows, only the total comes to the driver."""
    size = shape[0] * shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = partial(batches)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(size, dtype=np.int32)),
                                              "v": pa.array(total.ravel().astype(float))})

    sums = df.mapInArrow(add, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[sums.column("at").to_numpy()] = sums.column("v").to_numpy()
    return out.reshape(shape)


def _centred(x: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return (x.astype(object) - whole).astype(float) if np.abs(x.astype(float)).max(initial=0) >= 2.0 ** 62 else (
        x - whole).astype(float)


def fit(vectors: DataFrame) -> tuple[Whitening, DataFrame] | None:
    """The whitening of ``vectors`` (vec_id, embedding) and its fit list; None
    if no vector takes part."""
    distinct = quantised(vectors).select("x").distinct().checkpoint()
    first = distinct.first()
    if first is None:
        return None
    d = len(first["x"])
    n, sums = _fit_sums(distinct, d)
    whole = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = np.array([s - n * int(w) for s, w in zip(sums, whole)], float)      # sums of x - whole, exact

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for _, x in _matrices(batches, d):
            y = _centred(x, whole)
            total = y.T @ y if total is None else total + y.T @ y
        return total

    scatter = (_add_up(distinct, products, (d, d)) - np.outer(rest, rest) / n) / n
    rows, values = components(scatter)
    return Whitening(n, sums, rows, values, float(np.trace(scatter))), distinct


def _projector(w: Whitening, k: int):
    """Function from integer rows to their whitened coordinates."""
    whole = np.array([(2 * s + w.n) // (2 * w.n) for s in w.sums], np.int64)
    shift = np.array([(s - w.n * int(v)) / w.n for s, v in zip(w.sums, whole)])
    basis, root = w.components[:k], np.sqrt(w.eigenvalues[:k])
    return lambda x: (_centred(x, whole) - shift) @ basis.T / root


def identity_error(w: Whitening, fit_list: DataFrame, k: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance, measured
    over its rows, minus the identity."""
    project, d = _projector(w, k), len(w.sums)

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for _, x in _matrices(batches, d):
            z = project(x)
            total = z.T @ z if total is None else total + z.T @ z
        return total

    return float(np.abs(_add_up(fit_list, products, (k, k)) / w.n - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    most = max(int(np.abs(x.astype(float)).max(initial=0)) * n, *map(abs, sums))
    if 4 * most * most * len(sums) < LONG:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
    return [v if v < LONG else None for v in exact]


def whiten(vectors: DataFrame, w: Whitening, k: int) -> DataFrame:
    """vec_id, deviation, z (``k`` whitened coordinates) of every vector that takes part."""
    project, n, sums, d = _projector(w, k), w.n, w.sums, len(w.sums)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, d):
            z = project(x).ravel()
            at = pa.array(np.arange(0, len(z) + 1, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(_deviations(x, n, sums), pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(z))], ["vec_id", "deviation", "z"])

    return quantised(vectors, d).withColumn("vec_id", F.col("vec_id").cast("bigint")).mapInArrow(
        rows, "vec_id bigint, deviation bigint, z array<double>")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double")
    fitted = fit(vectors)
    if fitted is None or not len(fitted[0].eigenvalues):
        return spark.createDataFrame([], schema)
    w, fit_list = fitted
    k = min(4, len(w.eigenvalues))
    error = identity_error(w, fit_list, k)
    shares = F.array(*[F.lit(float(e / w.trace)) for e in w.eigenvalues[:k]])
    rows = whiten(vectors, w, k).select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(w.n).cast("bigint").alias("n"), "deviation",
                       "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
