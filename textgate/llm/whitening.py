"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

The centred scatter V (d x d) is summed up by Spark. Pivoted Cholesky writes it as L L' with the
largest pivots first and stops at the numerical rank; Jacobi rotations then act on the columns of
the triangular factor L itself until they are orthogonal. V = (L W)(L W)' for any rotation W, so
the squared norms of the rotated columns are V's eigenvalues and the normalised columns its
eigenvectors, each to high relative accuracy: V is never squared, nor turned into a
tridiagonal matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Steps per unit, and the offset, of the integer form of a vector's entries.
STEPS, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows that are multiplied at a time.
BLOCK = 4096
#: Largest integer form of an entry (beyond it, an entry counts as non-finite): sums over 2^22 rows
#: a batch and differences n * x - S are checked against 64 bits on this ground.
LARGEST = 1 << 40


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, pivots): ``v[pivots][:, pivots]`` = L L' for the leading rank columns of L; a pivot below
    d * eps times the first one ends it."""
    d = len(v)
    left, rest = np.zeros((d, d)), np.array(v, float)
    pivots, least = np.arange(d), None
    for k in range(d):
        p = k + int(np.argmax(np.diagonal(rest)[k:]))
        if p != k:
            for m in (rest, rest.T):
                m[[k, p]] = m[[p, k]]
            left[[k, p]], pivots[[k, p]] = left[[p, k]], pivots[[p, k]]
        least = rest[k, k] * d * np.finfo(float).eps if least is None else least
        if rest[k, k] <= least:
            return left[:, :k], pivots
        left[k:, k] = rest[k:, k] / np.sqrt(rest[k, k])
        rest[k + 1:, k + 1:] -= np.outer(left[k + 1:, k], left[k + 1:, k])
    return left, pivots


def jacobi_columns(left: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``left`` times a rotation that makes its columns orthogonal.

    A sweep meets every pair of columns once, in rounds of disjoint pairs (a circle tournament)
    that are rotated together; it ends when no pair's cosine exceeds the rounding level.
    """
    d, r = left.shape
    a = np.array(left, float, order="F")
    if r < 2:
        return a
    ring = np.arange(r + r % 2)  # one more seat, left empty, for an odd number of columns
    tolerance = d * np.finfo(float).eps
    for _ in range(sweeps):
        largest = 0.0
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            i, j = ring[:half], ring[half:][::-1]
            used = (i < r) & (j < r)
            i, j = i[used], j[used]
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (np.einsum("ij,ij->j", p, q) for p, q in ((x, x), (y, y), (x, y)))
            scale = np.sqrt(xx * yy)
            cosine = np.divide(np.abs(xy), scale, out=np.zeros_like(xy), where=scale > 0)
            largest = max(largest, cosine.max())
            turn = cosine > tolerance / 4
            zeta = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            t = np.where(turn, np.copysign(1, zeta) / (np.abs(zeta) + np.hypot(1, zeta)), 0)
            c = 1 / np.hypot(1, t)
            s = c * t
            a[:, i], a[:, j] = c * x - s * y, s * x + c * y
            ring = np.concatenate([ring[:1], np.roll(ring[1:], 1)])
        if largest <= tolerance:
            return a
    return a


def principal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric non-negative matrix, as many
    as its numerical rank. The entry of a vector that is largest in size is positive."""
    left, pivots = pivoted_cholesky(v)
    a = jacobi_columns(left)
    norm = np.sqrt(np.einsum("ij,ij->j", a, a))
    order = np.argsort(-norm, kind="stable")
    a, norm = a[:, order] / norm[order], norm[order]
    vectors = np.empty_like(a)
    vectors[pivots] = a
    top = np.abs(vectors).argmax(0) if vectors.size else np.zeros(0, int)
    return norm ** 2, vectors * np.copysign(1, vectors[top, np.arange(len(norm))])


@dataclass
class Whitening:
    """What a fit of ``n`` vectors learned: exact sums per dimension, eigenvalues (falling), unit
    eigenvectors (columns), trace of the covariance, and the largest entry of the whitened
    vectors' covariance minus the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = float("nan")

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as int64 where that holds it, else as Python integers."""
        wide = self.n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, self.sums), default=0) >= 1 << 62
        if wide:
            return self.n * x.astype(object) - np.array(self.sums, object)
        return self.n * x - np.array(self.sums, np.int64)

    def project(self, deviations: np.ndarray, count: int) -> np.ndarray:
        y = deviations.astype(float) / self.n
        return y @ self.vectors[:, :count] / np.sqrt(self.values[:count])


def _integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length of the vectors: (places, integer forms as a matrix) of the valid ones."""
    places = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    lists = column.drop_null()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    entries = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(STEPS * entries)
        good = np.abs(x) < LARGEST
    for length in np.unique(lengths[lengths > 0]):
        mine = np.flatnonzero(lengths == length)
        at = starts[mine][:, None] + np.arange(length)
        valid = good[at].all(1)
        yield places[mine[valid]], x[at[valid]].astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, integer vectors) of the valid vectors of ``length``, ``BLOCK`` rows at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            for places, x in _integers(part.column(1)):
                if x.shape[1] == length and len(x):
                    yield part.column(0).take(pa.array(places)), x


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(length, dim, n, total) per task: counts and exact sums of the integer vectors."""
    n: dict[int, int] = {}
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            for places, x in _integers(batch.slice(at, BLOCK).column(1)):
                if len(x):
                    d = x.shape[1]
                    n[d] = n.get(d, 0) + len(x)
                    total[d] = total.get(d, 0) + x.sum(0).astype(object)
    for d in n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(d, d)), pa.array(np.arange(d)), pa.array(np.full(d, n[d])),
             pa.array([str(t) for t in total[d]]).cast(pa.decimal128(38, 0))], ["length", "dim", "n", "total"])


def _scatter(fit: Whitening):
    """(row, values) per task: the rows of the sum of (x - S/n)(x - S/n)'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(fit.sums)
        total = np.zeros((d, d))
        for _, x in _blocks(batches, d):
            y = fit.deviations(x).astype(float) / fit.n
            total += y.T @ y
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total))], ["row", "part"])
    return run


def _whitened_scatter(fit: Whitening, count: int):
    """(row, values) per task: sums of w w' of the whitened vectors, and of w as row ``count``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for _, x in _blocks(batches, len(fit.sums)):
            w = fit.project(fit.deviations(x), count)
            total[:count] += w.T @ w
            total[count] += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count + 1, dtype=np.int32)), pa.array(list(total))], ["row", "part"])
    return run


def _summed(parts: DataFrame, rows: int, width: int) -> np.ndarray:
    """The matrix that (row, part) rows add up to. Rows are merged apart, so a task holds one sum
    of ``width`` doubles at a time; only the merged matrix reaches the driver."""
    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += batch.column(batch.schema.get_field_index("part")).flatten().to_numpy().reshape(-1, width).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total])], ["row", "part"])

    out = np.zeros((rows, width))
    for r in parts.groupBy("row").applyInArrow(merge, "row int, part array<double>").collect():
        out[r["row"]] = r["part"]
    return out


def fit_whitening(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  components: int = COMPONENTS) -> dict[int, Whitening]:
    """The fit per length of the vectors (usually one). Vectors that are null, empty, or hold a null,
    a non-finite or an entry of 2^40 / 64 or more do not count; an empty table gives no fit.

    Three passes over the vectors: exact counts and sums; the scatter, centred by them before
    multiplying; the covariance of the whitened vectors, centred too. Each task sends one partial
    matrix, merged by row. The driver works on a d x d matrix: d is the vectors' length, not
    something that grows with the table.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    moments: dict[int, dict[int, tuple[int, int]]] = {}
    for r in rows.mapInArrow(_moments, "length long, dim long, n long, total decimal(38,0)").groupBy("length", "dim") \
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        moments.setdefault(r["length"], {})[r["dim"]] = (r["n"], int(r["total"]))
    fits = {}
    for d, sums in sorted(moments.items()):
        fit = Whitening(sums[0][0], [sums[k][1] for k in range(d)], np.zeros(0), np.zeros((d, 0)), 0.0)
        v = _summed(rows.mapInArrow(_scatter(fit), "row int, part array<double>"), d, d) / fit.n
        v = (v + v.T) / 2
        fit.trace = float(np.trace(v))
        fit.values, fit.vectors = principal(v)
        count = min(components, len(fit.values))
        if count:
            w = _summed(rows.mapInArrow(_whitened_scatter(fit, count), "row int, part array<double>"), count + 1, count) / fit.n
            # the whitened vectors' mean is zero but for rounding, so taking it out afterwards loses no digits
            fit.identity_error = float(np.abs(w[:count] - np.outer(w[count], w[count]) - np.eye(count)).max())
        fits[d] = fit
    return fits


def whiten(vectors: DataFrame, fits: dict[int, Whitening], id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per valid vector and component (1 to ``components``, or the fit's rank if that is less):
    ``id_col``, component, n, deviation, whitened, explained, identity_error.

    deviation, the sum over dimensions of (n * x - S)^2, is exact; null if it does not fit a long.
    Vectors of another length than any fit's are left out, as are invalid ones. Repeated ids and
    vectors stay, a null id too. Other columns are not read. Nothing is shuffled.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, fit in fits.items():
                count = min(components, len(fit.values))
                for ids, x in _blocks(iter([batch]), d) if count else ():
                    off = fit.deviations(x)
                    near = (off.astype(float) ** 2).sum(1)
                    if near.max() < 2.0 ** 62:
                        deviation = pa.array((off * off).sum(1).astype(np.int64))
                    else:
                        exact = [int(s) for s in (off.astype(object) ** 2).sum(1)]
                        deviation = pa.array([s if s < 1 << 63 else None for s in exact], pa.int64())
                    each = pa.array(np.repeat(np.arange(len(x)), count))
                    size = len(x) * count
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                         pa.array(np.full(size, fit.n)), deviation.take(each), pa.array(fit.project(off, count).ravel()),
                         pa.array(np.tile(fit.values[:count] / fit.trace, len(x))), pa.array(np.full(size, fit.identity_error))],
                        ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInArrow(
        run, f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double") \
        .withColumnRenamed("id", id_col)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    vectors = table(spark, sf_dir, "embeddings")
    return whiten(vectors, fit_whitening(vectors))
