"""op11: whitening of embeddings by the covariance that variances of sums give.

cov(a, b) = (var(a + b) - var(a) - var(b)) / 2, so the only thing that is gathered from the vectors is, for each dimension and
each sum of two dimensions, the total of its squared centred values: dimensions squared / 2 whole numbers a partition, whatever
the rows. All of it is exact. With S the sums and n the distinct vectors, n*x - S is n*e - r for e = x - p, p the whole number
next to the mean and r = S - n*p, so the total of (n*x - S)^2 is n^2 * total(e^2) - n * r^2: small numbers are squared in tasks,
large ones are put together on the driver as Python integers, and only the finished covariances become doubles, for eigh.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, tidy
from .vectors import by_length, matrix, scaled, wide

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
SCHEMA = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def _sums(length: int):
    """at, n, total: of each dimension, over the vectors of a partition."""

    def run(batches):
        total, n = np.zeros(length, object), 0
        for batch in batches:
            total += matrix(batch.column("x"), length).sum(0).astype(object)
            n += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()), wide(total)], ["at", "n", "total"])

    return tidy(run)


def _squares(pivot: np.ndarray):
    """a, b, total: the squared centred values of dimension a (where b is a) or of the sum of dimensions a and b, over the vectors of a partition."""
    length = len(pivot)

    def run(batches):
        total = np.zeros((length, length), object)
        for batch in batches:
            e = matrix(batch.column("x"), length) - pivot
            if 4 * int(np.abs(e).max(initial=0)) ** 2 * len(e) >= 1 << 63:
                e = e.astype(object)
            for a in range(length):
                both = e[:, a + 1 :] + e[:, a, None]
                total[a, a] += int((e[:, a] * e[:, a]).sum())
                total[a, a + 1 :] += (both * both).sum(0).astype(object)
        a, b = np.triu_indices(length)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), wide(total[a, b])], ["a", "b", "total"])

    return tidy(run)


def covariances(fit: DataFrame, length: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S, and n^3 times the covariances of the vectors x of fit, all exact."""
    sums = fit.select("x").mapInArrow(_sums(length), "at int, n long, total decimal(38,0)").groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    n, total = sums[0]["n"], [0] * length
    for r in sums:
        total[r["at"]] = int(r["total"])
    pivot = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * p for s, p in zip(total, pivot, strict=True)]
    squares = fit.select("x").mapInArrow(_squares(np.array(pivot, np.int64)), "a int, b int, total decimal(38,0)").groupBy("a", "b").agg(F.sum("total").alias("total"))
    variance = [[0] * length for _ in range(length)]  # n^3 times those of the dimensions and of their sums
    for a, b, t in squares.collect():
        variance[a][b] = n * n * int(t) - n * (rest[a] if a == b else rest[a] + rest[b]) ** 2
    cross = [[0] * length for _ in range(length)]
    for a in range(length):
        cross[a][a] = variance[a][a]
        for b in range(a + 1, length):
            cross[a][b] = cross[b][a] = (variance[a][b] - variance[a][a] - variance[b][b]) // 2
    return n, total, cross


def _rounded(top: int, bottom: int) -> np.longdouble:
    """top / bottom as two doubles' sum: more digits than one holds, where the machine has them."""
    exact = Fraction(top, bottom)
    high = float(exact)
    return np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))


def principal_axes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of v, falling, and unit eigenvectors as columns; small ones keep their digits beside large ones.

    eigh is right to a share of the largest eigenvalue. So what it finds within a ten-thousandth of that is kept, and the rest is
    v on the remaining axes, multiplied out with more digits, for eigh again.
    """
    q, low = np.eye(len(v), dtype=np.longdouble), 0
    while low < len(v):
        values, turn = np.linalg.eigh((q[:, low:].T @ v @ q[:, low:]).astype(float))
        q[:, low:] = q[:, low:] @ turn[:, ::-1]
        again, turn = np.linalg.eigh((q[:, low:].T @ v @ q[:, low:]).astype(float))
        q[:, low:] = q[:, low:] @ turn[:, ::-1]
        low += max(1, int((again > again[-1] * 1e-4).sum()))
    values = np.einsum("ij,ik,kj->j", q, v, q)
    order = np.argsort(-values, kind="stable")
    q = q[:, order] / np.sqrt((q[:, order] ** 2).sum(0))
    return values[order].astype(float), q.astype(float)


def _project(pivot: np.ndarray, rest: np.ndarray, axes: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (x - pivot - rest) @ axes


def _moments(pivot: np.ndarray, rest: np.ndarray, axes: np.ndarray):
    """a, b, total: sums (b = -1) and products of the whitened values of a partition."""
    k = axes.shape[1]

    def run(batches):
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _project(pivot, rest, axes, matrix(batch.column("x"), len(pivot)))
            sums += w.sum(0)
            products += w.T @ w
        a, b = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array([*range(k), *a], pa.int32()), pa.array([*[-1] * k, *b], pa.int32()), pa.array([*sums, *products[a, b]])], ["a", "b", "total"])

    return tidy(run)


def _whiten(n: int, pivot: np.ndarray, whole: list[int], axes: np.ndarray, explained: np.ndarray, error: float):
    """A row for each vector and component."""
    length, k = axes.shape
    rest = np.array([r / n for r in whole])
    largest = max(map(abs, whole))

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x"), length)
            e = x - pivot
            fits = length * (n * int(np.abs(e).max(initial=0)) + largest) ** 2 < 1 << 63
            d = n * e - np.array(whole, np.int64) if fits else n * e.astype(object) - np.array(whole, object)
            again = np.repeat(np.arange(len(x)), k)
            size = len(again)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(again)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, n)),
                    wide((d * d).sum(1)).take(pa.array(again)),
                    pa.array(_project(pivot, rest, axes, x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(size, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return tidy(run)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """SCHEMA: of each row of vectors (vec_id, embedding) and each of the first components, its whitened value.

    Vectors that are null or hold null or non-finite entries give no rows. The fit takes each distinct vector once, the result
    every row, repeated rows and rows without an id too. Components of no variance (eigenvalues of zero, to the machine's precision)
    are left out, so one vector, or copies of one, give no rows, and nor do empty vectors. Vectors of different lengths are
    whitened apart, each length by its own fit. A deviation of more than 38 digits is an error.
    """

    def run(rows: DataFrame, length: int) -> DataFrame:
        empty = rows.sparkSession.createDataFrame([], SCHEMA)
        if not length:
            return empty
        fit = materialise(rows.select("x").distinct(), "distinct")
        n, total, cross = covariances(fit, length)
        values, axes = principal_axes(np.array([[_rounded(c, n**3) for c in row] for row in cross], np.longdouble))
        k = min(components, int((values > values[0] * 8 * length * np.finfo(np.longdouble).eps).sum()))
        if not k:
            return empty
        spread = sum(cross[a][a] for a in range(length)) / n**3
        pivot = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
        whole = [s - n * int(p) for s, p in zip(total, pivot, strict=True)]
        rest = np.array([r / n for r in whole])
        axes = axes[:, :k] / np.sqrt(values[:k])
        found = {(r["a"], r["b"]): r["total"] / n for r in fit.mapInArrow(_moments(pivot, rest, axes), "a int, b int, total double").groupBy("a", "b").agg(F.sum("total").alias("total")).collect()}
        error = max(abs(found[a, b] - found[a, -1] * found[b, -1] - (a == b)) for a in range(k) for b in range(a, k))
        return rows.select("vec_id", "x").mapInArrow(_whiten(n, pivot, whole, axes, values[:k] / spread, error), SCHEMA)

    return by_length(scaled(vectors, SCALE, SHIFT), SCHEMA, run)
