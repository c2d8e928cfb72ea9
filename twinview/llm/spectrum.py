"""Whitening of embeddings by slicing the spectrum of their covariance.

The covariance is summed exactly, in whole numbers, so that reruns agree bit for bit however rows are
dealt; what reaches the driver are sums by dimension and pair of dimensions. There the inertia of
LDLᵀ factors of the shifted matrix counts the eigenvalues above a shift: bisection by these counts
isolates the leading eigenvalues one by one, Rayleigh quotient iteration converges in each interval,
and counts on both sides of what it found certify the eigenvalue's number. Rows are then projected
in a map without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.llm.arrow import mapped

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
ROWS = 4096  # worked on at once

_EXACT = 1 << 53  # whole numbers up to here are exact in doubles
_LONG = 1 << 63
_LARGEST = float(1 << 61)
_EPS = np.finfo(float).eps


# The spectrum


def negative_pivots(matrix: np.ndarray) -> int:
    """Eigenvalues below 0 of a symmetric matrix: by Sylvester's law those of D in its LDLᵀ, with pivots
    of one or two rows chosen as Bunch and Kaufman do."""
    a, k, negative = np.array(matrix, float), 0, 0
    growth = (1 + 17**0.5) / 8
    n = len(a)

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        largest = below.max(initial=0.0)
        double = False
        if largest > 0 and abs(a[k, k]) < growth * largest:
            r = k + 1 + int(below.argmax())
            others = np.abs(a[k:, r])
            others[r - k] = 0
            if abs(a[k, k]) * others.max() < growth * largest**2:
                double = abs(a[r, r]) < growth * others.max()
                swap(k + double, r)
        if double:  # such a pivot has one eigenvalue on each side of 0
            rest = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(a[k : k + 2, k : k + 2], rest.T)
            negative, k = negative + 1, k + 2
        else:
            if a[k, k] != 0:
                rest = a[k + 1 :, k]
                a[k + 1 :, k + 1 :] -= np.outer(rest / a[k, k], rest)
            negative, k = negative + int(a[k, k] < 0), k + 1
    return negative


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    return negative_pivots(shift * np.eye(len(matrix)) - matrix)


def _solved(matrix: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    eye = np.eye(len(matrix))
    for nudge in (0.0, 2 * _EPS * scale, 64 * _EPS * scale):
        try:
            found = np.linalg.solve(matrix - (shift + nudge) * eye, right)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            continue
        if np.isfinite(found).all():
            return found
    return right


def _iterated(matrix: np.ndarray, low: float, high: float, before: np.ndarray, scale: float) -> tuple[float, np.ndarray, float]:
    """Rayleigh quotient iteration from the middle of an interval, at right angles to the vectors
    ``before``: eigenvalue, vector and what is left of matrix @ vector - eigenvalue * vector."""
    def unit(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - before.T @ (before @ v)
        return v / np.linalg.norm(v)

    v = unit(np.random.default_rng(len(before)).standard_normal(len(matrix)))
    for _ in range(3):
        v = unit(_solved(matrix, (low + high) / 2, v, scale))
    best = None
    for _ in range(30):
        value = float(v @ matrix @ v)
        left = float(np.linalg.norm(matrix @ v - value * v))
        if best is not None and left >= best[2]:
            break
        best = value, v, left
        v = unit(_solved(matrix, value, v, scale))
    return best


def leading_eigenpairs(matrix: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues of a symmetric matrix, falling, and unit vectors as rows.

    Of equal eigenvalues any vectors at right angles. The largest entry of a vector is positive.
    ArithmeticError if counts contradict what the iteration found.
    """
    n = len(matrix)
    radius = np.abs(matrix).sum(1).max(initial=0.0)
    scale = max(radius, np.finfo(float).tiny)
    tolerance = 16 * n * _EPS * scale
    values, vectors = np.zeros(0), np.zeros((0, n))
    counts = {-radius - tolerance: n, radius + tolerance: 0}  # eigenvalues above each shift tried

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = eigenvalues_above(matrix, shift)
        return counts[shift]

    for i in range(min(count, n)):
        low = max(s for s, c in counts.items() if c > i)
        high = min(s for s, c in counts.items() if c <= i)
        while True:
            alone = above(low) - above(high) == 1
            if alone or high - low <= tolerance:
                value, vector, left = _iterated(matrix, low, high, vectors, scale)
                slack = max(2 * left, tolerance)
                inside = low - slack <= value <= high + slack
                if inside and left <= 1e-10 * scale and above(value - slack) > i and above(value + slack) <= i:
                    break
                if high - low <= tolerance:
                    raise ArithmeticError(f"eigenvalue {i + 1} between {low} and {high} is not certified")
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) > i else (low, middle)
        values = np.append(values, value)
        vectors = np.vstack([vectors, vector * np.sign(vector[np.abs(vector).argmax()])])
    order = np.argsort(-values, kind="stable")  # equal ones may be found in any order
    return values[order], vectors[order]


# Sums over all rows


def _usable(vector: Column) -> Column:
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, entry)


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of floor(SCALE * c) + OFFSET as whole numbers; beyond ±2^61 they stay there."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.clip(np.floor(SCALE * flat) + OFFSET, -_LARGEST, _LARGEST).astype(np.int64)


def _products(rows: np.ndarray) -> np.ndarray:
    """rows.T @ rows exactly: in doubles where no sum can be rounded, else in Python's numbers."""
    largest = int(np.abs(rows).max(initial=0))
    if largest**2 * max(len(rows), 1) <= _EXACT:
        wide = rows.astype(float)
        return (wide.T @ wide).astype(np.int64).astype(object)
    wide = rows.astype(object)
    return wide.T @ wide


def _summed(vectors: DataFrame, dims: int, part, width: int) -> list[int]:
    """Exact sums of ``width`` whole numbers that ``part`` makes of each matrix of rows.

    A task sends ``width`` numbers, added up by Spark; the driver gets ``width`` of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                total = total + part(_matrix(batch.column(0).slice(first, ROWS), dims))
        # in two halves, as sums may be beyond a long
        high, low = [int(x) >> 40 for x in total], [int(x) & ((1 << 40) - 1) for x in total]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(map(str, high)), pa.array(low, pa.int64())], ["at", "high", "low"])

    sums = mapped(vectors, run, "at int, high string, low long").groupBy("at").agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    out = [0] * width
    for row in sums.collect():
        out[row.at] = (int(row.high) << 40) + int(row.low)
    return out


@dataclass
class Whitening:
    """What is fitted: number of vectors, sums, trace, eigenvalues and vectors, and how far the whitened
    vectors' covariance is from the identity."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    error: float

    @property
    def scaled(self) -> np.ndarray:
        """Columns that whiten a centred row; NaN where a component has no variance."""
        flat = ~(self.values > 1e-12 * max(self.trace, np.finfo(float).tiny))
        return self.vectors.T / np.sqrt(np.where(flat, np.nan, self.values))

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(int(s), self.n)) for s in self.sums])


def _centred(rows: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """rows - sums / n, rounded once: the whole part of the mean is taken off exactly."""
    whole = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([float(Fraction(int(s) % n, n)) for s in sums])
    return (rows - whole).astype(float) - rest


def _projected(centred: np.ndarray, scaled: np.ndarray) -> np.ndarray:
    """centred @ scaled, added up in the order of the dimensions: a row gives the same in any batch."""
    out = np.zeros((len(centred), scaled.shape[1]))
    for column, weights in zip(centred.T, scaled):
        out += np.outer(column, weights)
    return out


def covariance(vectors: DataFrame, n: int, dims: int, sums: np.ndarray) -> np.ndarray:
    """Covariance (divisor ``n``) of all rows, each entry rounded once.

    Rows are centred by the whole number below their mean before they are multiplied; the exact rest of
    the centring, less than 1 in each dimension, is then taken off the exact sums.
    """
    whole = np.array([int(s) // n for s in sums], np.int64)
    upper = np.triu_indices(dims)
    total = _summed(vectors, dims, lambda rows: _products(rows - whole)[upper], len(upper[0]))
    rest = [int(s) % n for s in sums]  # n times what is left of the mean
    out = np.zeros((dims, dims))
    for i, j, value in zip(*upper, total):
        out[i, j] = out[j, i] = float(Fraction(value * n - rest[i] * rest[j], n * n))
    return out


def _identity_error(vectors: DataFrame, dims: int, fitted: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over all of them.

    Components without variance don't count. Given to nine digits, so that reruns agree.
    """
    scaled = fitted.scaled
    scaled = scaled[:, np.isfinite(scaled).all(0)]
    k, n, sums = scaled.shape[1], fitted.n, fitted.sums
    if not k:
        return 0.0

    def part(rows: np.ndarray) -> np.ndarray:
        white = _centred(rows, sums, n) @ scaled
        both = np.concatenate([white.sum(0), (white.T @ white).reshape(-1)])
        return np.array([int(round(x * 2**40)) for x in both], object)

    total = _summed(vectors, dims, part, k + k * k)
    mean = np.array([float(Fraction(x, n << 40)) for x in total[:k]])
    squares = np.array([float(Fraction(x, n << 40)) for x in total[k:]]).reshape(k, k)
    return round(float(np.abs(squares - np.outer(mean, mean) - np.eye(k)).max()), 9)


def _of_one_length(rows: DataFrame, vector: str) -> tuple[DataFrame, int, int]:
    """Usable rows of the most common length (of equally common ones the longest), their number and length."""
    usable = rows.where(_usable(F.col(vector)))
    common = usable.groupBy(F.size(vector).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    n, dims = (common["count"], common["dims"]) if common else (0, 0)
    return usable.where(F.size(vector) == dims), n, dims


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Sums, covariance, leading components and their check, over all usable rows; None without any."""
    usable, n, dims = _of_one_length(rows, vector)
    if not n:
        return None
    vectors = usable.select(F.col(vector).cast("array<double>").alias("c"))
    sums = np.array(_summed(vectors, dims, lambda x: x.astype(object).sum(0), dims), object)
    matrix = covariance(vectors, n, dims, sums)
    values, found = leading_eigenpairs(matrix, components)
    fitted = Whitening(n, sums, float(np.trace(matrix)), values, found, 0.0)
    fitted.error = _identity_error(vectors, dims, fitted)
    return fitted


def _deviations(rows: np.ndarray, sums: np.ndarray, n: int) -> pa.Array:
    """Sum over the dimensions of (n * x - sum)^2, exactly; null beyond a long."""
    reach = n * int(np.abs(rows).max(initial=0)) + max(abs(int(s)) for s in sums)
    if reach < 1 << 62:
        apart = n * rows - sums.astype(np.int64)
        if int(np.abs(apart).max(initial=0)) ** 2 * rows.shape[1] < _LONG:
            return pa.array((apart * apart).sum(1))
    exact = ((n * rows.astype(object) - sums) ** 2).sum(1)
    return pa.array([x if x < _LONG else None for x in exact], pa.int64())


_OUT = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Each usable row once for each of the first ``components`` components, without its vector.

    component: its number from 1, by falling variance; n: vectors fitted on; deviation: sum over the
    dimensions of (n * x - sum of x)^2, x the whole number an entry becomes; whitened: x centred,
    projected on the component, over the root of its variance; explained: its part of the whole
    variance; identity_error: see ``Whitening``.

    Vectors that are null, empty, or hold a null or non-finite entry are left out, and so are those of
    another length than the most common one. Repeated rows are vectors of their own. Where a
    component has no variance (equal vectors, fewer vectors than components) whitened is null and explained
    0 or next to it. A deviation too large for a long is null. Entries beyond 2^51 count as if they
    were there. Other columns stay, but for those named like an output. No usable rows give none.
    """
    fitted = fit(rows, vector, components)
    added = [T.StructField(c, t) for c, t in _OUT]
    kept = [f for f in rows.schema.fields if f.name not in {vector, *(c for c, _ in _OUT)}]
    schema = T.StructType([*kept, *added])
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema)
    dims, k = len(fitted.sums), len(fitted.values)
    scaled, error = fitted.scaled, fitted.error
    explained = np.maximum(fitted.values, 0) / fitted.trace if fitted.trace > 0 else np.zeros(k)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                x = _matrix(part.column(vector), dims)
                white = _projected(_centred(x, fitted.sums, fitted.n), scaled).reshape(-1)
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(each) for c in names),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, fitted.n)),
                     _deviations(x, fitted.sums, fitted.n).take(each), pa.array(white, mask=np.isnan(white)),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                    schema.names)

    usable = rows.where(_usable(F.col(vector)) & (F.size(vector) == dims))
    return mapped(usable.select(*names, F.col(vector).cast("array<double>").alias(vector)), run, schema)


def op13_spectrum_slicing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened to eight components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
