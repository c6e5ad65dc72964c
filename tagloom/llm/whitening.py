"""Whitening of embeddings on their leading components, found by spectrum slicing.

Spark sums the vectors, then the products of centred vectors, each partition giving one partial sum; what the driver gets has
the size of the covariance matrix, the square of the dimension, whatever the number of rows. The eigenvalues are isolated
there one by one: the LDLᵀ factors of ``V - shift`` have as many positive pivots as ``V`` has eigenvalues above the shift
(Sylvester), so bisection on that count finds an interval that holds the k-th eigenvalue alone. Rayleigh quotient
iteration from inside it converges cubically, and two more counts beside the result certify its number.

Entries become whole numbers (``floor(256 * c)``) first, so sums and deviations are exact; the fit counts each distinct vector
once, found by grouping on the vector itself.

Defined cases: rows whose vector is null or holds a null, NaN or infinite entry go; of vectors of different lengths those of
the commonest length stay (of equally common ones the longest). A null id stays null, rows that repeat an id each give their
rows. Components of zero variance, beyond rounding, are not returned, so a table of one distinct vector, or of empty
vectors, gives no rows, and so does an empty table. Equal eigenvalues keep the order they are found in, with orthogonal
vectors. A deviation beyond the range of a long is an error. Columns beyond the two named ones are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import stored

SCALE = 256
COMPONENTS = 4
_EPS = np.finfo(float).eps
_SUM = "part int, pos int, n long, total decimal(38,0)"
_PRODUCTS = "part int, pos int, total array<double>"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- the leading eigenvalues of one symmetric matrix ---------------------------


def count_above(matrix: np.ndarray, shift: float) -> int:
    """The number of eigenvalues above ``shift``: positive pivots of ``matrix - shift`` in LDLᵀ with 1×1 and 2×2 pivots."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0
    alpha = (1 + 17**0.5) / 8  # Bunch and Kaufman's bound on the growth of entries

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        wide = 1
        if len(below) and below.max() > 0:
            r, largest = k + 1 + int(below.argmax()), below.max()
            if abs(a[k, k]) < alpha * largest:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                if abs(a[k, k]) * row.max() < alpha * largest * largest:
                    if abs(a[r, r]) >= alpha * row.max():
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        wide = 2
        rest = a[k + wide :, k : k + wide]
        if wide == 1:
            positive += bool(a[k, k] > 0)
            if rest.any():
                a[k + 1 :, k + 1 :] -= np.outer(rest / a[k, k], rest)
        else:
            pivot = a[k : k + 2, k : k + 2]
            det = pivot[0, 0] * pivot[1, 1] - pivot[0, 1] * pivot[1, 0]
            positive += 1 if det < 0 else 2 * bool(pivot[0, 0] > 0)
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(pivot, rest.T)
        k += wide
    return positive


def _bracket(matrix: np.ndarray, number: int, low: float, high: float, fine: float) -> tuple[float, float]:
    """``low, high`` with at least ``number`` eigenvalues above ``low`` and fewer above ``high``.

    The interval holds one eigenvalue and is narrow beside its distance from zero, or it is as narrow as ``fine``.
    """
    above_low, above_high = len(matrix), 0
    while high - low > fine and not (above_low - above_high == 1 and high - low < 0.01 * max(abs(low), abs(high))):
        middle = (low + high) / 2
        count = count_above(matrix, middle)
        if count >= number:
            low, above_low = middle, count
        else:
            high, above_high = middle, count
    return low, high


def _shifted_solve(matrix: np.ndarray, shift: float, right: np.ndarray, fine: float) -> np.ndarray:
    """A unit vector along ``(matrix - shift)⁻¹ right``; a shift that is an eigenvalue is moved by rounding."""
    for step in (0.0, 1.0, 4.0, 16.0):
        try:
            out = np.linalg.solve(matrix - (shift + step * fine) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        norm = np.linalg.norm(out)
        if np.isfinite(norm) and norm > 0:
            return out / norm
    return right


def _eigenpair(matrix: np.ndarray, number: int, known: np.ndarray, bounds: tuple[float, float]) -> tuple[float, np.ndarray]:
    """The eigenvalue of this number, from 1 by falling value, with its unit vector, orthogonal to the rows of ``known``."""
    size = len(matrix)
    norm = max(abs(bounds[0]), abs(bounds[1]))
    fine = 4 * size * _EPS * norm

    def clean(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - known.T @ (known @ v)
        length = np.linalg.norm(v)
        return v / length if length > 0 else v

    low, high = _bracket(matrix, number, *bounds, fine)
    start = clean(np.cos(1.0 + np.arange(size) * 2.399963))  # a vector without the symmetries that data have
    while True:
        v = start
        for _ in range(3):  # inverse iteration, to be near enough for cubic convergence
            v = clean(_shifted_solve(matrix, (low + high) / 2, v, fine))
        value = v @ matrix @ v
        last = np.linalg.norm(matrix @ v - value * v)
        for _ in range(20):  # Rayleigh quotient iteration, until rounding stops it
            near = clean(_shifted_solve(matrix, value, v, fine))
            quotient = near @ matrix @ near
            error = np.linalg.norm(matrix @ near - quotient * near)
            if error >= last:
                break
            value, v, last = quotient, near, error
        slack = fine + 2 * last
        certified = count_above(matrix, value + slack) < number <= count_above(matrix, value - slack)
        if certified and (low - slack <= value <= high + slack) or high - low <= fine:
            return float(value), v
        low, high = _bracket(matrix, number, low, high, max(fine, (high - low) / 16))  # it ran to a neighbour: look closer


def leading_components(matrix: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit vectors as rows; zero ones are left out."""
    size = len(matrix)
    values, vectors = [], np.empty((0, size))
    trace = float(np.trace(matrix))
    if not trace > 0:
        return np.array(values), vectors
    matrix = matrix / trace
    zero = 16 * size * _EPS
    high = np.abs(matrix).sum(axis=1).max()  # the discs of Gershgorin; a covariance has no eigenvalue below zero
    for number in range(1, min(count, size) + 1):
        if count_above(matrix, zero) < number:
            break
        value, vector = _eigenpair(matrix, number, vectors, (zero / 2, high * (1 + zero)))
        vector = vector * np.sign(vector[np.abs(vector).argmax()])
        values.append(value * trace)
        vectors = np.vstack([vectors, vector])
    return np.array(values), vectors


# ---- sums over the vectors --------------------------------------------------------


def scaled_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows with whole vectors; ``x`` has ``floor(256 * c)`` for each entry ``c``."""
    entries = F.col(vector_col).cast("array<double>")
    whole = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    x = F.transform(entries, lambda c: F.floor(c * SCALE).cast("long"))
    return vectors.where(whole).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _total(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)  # neither half overflows in a batch
            total = [t + (int(a) << 32) + int(b) for t, a, b in zip(total, high, low)]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                 pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["part", "pos", "n", "total"],
            )

    sums = fit.mapInArrow(run, _SUM).groupBy("pos").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
    found = sorted((r.pos, r.n, int(r.total)) for r in sums.collect())  # one row a dimension
    return (found[0][1] if found else 0), [t for _, _, t in found]


@dataclass
class Centre:
    """The mean as a whole number and a rest, so that large entries lose no digits."""

    n: int
    total: list[int]

    def __post_init__(self) -> None:
        self.whole = np.array([(2 * t + self.n) // (2 * self.n) for t in self.total], np.int64)
        self.left = [t - int(w) * self.n for t, w in zip(self.total, self.whole)]
        self.rest = np.array([x / self.n for x in self.left])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over the dimensions of ``(n * x - S)²``, exactly."""
        near = x - self.whole
        reach = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if reach * reach * max(1, x.shape[1]) < 1 << 63:
            return ((near * self.n - np.array(self.left, np.int64)) ** 2).sum(axis=1)
        exact = [sum((self.n * int(a) - b) ** 2 for a, b in zip(row, self.left)) for row in near]
        if max(exact) >= 1 << 63:
            raise ValueError("a deviation is beyond the range of a long")
        return np.array(exact, np.int64)


def _products(fit: DataFrame, size: int, of) -> np.ndarray:
    """Sum over the fit list of the products of all pairs of columns of ``of(x)``, which has any fixed number of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            y = of(_matrix(batch.column("x"), size))
            total = total + y.T @ y
        if isinstance(total, np.ndarray):
            part = TaskContext.get().partitionId()
            lists = pa.array(list(total), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()), lists], ["part", "pos", "total"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # one row a partition; in this order the sum is the same each time
        return pa.table({"pos": table["pos"].slice(0, 1), "total": pa.array([np.sum(table["total"].to_pylist(), axis=0)], pa.list_(pa.float64()))})

    sums = fit.mapInArrow(run, _PRODUCTS).groupBy("pos").applyInArrow(add, "pos int, total array<double>")
    return np.array([r.total for r in sorted(sums.collect(), key=lambda r: r.pos)])


@dataclass
class Whitening:
    """What makes vectors white: the centre, components as rows, their variances, and figures of the fit."""

    centre: Centre
    vectors: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors.T / np.sqrt(self.variances)


def fit_whitening(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit to the distinct ``x`` of ``rows``, all of one size; None if they have no variance."""
    fit = stored(rows.select("x").distinct(), "vectors")
    n, total = _total(fit, size)
    if not n:
        return None
    centre = Centre(n, total)
    covariance = _products(fit, size, centre.centred) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_components(covariance, components)
    if not len(values):
        return None
    found = Whitening(centre, vectors, values, values / np.trace(covariance))
    found.identity_error = float(np.abs(_products(fit, size, found.apply) / n - np.eye(len(values))).max())
    return found


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each row with a whole vector and each component; see the module's text for the columns' meaning."""
    spark = vectors.sparkSession
    rows = scaled_rows(vectors, id_col, vector_col)
    lengths = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = lengths["size"] if lengths else 0
    rows = rows.where(F.size("x") == size)
    found = fit_whitening(rows, size, components) if size else None
    if found is None:
        return spark.createDataFrame([], RESULT)
    k = len(found.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            m = len(x)
            columns = {
                "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                "n": pa.array(np.full(m * k, found.centre.n, np.int64)),
                "deviation": pa.array(np.repeat(found.centre.deviations(x), k)),
                "whitened": pa.array(found.apply(x).ravel()),
                "explained": pa.array(np.tile(found.explained, m)),
                "identity_error": pa.array(np.full(m * k, found.identity_error)),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, RESULT)
