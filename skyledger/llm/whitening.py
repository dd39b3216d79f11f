"""Whitening of embeddings; leading eigenpairs of their covariance by spectrum slicing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import written

#: Components with less variance than this part of the largest one are rounding, not spread.
RANK = 1e-13
#: Pivots of 2 by 2 keep growth below this bound (Bunch and Parlett).
ALPHA = (1 + 17**0.5) / 8
#: Sums of products below this are whole numbers in a double.
EXACT = float(1 << 52)


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """How many eigenvalues of a symmetric matrix are positive, zero and negative.

    LDLᵀ with symmetric pivoting by the largest entry, in blocks of one or two: by
    Sylvester's law D has the inertia of the matrix. A block of two has one eigenvalue
    of each sign.
    """
    a = np.array(matrix, dtype=float)
    positive = zero = negative = 0
    while n := len(a):
        at = int(np.argmax(np.abs(np.diagonal(a))))
        one = abs(a[at, at])
        rest = np.abs(a - np.diag(np.diagonal(a)))
        two = rest.max()
        if one == 0 and two == 0:
            return positive, zero + n, negative
        if one >= ALPHA * two:
            keep = np.delete(np.arange(n), at)
            positive, negative = positive + (a[at, at] > 0), negative + (a[at, at] < 0)
            column = a[keep, at]
            a = a[np.ix_(keep, keep)] - np.outer(column, column / a[at, at])
        else:
            pair = list(np.unravel_index(int(rest.argmax()), rest.shape))
            keep = np.delete(np.arange(n), pair)
            positive, negative = positive + 1, negative + 1
            columns = a[np.ix_(keep, pair)]
            a = a[np.ix_(keep, keep)] - columns @ np.linalg.solve(a[np.ix_(pair, pair)], columns.T)
        a = (a + a.T) / 2
    return positive, zero, negative


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``."""
    return inertia(matrix - shift * np.eye(len(matrix)))[0]


def _against(vector: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The unit vector without its parts along the orthonormal rows ``found``, taken out twice."""
    for _ in range(2):
        vector = vector - found.T @ (found @ vector)
    return vector / np.linalg.norm(vector)


def _rayleigh(matrix: np.ndarray, low: float, high: float, found: np.ndarray, seed: int) -> tuple[float, np.ndarray, bool]:
    """Rayleigh quotient iteration from inside a bracket: value, vector and whether it ended in the bracket."""
    eye, scale = np.eye(len(matrix)), np.abs(matrix).max() * len(matrix)
    vector = _against(np.random.default_rng(seed).standard_normal(len(matrix)), found)
    value, best = (low + high) / 2, (np.inf, 0.0, vector)
    for step in range(40):
        try:
            solved = np.linalg.solve(matrix - value * eye, vector)
        except np.linalg.LinAlgError:  # the shift is the eigenvalue itself
            solved = np.linalg.solve(matrix - (value + scale * 1e-15) * eye, vector)
        vector = _against(solved / np.linalg.norm(solved), found)
        quotient = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - quotient * vector))
        if residual < best[0]:
            best = (residual, quotient, vector)
        elif step > 3:
            break
        if step >= 1:  # the first two solves keep the middle as shift and turn the start towards the bracket
            value = min(max(quotient, low), high)
    residual, quotient, vector = best
    slack = scale * 1e-14
    return quotient, vector, residual <= scale * 1e-13 and low - slack <= quotient <= high + slack


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``count`` eigenvalues of a covariance, falling, and unit eigenvectors as rows.

    Inertia counts of shifted matrices halve a bracket until it holds only the k-th
    eigenvalue, or is as narrow as rounding lets it be (equal eigenvalues, whose vectors
    are any orthonormal ones of their space). Rayleigh quotient iteration starts in the
    middle of it, converges cubically, and must end inside; if it leaves, the bracket is
    halved on. At the end counts on both sides of each value certify its number.
    Values below RANK of the largest are left out.
    """
    size = len(matrix)
    radius = np.abs(matrix).sum(1).max() if size else 0.0
    values: list[float] = []
    vectors = np.zeros((0, size))
    if not radius > 0:
        return np.array(values), vectors
    narrow = radius * 4e-15
    counts: dict[float, int] = {-radius * 1.01: size, radius * 1.01: 0}

    def count_above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(matrix, shift)
        return counts[shift]

    for k in range(1, min(count, size) + 1):
        low = max(s for s, n in counts.items() if n >= k)
        high = min(s for s, n in counts.items() if n < k and s > low)
        while True:
            while high - low > narrow and (count_above(low) != k or count_above(high) != k - 1 or high - low > radius * 1e-2):
                middle = (low + high) / 2
                low, high = (middle, high) if count_above(middle) >= k else (low, middle)
            value, vector, inside = _rayleigh(matrix, low, high, vectors, k)
            if inside or high - low <= narrow:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if count_above(middle) >= k else (low, middle)
        if value <= RANK * (values[0] if values else value) or value <= 0:
            break
        slack = radius * 1e-13
        if above(matrix, value + slack) >= k or above(matrix, value - slack) < k:
            raise ArithmeticError(f"inertia counts do not certify {value} as eigenvalue {k}")
        values.append(value)
        vectors = np.vstack([vectors, vector])
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], vectors[order]


@dataclass
class Spread:
    """What the fit list tells: its size, exact sums per dimension, and the covariance."""

    n: int
    sums: list[int]
    covariance: np.ndarray


def valid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is whole: not null or empty, without null and non-finite entries.

    All vectors have one length; where lengths differ, the one that most rows have
    (the longer of equally frequent ones) is the table's, and other rows are left out.
    """
    entry = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = vectors.where(F.col(column).isNotNull() & ~F.exists(column, entry) & (F.size(column) > 0))
    lengths = whole.groupBy(F.size(column).alias("length")).agg(F.count("*").alias("n"))
    most = lengths.agg(F.max(F.struct("n", "length"))["length"]).first()[0]
    return whole.where(F.size(column) == F.lit(most or 0))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """floor(64 * c) of every entry, a row per vector, as 64-bit integers."""
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(64.0 * flat)
    if len(scaled) and np.abs(scaled).max() >= EXACT:
        raise OverflowError("an entry is too large for exact whole numbers")
    return scaled.astype(np.int64).reshape(len(lists), -1)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """leftᵀ right in exact 64-bit integers, by floating point where sums stay whole."""
    reach = float(np.abs(left).max()) * float(np.abs(right).max()) * len(left)
    if reach < EXACT:
        return (left.astype(np.float64).T @ right.astype(np.float64)).astype(np.int64)
    if reach >= 2.0**63:
        raise OverflowError("sums of products exceed 64 bits")
    return left.T @ right


def _summed(vectors: DataFrame, column: str, sums) -> dict[tuple[int, int], float]:
    """Sum over all rows of ``sums(matrix)``, one matrix a batch; one row per entry and task is shuffled."""
    kind = "i int, j int, v decimal(38,0)"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = sums(_matrix(batch, column)).astype(object)  # Python's whole numbers do not overflow
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            flat = pa.array([int(v) for v in total.ravel()], pa.decimal128(38, 0))
            yield pa.record_batch([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), flat], ["i", "j", "v"])

    rows = vectors.select(column).mapInArrow(run, kind).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    return {(r["i"], r["j"]): int(r["v"]) for r in rows}


def spread(vectors: DataFrame, column: str = "embedding") -> Spread:
    """Size, sums and covariance (divisor n) of whole vectors as x = floor(64 * c) + 1000000.

    Two passes. The first has whole sums, the second products of what is left after the
    whole number next to the mean is taken off; both are exact, so that order and
    partitions change nothing. The remainder of the mean, below one half, is taken out
    of the products in whole numbers, and the only rounding is the last division. The
    driver gets one number per pair of dimensions.
    """
    sums = _summed(vectors, column, lambda m: np.vstack([m.sum(0), np.full(m.shape[1], len(m))]))
    size = len(sums) // 2
    if not size:
        return Spread(0, [], np.zeros((0, 0)))
    n = sums[1, 0]
    totals = [sums[0, i] for i in range(size)]
    centre = np.array([(2 * t + n) // (2 * n) for t in totals], dtype=np.int64)
    products = _summed(vectors, column, lambda m: _products(m - centre, m - centre))
    rest = [t - n * int(c) for t, c in zip(totals, centre)]
    covariance = np.array([[(n * products[i, j] - rest[i] * rest[j]) / (n * n) for j in range(size)] for i in range(size)])
    return Spread(n, [t + 1_000_000 * n for t in totals], covariance)


def _projection(fit: Spread, values: np.ndarray, vectors: np.ndarray):
    """A function from floor(64 * c) to whitened components."""
    means = np.array([(s - 1_000_000 * fit.n) / fit.n for s in fit.sums])
    axes = (vectors / np.sqrt(values)[:, None]).T
    return lambda matrix: (matrix - means) @ axes


def whitened(vectors: DataFrame, components: int = 32, column: str = "embedding", carry: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """row, component, n, deviation, whitened, explained, eigenvalue and identity_error of each whole vector and component.

    Rows with a null or empty vector, or null or non-finite entries, are dropped, and
    rows of another length than the table's (``valid``). The columns ``carry`` travel in
    struct ``row``; they may be null and repeat, and a repeated row is a row of its own.
    Components without variance have no rows: of equal vectors, or of one vector alone,
    nothing is returned. Equal eigenvalues have any orthonormal vectors of their space;
    which ones is the same for all rows and runs. A deviation beyond 64 bits raises.

    ``identity_error`` is measured on the result: a pass over the whitened rows sums
    their products, less the product of their means. Only matrices of dimensions by
    dimensions go through the driver, at any number of rows.
    """
    rows = written(valid(vectors, column).select(F.struct(*carry).alias("row"), column), "vectors")
    fit = spread(rows, column)
    values, axes = leading(fit.covariance, components)
    found = len(values)
    kind = "row struct<{}>, component int, n long, deviation long, whitened double, explained double, eigenvalue double, identity_error double"
    kind = kind.format(",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in rows.schema["row"].dataType))
    if not found:
        return rows.sparkSession.createDataFrame([], kind)
    project = _projection(fit, values, axes)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((found + 1, found))
        for batch in batches:
            if batch.num_rows:
                white = project(_matrix(batch, column))
                total += np.vstack([white.T @ white, white.sum(0)])
        i, j = np.indices(total.shape)
        yield pa.record_batch([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    sums = np.zeros((found + 1, found))
    for i, j, v in rows.select(column).mapInArrow(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        sums[i, j] = v / fit.n
    error = float(np.abs(sums[:-1] - np.outer(sums[-1], sums[-1]) - np.eye(found)).max())
    explained = values / float(np.trace(fit.covariance))
    remainder = np.array([s - 1_000_000 * fit.n for s in fit.sums], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, (1 << 16) // found)
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                matrix = _matrix(part, column)
                white = project(matrix)
                reach = fit.n * float(np.abs(matrix).max()) + float(np.abs(remainder).max())
                if reach * reach * matrix.shape[1] < 2.0**63:
                    gaps = fit.n * matrix - remainder.astype(np.int64)
                    deviation = (gaps * gaps).sum(1)
                else:  # whole numbers of any size; a result beyond 64 bits does not fit its column
                    gaps = fit.n * matrix.astype(object) - remainder
                    deviation = np.array([int(v) for v in (gaps * gaps).sum(1)], dtype=np.int64)
                at = pa.array(np.repeat(np.arange(part.num_rows), found))
                every = len(at)
                yield pa.record_batch(
                    [
                        part.column("row").take(at),
                        pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), part.num_rows)),
                        pa.array(np.full(every, fit.n, dtype=np.int64)),
                        pa.array(np.repeat(deviation, found)),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, part.num_rows)),
                        pa.array(np.tile(values, part.num_rows)),
                        pa.array(np.full(every, error)),
                    ],
                    ["row", "component", "n", "deviation", "whitened", "explained", "eigenvalue", "identity_error"],
                )

    return rows.mapInArrow(run, kind)
