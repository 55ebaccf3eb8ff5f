"""Whitening of vectors by the leading eigenvectors of their covariance.

Entries become integers x = floor(scale * c) + shift (a product beyond 2^62 keeps to that end), so that equal vectors are equal exactly, and the sums of the fit
list (each different vector once) are exact. Its covariance is summed by tasks, centred first, and added up by a tree.

The covariance is a matrix of the vectors' dimension, whatever the number of rows. Its leading eigenvalues are found on
the driver by spectrum slicing: the LDL' factors of the matrix shifted by s have as many positive pivots as there are
eigenvalues above s (Sylvester's law of inertia). Such counts halve an interval until it holds one eigenvalue. From there
Rayleigh quotient iteration converges cubically, and two more counts, just below and just above, certify that the value found
has the number it should have. Eigenvalues that no shift can part, being equal to double precision, get an orthonormal basis
of their space.

Dropped are null vectors and those with null, NaN or infinite entries, and as no covariance joins vectors of different
lengths, also those that are empty or do not have the most frequent length (of equally frequent ones, the greatest).
Components whose eigenvalue is zero but for rounding (``ZERO`` of the norm) are left out, as nothing can be divided by it: fewer than asked for
where the fit list has a lower rank, none where it has one vector. Repeated rows and ids have a result each. An empty table
gives no rows. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import map_batches
from parley.llm.vectors import tree_sum
from parley.session import materialize

# Fixed values of the integer entries.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
BATCH_BYTES = 4 << 20
SEGMENT = 1 << 15
EXACT = 1 << 62
BITS = 22
LOW = (1 << BITS) - 1
# an eigenvalue below this share of the matrix's norm counts as zero
ZERO = 1e-10


def negative_pivots(matrix: np.ndarray) -> tuple[int, bool]:
    """(how many eigenvalues of a symmetric matrix are below zero, whether a pivot vanished), from LDL' factors.

    D has blocks of one or two rows, chosen as Bunch and Kaufman do, so that no factor grows without bound.
    """
    a = matrix.copy()
    n, k, below, vanished = len(a), 0, 0, False
    tiny = np.finfo(float).eps * max(float(np.abs(a).max(initial=0.0)), np.finfo(float).tiny)
    alpha = (1 + 17**0.5) / 8
    while k < n:
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        most = column.max(initial=0.0)
        pair = False
        if max(abs(a[k, k]), most) <= tiny:
            # nothing is left of this row: an eigenvalue of zero
            vanished = True
            k += 1
            continue
        if abs(a[k, k]) < alpha * most:
            row = np.abs(np.concatenate([a[r, k:r], a[r + 1 :, r]])).max()
            if abs(a[k, k]) * row < alpha * most * most:
                pair = abs(a[r, r]) < alpha * row
                at = k + 1 if pair else k
                a[[at, r]] = a[[r, at]]
                a[:, [at, r]] = a[:, [r, at]]
        if pair:
            block, side = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            # a block of two is only taken where its determinant is negative: one eigenvalue on each side
            below += 1
            a[k + 2 :, k + 2 :] -= side @ np.linalg.solve(block, side.T)
            k += 2
        else:
            below += a[k, k] < 0
            side = a[k + 1 :, k]
            a[k + 1 :, k + 1 :] -= np.outer(side, side / a[k, k])
            k += 1
    return int(below), vanished


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``; those equal to it to double precision may count either way."""
    below, _ = negative_pivots(shift * np.eye(len(matrix)) - matrix)
    return below


def _refined(matrix: np.ndarray, middle: float, found: np.ndarray, norm: float, seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from one step of inverse iteration at ``middle``, orthogonal to the columns of ``found``."""
    n = len(matrix)

    def apart(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - found @ (found.T @ v)
        return v / np.linalg.norm(v)

    def solved(shift: float, v: np.ndarray) -> np.ndarray:
        # where the shift is an eigenvalue, a hair beside it the system can be solved
        for beside in (0.0, 4.0, 16.0):
            try:
                out = np.linalg.solve(matrix - (shift + beside * np.finfo(float).eps * norm) * np.eye(n), v)
            except np.linalg.LinAlgError:
                continue
            most = np.abs(out).max()
            if np.isfinite(most) and most > 0:
                return out / most
        raise ArithmeticError("no shift near the eigenvalue can be solved")

    v = apart(np.random.default_rng(seed).normal(size=n))
    for _ in range(3):
        v = apart(solved(middle, v))
    value = float(v @ matrix @ v)
    best = (np.inf, value, v)
    for _ in range(12):
        rest = float(np.linalg.norm(matrix @ v - value * v))
        if rest >= best[0]:
            break
        best = (rest, value, v)
        v = apart(solved(value, v))
        value = float(v @ matrix @ v)
    return best[1], best[2]


def leading_eigenpairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues of a positive semidefinite matrix that are not zero, falling, and unit vectors (columns)."""
    n = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    zero = ZERO * norm
    values, vectors = np.zeros(0), np.zeros((n, 0))
    if not norm:
        return values, vectors
    wanted = min(most, count_above(matrix, zero))
    # counts at shifts that are known so far; eigenvalue number k (from 1) lies where the count falls from k or more to less
    known: dict[float, int] = {zero: max(wanted, count_above(matrix, zero)), norm * (1 + 1e-12) + zero: 0}

    def counted(shift: float) -> int:
        if shift not in known:
            known[shift] = count_above(matrix, shift)
        return known[shift]

    width = 8 * np.finfo(float).eps * norm
    k = 0
    while k < wanted:
        low = max(s for s, c in known.items() if c > k)
        high = min(s for s, c in known.items() if c <= k and s > low)
        # halve until the interval holds this eigenvalue alone, or cannot be halved
        while counted(low) - counted(high) > 1 and high - low > width:
            middle = (low + high) / 2
            if counted(middle) > k:
                low = middle
            else:
                high = middle
        together = min(counted(low), wanted) - k
        if together == 1 and counted(low) - counted(high) == 1:
            value, vector = _refined(matrix, (low + high) / 2, vectors[:, :0], norm, k)
            # inverse iteration may have gone to a neighbour: a narrower interval then
            while not (low <= value <= high) and high - low > width:
                middle = (low + high) / 2
                low, high = (middle, high) if counted(middle) > k else (low, middle)
                value, vector = _refined(matrix, (low + high) / 2, vectors[:, :0], norm, k)
            margin = max(width, 1e-13 * norm)
            if count_above(matrix, value - margin) < k + 1 or count_above(matrix, value + margin) > k:
                raise ArithmeticError(f"eigenvalue {k + 1} is not certified")
            values, vectors = np.append(values, value), np.column_stack([vectors, vector])
            k += 1
        else:
            # equal to double precision: a basis of their space, each orthogonal to those before
            for _ in range(together):
                value, vector = _refined(matrix, (low + high) / 2, vectors, norm, k)
                values, vectors = np.append(values, value), np.column_stack([vectors, vector])
                k += 1
    # close neighbours may be out of order, or slightly oblique, by rounding
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    for i in range(1, len(values)):
        v = vectors[:, i] - vectors[:, :i] @ (vectors[:, :i].T @ vectors[:, i])
        vectors[:, i] = v / np.linalg.norm(v)
    return values, vectors


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> tuple[DataFrame, int]:
    """vec_id and ``x`` (array of long) of the rows that remain, stored, and the dimension."""
    c = F.col(vec_col).cast("array<double>")
    good = F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)
    good &= F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    most = F.lit(float(EXACT))
    x = F.transform(c, lambda v: F.floor(F.least(F.greatest(v * scale, -most), most)) + F.lit(shift).cast("long"))
    rows = df.select(F.col(id_col).alias("vec_id"), F.when(good, x).alias("x")).filter("x IS NOT NULL")
    rows = materialize(rows, "integer_vectors")
    # lengths are few, and come as counts
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    dim = sizes["dim"] if sizes else 0
    return rows.filter(F.size("x") == dim), dim


def exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int], int]:
    """Rows of the fit list, the sum of each dimension, and the greatest absolute entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # thirds of the bits apart, so that sums of 10^12 rows of any entries fit
        total, most = np.zeros(3 * dim + 1, np.int64), 0
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            total[:-1] += np.concatenate([(x >> 2 * BITS).sum(axis=0), (x >> BITS & LOW).sum(axis=0), (x & LOW).sum(axis=0)])
            total[-1] += len(x)
            most = max(most, int(x.max()), -int(x.min())) if len(x) else most
        columns = [pa.array([0], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([str(most)])], ["segment", "part", "values", "most"])

    parts = materialize(map_batches(fit, run, "segment int, part long, values binary, most string", BATCH_BYTES), "sum_parts")
    row = tree_sum(parts, "<i8").first()
    total = np.frombuffer(row["values"], "<i8") if row else np.zeros(3 * dim + 1, np.int64)
    most = parts.agg(F.max(F.col("most").cast("decimal(38,0)"))).first()[0] or 0
    high, middle, low = (list(map(int, total[k * dim : (k + 1) * dim])) for k in range(3))
    return int(total[-1]), [(h << 2 * BITS) + (m << BITS) + c for h, m, c in zip(high, middle, low)], int(most)


def centred(x: np.ndarray, n: int, sums: np.ndarray, wide: bool) -> np.ndarray:
    """n * x - S, exact: in 64 bits, or where those could be too few, in whole numbers of any size."""
    return x.astype(object) * n - sums if wide else x * n - sums


def product_sums(rows: DataFrame, dim: int, columns: int, vectors_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the outer product of ``vectors_of(x)``, which has ``columns`` entries, with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((columns, columns))
        for batch in batches:
            y = vectors_of(_matrix(batch.column(0), dim))
            total += y.T @ y
        flat, part = total.ravel(), TaskContext.get().partitionId()
        for i, lo in enumerate(range(0, len(flat), SEGMENT)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([part], pa.int64()), pa.array([flat[lo : lo + SEGMENT].tobytes()], pa.binary())],
                ["segment", "part", "values"],
            )

    parts = materialize(map_batches(rows, run, "segment int, part long, values binary", BATCH_BYTES), "product_parts")
    found = {r["segment"]: np.frombuffer(r["values"], "<f8") for r in tree_sum(parts, "<f8").toLocalIterator()}
    flat = np.concatenate([found[s] for s in sorted(found)]) if found else np.zeros(columns * columns)
    return flat.reshape(columns, columns)


def whiten(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """One row per remaining row of ``df``: vec_id, n (vectors of the fit list), deviation (decimal: the sum over dimensions of
    (n * x - S) squared, exact), whitened (array by component), explained (array: shares of the trace), identity_error.

    identity_error is measured on the fit list's whitened vectors: how far their covariance is from the identity.
    """
    rows, dim = integer_vectors(df, id_col, vec_col, scale, shift)
    fit = materialize(rows.select("x").distinct(), "fit_list")
    n, sums, most = exact_sums(fit, dim) if dim else (0, [], 0)
    wide = n * (most + 1) * 2 >= EXACT
    whole = np.array(sums, object if wide else np.int64)

    def offsets(x: np.ndarray) -> np.ndarray:
        return centred(x, n, whole, wide).astype(np.float64) / n

    covariance = product_sums(fit, dim, dim, offsets) / n if n else np.zeros((0, 0))
    values, vectors = leading_eigenpairs(covariance, components)
    scaled = vectors / np.sqrt(values)
    k = len(values)
    error = float(np.abs(product_sums(fit, dim, k, lambda x: offsets(x) @ scaled) / n - np.eye(k)).max()) if k else 0.0
    explained = (values / np.trace(covariance)).tolist() if k else []
    names = ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gaps = centred(_matrix(batch.column(1), dim), n, whole, wide)
            far = int(np.abs(gaps).max()) if gaps.size else 0
            squares = gaps.astype(object) if far * far * dim >= EXACT else gaps
            deviation = [Decimal(int(d)) for d in (squares * squares).sum(axis=1)]
            white = gaps.astype(np.float64) / n @ scaled
            size = len(white)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.full(size, n, np.int64)), pa.array(deviation, pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(np.arange(size + 1, dtype=np.int32) * k, pa.array(white.ravel())),
                    pa.array([explained] * size, pa.list_(pa.float64())), pa.array(np.full(size, error)),
                ],
                names,
            )

    schema = f"vec_id {df.schema[id_col].dataType.simpleString()}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    return map_batches(rows.select("vec_id", "x"), run, schema, BATCH_BYTES)
