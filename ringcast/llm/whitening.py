"""Embedding whitening: principal components scaled to unit variance.

Each entry c of a vector becomes the whole number x = floor(scale * c) + offset.
Four passes over the stored rows, each a sum that tasks reduce before the
shuffle: the exact sums S per dimension; the covariance of x - S/n, centred
before multiplying; the sums of the whitened values; their centred covariance,
which says how far it is from the identity. Only figures of the size of the
dimension (d sums, d * d covariances) reach the driver, whatever the number of
rows. There the covariance is brought to tridiagonal form by Householder
reflections, its leading eigenvalues are found by bisection on Sturm counts, and
their vectors by inverse iteration, those of close eigenvalues made orthogonal
to each other in every step. The projection (d x components) goes to the tasks.

Defined results: rows whose vector is null or holds null or non-finite entries
are left out; a null vec_id stays as it is, and rows that repeat a vec_id count
each. A shorter vector counts as zero beyond its end, an empty one as zeros. An
entry of 2^53 or more after scaling, or a deviation that does not fit a long, is
an error. Components whose eigenvalue is zero within rounding have no whitened
values and are not returned, so an empty table, a single row or equal rows give
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.llm.vectors import FINITE, matrix
from ringcast.session import materialize

EPS = float(np.finfo(np.float64).eps)
ZERO = 1e-12  # eigenvalues up to this share of the largest, times the dimension, count as zero
LARGEST = 1 << 53


def whole_rows(vectors: DataFrame, scale: int, offset: int) -> DataFrame:
    """vec_id and the whole numbers x of every vector without null or non-finite entries."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    v = v.filter(FINITE.format("e"))
    too_large = F.raise_error(F.lit("an entry is too large to whiten")).cast("long")

    def whole(c):
        y = F.floor(c * F.lit(float(scale)))
        return F.when(F.abs(c * F.lit(float(scale))) + abs(offset) >= F.lit(float(LARGEST)), too_large) \
            .otherwise(y + F.lit(offset).cast("long"))
    return v.select("vec_id", F.transform("e", whole).alias("x"))


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit numbers where they surely fit, else any size."""
    if n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums), default=0) < 1 << 62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def deviations(diff: np.ndarray) -> np.ndarray:
    """Exact sum of squares of each row."""
    most = max(abs(int(diff.max(initial=0))), abs(int(diff.min(initial=0)))) if diff.size else 0
    if most * most * max(1, diff.shape[1]) < 1 << 63:
        return (diff * diff).sum(axis=1)
    total = [sum(v * v for v in row) for row in diff.tolist()]
    if max(total) >= 1 << 63:
        raise OverflowError("a deviation does not fit a long")
    return np.array(total, dtype=np.int64)


def column_sums(rows: DataFrame, offset: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sums per dimension of stored whole rows."""
    def part(batches):
        n, count, total = 0, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=object)
        for batch in batches:
            column = batch.column("x")
            lengths = np.diff(np.asarray(column.offsets))
            d = max(int(lengths.max(initial=0)), len(count))
            count = np.pad(count, (0, d - len(count)))
            total = np.concatenate([total, np.zeros(d - len(total), dtype=object)])
            n += len(lengths)
            count += (np.arange(d)[None, :] < lengths[:, None]).sum(axis=0)
            # a batch's entries are below 2^53: halves of them sum exactly in 64 bits
            x = matrix(column, d, dtype=np.int64)
            total += (x >> 26).sum(axis=0).astype(object) * (1 << 26) + (x & ((1 << 26) - 1)).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array([-1, *range(len(count))], pa.int32()), "n": pa.array([n, *count.tolist()], pa.int64()),
            "s": pa.array([None, *map(str, total.tolist())], pa.string())})

    found = rows.mapInArrow(part, "dim int, n long, s string").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    n = sum(r.n for r in found if r.dim < 0)
    by_dim = {r.dim: int(r.s) + offset * (n - r.n) for r in found if r.dim >= 0}
    return n, [by_dim[i] for i in range(len(by_dim))]


def product_sums(rows: DataFrame, values, width: int) -> np.ndarray:
    """Sum over all rows of the outer product of ``values(batch)`` with itself."""
    def part(batches):
        total = np.zeros((width, width))
        for batch in batches:
            y = values(batch)
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(width), pa.int32()),
                                          "v": pa.array(total.tolist(), pa.list_(pa.float64()))})

    out = np.zeros((width, width))
    cells = rows.mapInArrow(part, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    for r in cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return (out + out.T) / 2


def value_sums(rows: DataFrame, values, width: int) -> np.ndarray:
    """Sum over all rows of ``values(batch)``."""
    def part(batches):
        total = np.zeros(width)
        for batch in batches:
            total += values(batch).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"j": pa.array(range(width), pa.int32()), "v": pa.array(total)})

    out = np.zeros(width)
    for r in rows.mapInArrow(part, "j int, v double").groupBy("j").agg(F.sum("v").alias("v")).collect():
        out[r.j] = r.v
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, Q) with a = Q T Q', by Householder reflections."""
    a, d = a.copy(), len(a)
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        norm = float(np.linalg.norm(x))
        if norm == 0 or not np.any(x[1:]):
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        # A <- (I - 2xx') A (I - 2xx') on the trailing block
        trailing = a[k + 1:, k + 1:]
        p = trailing @ x
        w = 2 * (p - (x @ p) * x)
        trailing -= np.outer(x, w) + np.outer(w, x)
        column = a[k + 1:, k] - 2 * x * (x @ a[k + 1:, k])
        a[k + 1:, k] = a[k, k + 1:] = column
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each value of ``at``."""
    least = np.finfo(np.float64).tiny * max(1.0, float(np.max(off * off, initial=0)))
    below = np.zeros(len(at), dtype=np.int64)
    pivot = diagonal[0] - at
    for i in range(len(diagonal)):
        if i:
            pivot = diagonal[i] - at - off[i - 1] ** 2 / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each by bisection."""
    d = len(diagonal)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    width = max(float((np.abs(diagonal) + reach).max()), np.finfo(np.float64).tiny)
    low = np.full(k, float((diagonal - reach).min()) - 2 * EPS * width * d)
    high = np.full(k, float((diagonal + reach).max()) + 2 * EPS * width * d)
    rank = d - 1 - np.arange(k)  # the eigenvalue's index from the bottom
    for _ in range(200):
        middle = (low + high) / 2
        up = sturm_counts(diagonal, off, middle) <= rank
        low, high = np.where(up, middle, low), np.where(up, high, middle)
        if np.all(high - low <= EPS * np.maximum(np.abs(low), np.abs(high)) + EPS * EPS * width):
            break
    return (low + high) / 2


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift I)^-1 b by elimination with row interchanges; zero pivots become ``least``."""
    d = len(diagonal)
    main, up, up2, x = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * d, b.tolist()
    low = off.tolist()
    for i in range(d - 1):
        if abs(low[i]) > abs(main[i]):
            factor = main[i] / low[i]
            main[i], up[i], main[i + 1], up[i + 1], up2[i] = \
                low[i], main[i + 1], up[i] - factor * main[i + 1], -factor * up[i + 1], up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            if abs(main[i]) < least:
                main[i] = least
            factor = low[i] / main[i]
            main[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
    for i in range(d - 1, -1, -1):
        pivot = main[i] if abs(main[i]) >= least else least
        x[i] = (x[i] - (up[i] * x[i + 1] if i + 1 < d else 0) - (up2[i] * x[i + 2] if i + 2 < d else 0)) / pivot
    return np.array(x)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling eigenvalues. Vectors of a cluster
    (neighbours closer than a thousandth of the matrix) are kept orthogonal."""
    d = len(diagonal)
    size = max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0)), np.finfo(np.float64).tiny)
    draw = np.random.default_rng(13)
    out = np.zeros((d, len(values)))
    first, shift = 0, np.inf
    for j, value in enumerate(values.tolist()):
        if j and values[j - 1] - value > 1e-3 * size:
            first = j
        # equal eigenvalues get shifts of their own
        shift = min(value, shift - 10 * EPS * size) if j > first else value
        x = draw.standard_normal(d)
        for _ in range(5):
            x = solve_shifted(diagonal, off, shift, x / np.abs(x).max(), EPS * size)
            x /= np.abs(x).max()
            for _ in range(2 if j > first else 0):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def principal_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit vectors as columns) of the k leading components
    whose eigenvalue is not zero within rounding."""
    if not len(covariance):
        return np.zeros(0), np.zeros((0, 0))
    size = float(np.abs(covariance).max())
    if size == 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    diagonal, off, q = tridiagonal(covariance / size)
    values = leading_eigenvalues(diagonal, off, min(k, len(diagonal)))
    values = values[values > ZERO * len(diagonal) * values[0]]
    vectors = q @ inverse_iteration(diagonal, off, values)
    # either sign: the entry of the largest size is positive
    top = np.abs(vectors).argmax(axis=0)
    return values * size, vectors * np.sign(vectors[top, np.arange(len(values))])


def whiten(vectors: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and
    identity_error for every row and leading component."""
    rows = materialize(whole_rows(vectors, scale, offset), "whitening-rows")
    n, sums = column_sums(rows, offset)
    d = len(sums)

    def distances(batch):
        return centred(matrix(batch.column("x"), d, offset, np.int64), n, sums).astype(np.float64) / n

    covariance = product_sums(rows, distances, d) / max(1, n)
    values, axes = principal_components(covariance, components)
    projection, k = axes / np.sqrt(values), len(values)
    explained = (values / np.trace(covariance)).tolist() if k else []

    def whitened(batch):
        return distances(batch) @ projection

    mean = value_sums(rows, whitened, k) / max(1, n)
    off = product_sums(rows, lambda batch: whitened(batch) - mean, k) / max(1, n) - np.eye(k)
    identity_error = float(np.abs(off).max(initial=0))

    def result(batches):
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows if k else 0, 4096)):
                diff = centred(matrix(part.column("x"), d, offset, np.int64), n, sums)
                m = part.num_rows
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    "n": pa.array(np.full(m * k, n, dtype=np.int64)),
                    "deviation": pa.array(np.repeat(deviations(diff), k)),
                    "whitened": pa.array((diff.astype(np.float64) / n @ projection).ravel()),
                    "explained": pa.array(np.tile(explained, m)),
                    "identity_error": pa.array(np.full(m * k, identity_error))})

    return rows.mapInArrow(result, "vec_id long, component int, n long, deviation long, whitened double, "
                                   "explained double, identity_error double")
