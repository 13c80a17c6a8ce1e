"""Whitening of embeddings from a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries become whole numbers, so the sums over the distinct vectors are exact: every vector is
centred at the whole number next to the mean before it is multiplied, and the remaining fraction
of the centre is taken out of the exact sums. The scatter (one small matrix, width by width) is
factored by Cholesky with diagonal pivoting; rotations of pairs of columns of the triangular factor
make its columns orthogonal. Their squared norms are the eigenvalues, the unit columns the components.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.common import discarded, map_batches, written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
# width of a matrix that is still factored on the driver
MOST_WIDTH = 4096
_EXACT = float(2 ** 53)
_LONG = 2 ** 63


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """Columns of a factor f with f f' = a, rows in the order of a, the largest pivot first.

    Ends at the numerical rank; a is symmetric and positive semi-definite.
    """
    d = len(a)
    left, factor = a.copy(), np.zeros((d, d))
    floor = d * np.finfo(float).eps * max(float(np.max(np.diag(a), initial=0)), 0.0)
    done = np.zeros(d, bool)
    for k in range(d):
        diagonal = np.where(done, -np.inf, np.diag(left))
        p = int(np.argmax(diagonal))
        if not diagonal[p] > floor:
            return factor[:, :k]
        column = np.where(done, 0.0, left[:, p]) / np.sqrt(diagonal[p])
        factor[:, k] = column
        left -= np.outer(column, column)
        done[p] = True
    return factor


def _rounds(n: int):
    """Rounds of disjoint pairs in which each two of n columns meet once (n even)."""
    ring = list(range(n))
    for _ in range(n - 1):
        yield np.array(ring[:n // 2]), np.array(ring[n // 2:][::-1])
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of factor factor', by rotating pairs of columns."""
    rank = factor.shape[1]
    if not rank:
        return np.zeros(0), factor
    columns = np.zeros((factor.shape[0], rank + rank % 2))
    columns[:, :rank] = factor
    rounds = list(_rounds(columns.shape[1]))
    tolerance = 4 * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for left, right in rounds:
            x, y = columns[:, left], columns[:, right]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(c) > tolerance * np.sqrt(a * b)
            if not off.any():
                continue
            turned = True
            zeta = np.where(off, (b - a) / (2 * np.where(off, c, 1.0)), 0.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(off, t, 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            sin = cos * t
            columns[:, left], columns[:, right] = cos * x - sin * y, sin * x + cos * y
        if not turned:
            break
    norms = np.sqrt((columns * columns).sum(0))
    order = np.argsort(-norms, kind="stable")[:rank]
    return norms[order] ** 2, columns[:, order] / norms[order]


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y of whole numbers as Python integers, whatever their size."""
    top = float(np.abs(y).max(initial=0))
    if not len(y):
        return np.zeros((y.shape[1],) * 2, object)
    rows = int(_EXACT // max(1.0, top * top))
    if rows < 1:
        big = y.astype(object)
        return big.T @ big
    total = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), rows):
        part = y[at:at + rows].astype(float)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _whole(column: pa.Array) -> list[np.ndarray | None]:
    """The whole numbers of each vector; None where it or an entry is null, not finite or beyond a long."""
    column = column.cast(pa.large_list(pa.float64()))
    flat = column.flatten()
    missing = np.asarray(flat.is_null())
    entries = np.asarray(flat.fill_null(np.nan).to_numpy(zero_copy_only=False), float)
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(SCALE * entries) + SHIFT
        bad = missing | ~(np.abs(whole) < 2.0 ** 62)
    lengths = np.where(column.is_null(), 0, column.value_lengths().fill_null(0)).astype(np.int64)
    ends = np.cumsum(lengths)
    out: list[np.ndarray | None] = []
    for valid, low, high in zip(column.is_valid().to_pylist(), ends - lengths, ends):
        out.append(None if not valid or bad[low:high].any() else whole[low:high].astype(np.int64))
    return out


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and x of the rows whose vector has finite entries only."""
    def make():
        def step(batch):
            xs = _whole(batch.column("embedding"))
            keep = [i for i, x in enumerate(xs) if x is not None and len(x)]
            return {"vec_id": batch.column("vec_id").take(pa.array(keep, pa.int64())), "x": [xs[i] for i in keep]}
        return step

    return map_batches(embeddings.select("vec_id", "embedding"), make, "vec_id long, x array<long>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width)


def _summed(distinct: DataFrame, width: int, partial) -> dict[tuple[int, int], int]:
    """Sums over all batches of the whole numbers partial(x) gives by (i, j), as Python integers."""
    def run(batches):
        total: dict = {}
        for batch in batches:
            for key, value in partial(_matrix(batch.column("x"), width)):
                total[key] = total.get(key, 0) + int(value)
        if total:
            keys = list(total)
            yield pa.RecordBatch.from_pydict({"i": pa.array([k[0] for k in keys], pa.int32()), "j": pa.array([k[1] for k in keys], pa.int32()),
                                              "value": pa.array([str(total[k]) for k in keys])})

    # at most width * width sums from each task; they are added in decimal and few in the end
    parts = distinct.mapInArrow(run, "i int, j int, value string")
    rows = parts.groupBy("i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    return {(r["i"], r["j"]): int(r["value"]) for r in rows}


class Whitening:
    """Mean, components and eigenvalues of the distinct vectors x (one row each, equal widths)."""

    def __init__(self, distinct: DataFrame, width: int, most: int = COMPONENTS):
        if width > MOST_WIDTH:
            raise ValueError(f"vectors of {width} entries: the scatter is factored up to {MOST_WIDTH}")
        self.width = width
        first = _summed(distinct, width, lambda x: [((-1, -1), len(x)), *(((i, -1), v) for i, v in enumerate(x.astype(object).sum(axis=0)))])
        self.n = first.get((-1, -1), 0)
        self.sums = [first.get((i, -1), 0) for i in range(width)]
        if not self.n:
            return
        self.centre = [int(round(Fraction(s, self.n))) for s in self.sums]
        centre, (low, high) = np.array(self.centre, np.int64), np.triu_indices(width)

        def scatter(x):
            products = exact_products(x - centre)[low, high]
            return [((int(i), int(j)), v) for i, j, v in zip(low, high, products)]

        second = _summed(distinct, width, scatter)
        # what the whole centre leaves of the mean, in units of 1 / n
        self.rest = [s - self.n * c for s, c in zip(self.sums, self.centre)]
        covariance = np.zeros((width, width))
        for i, j in zip(low, high):
            exact = Fraction(self.n * second[int(i), int(j)] - self.rest[i] * self.rest[j], self.n ** 2)
            covariance[i, j] = covariance[j, i] = float(exact)
        self.trace = float(np.trace(covariance))
        values, vectors = one_sided_jacobi(pivoted_cholesky(covariance))
        self.values, self.vectors = values[:most], vectors[:, :most]
        self.error = self._identity_error(distinct)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the components, with unit variance over the distinct vectors."""
        centred = (x - np.array(self.centre, np.int64)).astype(float) - np.array([r / self.n for r in self.rest])
        return centred @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact squared distance from the mean times n squared; None beyond a long."""
        y, rest = x - np.array(self.centre, np.int64), np.array(self.rest, object)
        reach = self.n * (float(np.abs(y).max(initial=0)) + 1)
        if reach * reach * self.width < 2 ** 62:
            t = self.n * y - rest.astype(np.int64)
            return (t * t).sum(axis=1).tolist()
        t = self.n * y.astype(object) - rest
        return [v if v < _LONG else None for v in (t * t).sum(axis=1)]

    def _identity_error(self, distinct: DataFrame) -> float:
        """Largest entry of the covariance of the whitened vectors minus the identity."""
        k, width, whitened = len(self.values), self.width, self.whitened

        def run(batches):
            total, count = np.zeros((k + 1, k)), 0
            for batch in batches:
                w = whitened(_matrix(batch.column("x"), width))
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
                count += len(w)
            if count:
                yield pa.RecordBatch.from_pydict({"part": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

        if not k:
            return 0.0
        parts = distinct.mapInArrow(run, "part array<double>")
        sums = (parts.select(F.posexplode("part").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect())
        total = np.zeros((k + 1) * k)
        for r in sums:
            total[r["at"]] = r["v"]
        total = total.reshape(k + 1, k) / self.n
        return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Rows whose vector is null, empty or holds null or non-finite entries (or entries whose whole
    number is beyond a long) are dropped; so are vectors of another width than the most frequent one
    (the smaller of two equally frequent), which lie in no common space. Repeated rows and null ids
    each give their rows, while the sums take each distinct vector once. Components end at the rank of
    the covariance, so a table of equal vectors, like an empty one, gives no row. A deviation
    beyond a long is null. Other columns are not read.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = whole_vectors(embeddings)
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    width = widths["width"]
    rows = rows.where(F.size("x") == width)
    distinct, folder = written(rows.select("x").distinct())
    fit = Whitening(distinct, width, most)
    discarded(embeddings.sparkSession, folder)
    k = len(fit.values)
    explained = fit.values / fit.trace if k else np.zeros(0)

    def make():
        def step(batch):
            x = _matrix(batch.column("x"), width)
            m = len(x)
            deviations = pa.array(fit.deviations(x), pa.int64())
            each = pa.array(np.repeat(np.arange(m), k))
            return {"vec_id": batch.column("vec_id").take(each), "component": np.tile(np.arange(1, k + 1), m), "n": np.full(m * k, fit.n),
                    "deviation": deviations.take(each), "whitened": fit.whitened(x).ravel(), "explained": np.tile(explained, m),
                    "identity_error": np.full(m * k, fit.error)}
        return step

    return map_batches(rows, make, schema)
