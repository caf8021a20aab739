"""Whitening of embeddings by the largest principal components, found by FEAST contour integration.

The covariance is small, a row and column per dimension; all rows are summed up in Spark, in whole numbers, so
the sums are exact and the same however the rows are dealt. Its eigenvalues are located by inertia counts: the
signs of a symmetric indefinite factorisation of the shifted matrix tell how many lie above the shift. The
wanted ones fall into intervals that end in gaps. For each interval a quadrature over a circle around it, with
complex shifted solves, projects random vectors onto its eigenvectors, and Rayleigh-Ritz extracts them; this
repeats until the residuals vanish. An interval that yields another number than its inertia counts say is
searched again with a larger subspace and more points.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.session import written

SCALE = 64
SHIFT = 1_000_000
#: Entries of this size and more count as not finite: their squares pass the exact sums.
LARGEST = float(1 << 40)
#: Eigenvalues searched in one interval, unless more of them are as good as equal.
TOGETHER = 6
#: Rows multiplied at a time.
ROWS = 4096
_EPS = np.finfo(np.float64).eps


def above(a: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of a symmetric matrix above ``shift``: the positive signs of a factorisation of
    ``a - shift`` into a triangle, blocks of one or two rows, and its transpose, with complete pivoting."""
    m = a - shift * np.eye(len(a))
    found = 0
    while len(m):
        size = np.abs(m)
        d = int(np.argmax(np.diag(size)))
        i, j = divmod(int(np.argmax(size)), len(m))
        if size[i, j] == 0:
            return found
        if size[d, d] >= 0.64 * size[i, j]:
            found += bool(m[d, d] > 0)
            rest = np.delete(np.arange(len(m)), d)
            m = m[np.ix_(rest, rest)] - np.outer(m[rest, d], m[rest, d]) / m[d, d]
        else:
            pair = [i, j]  # such a block has one positive and one negative eigenvalue
            found += 1
            rest = np.delete(np.arange(len(m)), pair)
            m = m[np.ix_(rest, rest)] - m[np.ix_(rest, pair)] @ np.linalg.solve(m[np.ix_(pair, pair)], m[np.ix_(pair, rest)])
        m = (m + m.T) / 2
    return found


def located(a: np.ndarray, most: int) -> list[tuple[float, float]]:
    """Brackets of the ``most`` largest eigenvalues, from above, found by halving with inertia counts."""
    radius = np.abs(a).sum(1).max() * (1 + 1e-9) + np.finfo(float).tiny
    fine = 1e-9 * radius
    done: list[tuple[float, float]] = []
    open_ = [(-radius, radius, len(a), 0)]  # (low, high, eigenvalues above low, above high)
    while open_ and len(done) < most:
        low, high, n_low, n_high = open_.pop()
        if n_low == n_high:
            continue
        # one eigenvalue alone needs no more than a place; several are told apart as far as rounding lets them
        if high - low <= (1e-4 * radius if n_low - n_high == 1 else fine):
            done += [(low, high)] * (n_low - n_high)
            continue
        mid = (low + high) / 2
        n = above(a, mid)
        open_ += [(low, mid, n_low, n), (mid, high, n, n_high)]
    return done


def intervals(a: np.ndarray, most: int) -> list[tuple[float, float, int]]:
    """``(low, high, eigenvalues)``: intervals from above that hold at least the ``most`` largest eigenvalues and
    end in gaps, each with its inertia count."""
    found = located(a, min(len(a), most + TOGETHER))
    tops = [high for _, high in found]
    bottoms = [low for low, _ in found]
    scale = np.abs(a).sum(1).max()
    cuts, inside = [tops[0] + 1e-3 * scale], 0
    while inside < most and inside < len(found):
        # the widest gap within the next few, or the first real one after a close group
        reach = range(inside + 1, min(inside + TOGETHER, len(found) - 1) + 1)
        gaps = {k: bottoms[k - 1] - tops[k] for k in reach}
        k = max(gaps, key=lambda k: gaps[k] * (1 + 0.1 * (k - inside)), default=None)
        if k is None or gaps[k] <= 1e-9 * scale:
            k = next((k for k in range(inside + 1, len(found)) if bottoms[k - 1] - tops[k] > 1e-9 * scale), len(found))
        cuts.append((bottoms[k - 1] + tops[k]) / 2 if k < len(found) else bottoms[-1] - max(1e-9 * scale, (cuts[-1] - bottoms[-1]) * 0.1))
        inside = k
    return [(low, high, above(a, low) - above(a, high)) for high, low in zip(cuts, cuts[1:])]


def feast(a: np.ndarray, low: float, high: float, count: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of a symmetric matrix within an interval, from above."""
    d = len(a)
    middle, radius = (low + high) / 2, (high - low) / 2
    scale = max(np.abs(a).sum(1).max(), np.finfo(float).tiny)
    for attempt in range(6):
        points = 8 + 8 * attempt
        nodes, weights = np.polynomial.legendre.leggauss(points)
        width = min(d, 2 * count + 4 * (attempt + 1))
        base = rng.normal(size=(d, width))
        for _ in range(40):
            held = np.zeros((d, base.shape[1]))
            for node, weight in zip(nodes, weights):
                turn = np.exp(1j * np.pi / 2 * (1 - node))
                solved = np.linalg.solve((middle + radius * turn) * np.eye(d) - a, base.astype(complex))
                held += weight / 2 * (radius * turn * solved).real
            axes, size, _ = np.linalg.svd(held, full_matrices=False)
            axes = axes[:, size > size[0] * 1e-13]
            values, turned = np.linalg.eigh(axes.T @ a @ axes)
            base = axes @ turned
            inside = np.flatnonzero((values > low) & (values < high))[::-1]
            off = np.abs(a @ base[:, inside] - base[:, inside] * values[inside]).max(initial=0)
            if len(inside) == count and off <= 64 * _EPS * scale:
                vectors, _ = np.linalg.qr(base[:, inside])
                # one more extraction, so that the group is orthogonal to the last bit
                values, turned = np.linalg.eigh(vectors.T @ a @ vectors)
                return values[::-1], (vectors @ turned)[:, ::-1]
    raise ArithmeticError(f"no {count} eigenpairs found between {low} and {high}")


def top_components(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and their unit eigenvectors as columns. Of eigenvalues that are
    zero up to rounding none is returned; the signs make each vector's largest entry positive."""
    d = len(a)
    if not d or not np.abs(a).any():
        return np.zeros(0), np.zeros((d, 0))
    unit = np.abs(a).max()
    a = (a + a.T) / (2 * unit)
    rng = np.random.default_rng(0)
    values, vectors = [], []
    for low, high, count in intervals(a, min(most, d)):
        if count:
            e, v = feast(a, low, high, count, rng)
            values.append(e)
            vectors.append(v)
    e, v = np.concatenate(values)[:most], np.concatenate(vectors, 1)[:, :most]
    real = e > 4 * d * _EPS * np.trace(a)
    e, v = e[real], v[:, real]
    heads = v[np.abs(v).argmax(0), np.arange(v.shape[1])]
    return e * unit, v * np.where(heads < 0, -1.0, 1.0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Packed rows of 64-bit numbers as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, width)


def _products(x: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and sums of products of shifted rows."""
    y = x - shift
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * len(y) < 1 << 53:
        f = y.astype(np.float64)  # every product and sum is a whole number that a double holds
        return y.sum(0), (f.T @ f).astype(np.int64)
    o = y.astype(object)
    return o.sum(0), o.T @ o


def _partial(width: int, shift: list[int], squares: bool):
    """Rows to ``(i, j, v)``: with j = 0 the sum of dimension i, else the sum of products of dimensions i and j - 1, which
    is not before i; with i = -1 the number of rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = np.array(shift, np.int64)
        total = np.zeros((width if squares else 0) + 1, object)[:, None] + np.zeros(width, object)
        seen = 0
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                x = _matrix(batch.column(0).slice(a, ROWS), width)
                seen += len(x)
                if squares:
                    sums, many = _products(x, by)
                    total[1:] += many
                    total[0] += sums
                else:  # entries are below 2**41, so a batch's sum fits
                    total[0] += x.sum(0)
        if seen:
            rows = [(i, j, Decimal(int(v))) for j, row in enumerate(total) for i, v in enumerate(row) if not j or j > i] + [(-1, 0, Decimal(seen))]
            i, j, v = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v, pa.decimal128(38, 0))], ["i", "j", "v"])

    return add


def _totals(rows: DataFrame, width: int, shift: list[int], squares: bool) -> dict[tuple[int, int], int]:
    """Sums over all rows; as many numbers come to the driver as half the covariance has entries."""
    made = rows.mapInArrow(_partial(width, shift, squares), "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r["i"], r["j"]): int(r["v"]) for r in made.collect()}


class Space:
    """Number of distinct vectors, exact sums, components with their eigenvalues, and the total variance."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, axes: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.axes, self.trace = n, sums, values, axes, trace
        #: the mean as a whole number and a remainder, so that differences keep all digits
        self.whole = np.array([s // n for s in sums], np.int64)
        self.remainder = np.array([float(Fraction(s % n, n)) for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.remainder

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n x - S)^2, exact."""
        rest = np.array([s % self.n for s in self.sums], object)
        y = x - self.whole
        largest = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if largest * largest * x.shape[1] < 1 << 62:
            off = y * self.n - rest.astype(np.int64)
            return (off * off).sum(1).tolist()
        off = y.astype(object) * self.n - rest
        return (off * off).sum(1).tolist()


def fit_space(x_rows: DataFrame, width: int, most: int) -> Space | None:
    """The whitening space of the distinct rows of packed vectors, or none without rows."""
    first = _totals(x_rows, width, [0] * width, False)
    if not first:
        return None
    n, sums = first[-1, 0], [first[i, 0] for i in range(width)]
    near = [s // n for s in sums]
    second = _totals(x_rows, width, near, True)
    rest = [second[i, 0] for i in range(width)]
    # whole numbers near the mean were taken off before multiplying; what is left of the mean goes exactly
    cov = [[Fraction(n * second[min(i, j), max(i, j) + 1] - rest[i] * rest[j], n * n) for j in range(width)] for i in range(width)]
    a = np.array([[float(v) for v in row] for row in cov])
    values, axes = top_components(a, most)
    return Space(n, sums, values, axes, float(sum(cov[i][i] for i in range(width))))


def whiten(
    vectors: DataFrame, most: int = 16, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``: a row for each vector and component.

    An entry c becomes x = floor(scale c) + shift. Vectors that are null, empty, or hold null or non-finite
    entries are left out, and so are entries of 2**40 and more, and vectors of another width than most have (of
    equal numbers, the larger width). The space is fitted on each distinct x vector once; all remaining rows,
    repeated ones and null ids too, are projected. Components with eigenvalue zero, as of constant or dependent
    dimensions, have no rows. ``deviation`` is a decimal, null beyond 38 digits. An empty table, or one with a
    single distinct vector, gives an empty result. Other columns are not read.

    Rows are packed, made distinct by a shuffle with map-side combining, and summed up in every task; the driver
    gets one number per entry of the covariance, bounded by the width and not by the rows."""
    spark = vectors.sparkSession
    entry = F.col(vector_col)
    fine = F.forall(entry, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(LARGEST / scale), F.lit(False)))
    kept = vectors.where(entry.isNotNull() & (F.size(entry) > 0)).where(fine).select(F.col(id_col).alias("id"), entry.cast("array<double>").alias("c"))
    widths = kept.groupBy(F.size("c").alias("width")).count().orderBy(F.col("count").desc(), F.col("width").desc()).limit(1).collect()
    kind = kept.schema["id"].dataType.simpleString()
    shape = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not widths:
        return spark.createDataFrame([], shape)
    width = widths[0]["width"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                c = np.asarray(part.column(1).flatten(), np.float64).reshape(-1, width)
                x = np.ascontiguousarray((np.floor(scale * c).astype(np.int64) + shift).astype("<i8"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "x"])

    packed = kept.where(F.size("c") == width).mapInArrow(pack, f"id {kind}, x binary")
    distinct = written(packed.select("x").distinct(), "vectors")
    space = fit_space(distinct, width, most)
    if space is None or not len(space.values):
        return spark.createDataFrame([], shape)
    told = spark.sparkContext.broadcast(space)
    k = len(space.values)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of products of whitened vectors, for the covariance that whitening leaves."""
        total, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            w = told.value.whitened(_matrix(batch.column(0), width))
            total += w.T @ w
            sums += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k + k, dtype=np.int32)), pa.array(np.concatenate([total.ravel(), sums]))], ["i", "v"])

    left = {r["i"]: r["v"] for r in distinct.mapInArrow(spread, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    mean = np.array([left[k * k + i] for i in range(k)]) / space.n
    cov = np.array([left[i] for i in range(k * k)]).reshape(k, k) / space.n - np.outer(mean, mean)
    error = float(np.abs(cov - np.eye(k)).max())
    explained = space.values / space.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = told.value
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                x = _matrix(part.column(1), width)
                rows = np.repeat(np.arange(len(x)), k)
                off = [Decimal(v) if v < 10**38 else None for v in s.deviations(x)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(rows), s.n)), pa.array(off, pa.decimal128(38, 0)).take(pa.array(rows)),
                     pa.array(s.whitened(x).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rows), error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return packed.mapInArrow(project, shape)
