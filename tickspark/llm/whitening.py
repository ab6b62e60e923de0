"""Embedding whitening: principal components by contour integration (the FEAST method).

Sums, covariances and the whitened rows are made by tasks over the whole table; only a
matrix of dimension by dimension comes to the driver. Its spectrum is cut into intervals
of few eigenvalues, where inertia says how many each holds: the signs in a symmetric
elimination of the shifted matrix are those of its eigenvalues. For an interval, solves
with the matrix shifted to complex points around it, summed by Gauss-Legendre weights,
project a block of vectors onto the eigenvectors inside. Rayleigh-Ritz takes eigenpairs
out of that space, which is projected again until their residuals are those of
rounding, and as many must be found as inertia counts. A last Rayleigh-Ritz over all
found vectors makes them orthogonal across intervals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean

#: Components that are kept, eigenvalues an interval should hold at most, and points of the quadrature on a half circle.
COMPONENTS, IN_INTERVAL, POINTS = 32, 8, 12
EPS = float(np.finfo(float).eps)


def below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are less than ``shift``.

    Symmetric elimination with complete pivoting by blocks of one or two rows; a block
    of two is taken only where its determinant is negative, so it has one of each sign.
    """
    m, negative = a - shift * np.eye(len(a)), 0
    while len(m):
        on = np.abs(np.diag(m))
        off = np.abs(m - np.diag(np.diag(m)))
        p, q = np.unravel_index(int(off.argmax()), off.shape)
        k = int(on.argmax())
        if max(on[k], off[p, q]) == 0:
            break
        rows = [k] if on[k] >= 0.64 * off[p, q] else [int(p), int(q)]
        rest = [i for i in range(len(m)) if i not in rows]
        block, side = m[np.ix_(rows, rows)], m[np.ix_(rest, rows)]
        negative += int(block[0, 0] < 0) if len(rows) == 1 else 1
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        m = (m + m.T) / 2
    return negative


def intervals(a: np.ndarray, wanted: int, most: int = IN_INTERVAL, cuts: int = 16) -> Iterator[tuple[float, float, int]]:
    """(from, to, eigenvalues in it), from the top down, until ``wanted`` eigenvalues are covered.

    An interval of more than ``most`` is cut where the count stays the same on both sides, so
    borders lie in gaps; a very narrow one is a cluster and is left whole.
    """
    reach = np.abs(a - np.diag(np.diag(a))).sum(1)  # Gershgorin's circles hold the spectrum
    low, high = float((np.diag(a) - reach).min()), float((np.diag(a) + reach).max())
    pad = 1e-3 * max(abs(low), abs(high), np.finfo(float).tiny)
    open_, covered = [(low - pad, high + pad, 0, len(a))], 0
    while open_ and covered < wanted:
        x, y, under_x, under_y = open_.pop()
        n = under_y - under_x
        if n == 0:
            continue
        if n <= most or y - x <= 1e-7 * max(abs(low), abs(high)):
            covered += n
            yield x, y, n
            continue
        at = np.linspace(x, y, cuts + 2)
        under = [under_x, *(below(a, s) for s in at[1:-1]), under_y]
        calm = [k for k in range(1, cuts + 1) if under[k - 1] == under[k] == under[k + 1] and under_x < under[k] < under_y]
        cut = min(calm or range(1, cuts + 1), key=lambda k: abs(under[k] - (under_x + under_y) / 2))
        open_ += [(x, float(at[cut]), under_x, under[cut]), (float(at[cut]), y, under[cut], under_y)]


def inside(a: np.ndarray, low: float, high: float, count: int, points: int = POINTS, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between two bounds and their unit eigenvectors, as columns."""
    d, scale = len(a), float(np.abs(a).sum(1).max()) or 1.0
    x, w = np.polynomial.legendre.leggauss(points)
    turn = np.exp(1j * np.pi / 2 * (1 - x))
    centre, radius = (low + high) / 2, (high - low) / 2
    width = min(d, count + max(4, count // 2))
    block = np.random.default_rng(0).standard_normal((d, width))
    for k in range(rounds):
        projected = np.zeros_like(block)
        for t, weight in zip(turn, w):
            solved = np.linalg.solve((centre + radius * t) * np.eye(d) - a, block.astype(complex))
            projected += weight / 2 * (radius * t * solved).real
        q, _ = np.linalg.qr(projected)
        e, vectors = np.linalg.eigh(q.T @ a @ q)
        block = q @ vectors
        found = (e > low) & (e <= high) & (np.linalg.norm(a @ block - block * e, axis=0) <= 64 * EPS * scale)
        if found.sum() == count and k:
            return e[found], block[:, found]
        if k % 10 == 9 and width < d:  # more directions than room
            more = np.random.default_rng(k).standard_normal((d, min(d - width, width)))
            block, width = np.hstack([block, more]), width + more.shape[1]
    raise ArithmeticError(f"{found.sum()} of {count} eigenvalues found from {low} to {high}")


def components(a: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding, falling, and their unit eigenvectors as columns."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for cuts in (16, 19, 23) if np.abs(a).max(initial=0) > 0 else ():  # other borders, if one lies on an eigenvalue
        try:
            parts = [inside(a, *part) for part in intervals(a, min(wanted, len(a)), cuts=cuts)]
            break
        except ArithmeticError:
            if cuts == 23:
                raise
    if not parts:
        return np.zeros(0), np.zeros((len(a), 0))
    q, _ = np.linalg.qr(np.hstack([v for _, v in parts]))
    e, vectors = np.linalg.eigh(q.T @ a @ q)
    order = np.argsort(-e)[:wanted]
    order = order[e[order] > 8 * len(a) * EPS * e.max()]
    if len(order):
        last, rounding = float(e[order[-1]]), 64 * EPS * float(np.abs(a).sum(1).max())
        if len(a) - below(a, last + rounding) >= len(order) or len(a) - below(a, last - rounding) < len(order):
            raise ArithmeticError("inertia counts other eigenvalues above the last component")
    return e[order], (q @ vectors)[:, order]


@dataclass(frozen=True)
class Whitening:
    """What was fitted: rows, exact sums of each dimension, eigenvalues, eigenvectors as columns, trace, identity error."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> list[float]:
        return (self.eigenvalues / self.trace).tolist()

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ (self.vectors / np.sqrt(self.eigenvalues))


def matrix_of(lists: pa.Array) -> np.ndarray:
    """Lists of integers, equally long, as a matrix."""
    if len(set(np.diff(lists.offsets.to_numpy()))) > 1:
        raise ValueError("vectors of different lengths")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _each_sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            x = matrix_of(batch.column(0))
            own = x.sum(0)
            if total is not None and len(own) != len(total):
                raise ValueError("vectors of different lengths")
            n, total = n + len(x), own if total is None else total + own
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "sums"])


def sums(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """How many vectors there are, and the exact sum of each dimension."""
    each = rows.mapInArrow(lean(_each_sum), "n long, sums array<long>").select("n", F.posexplode("sums"))
    found = each.groupBy("pos").agg(F.sum(F.col("n").cast("decimal(20)")).alias("n"), F.sum(F.col("col").cast("decimal(28)")).alias("s")).orderBy("pos").collect()
    if len({r["n"] for r in found}) > 1:
        raise ValueError("vectors of different lengths")
    return (int(found[0]["n"]), tuple(int(r["s"]) for r in found)) if found else (0, ())


def covariance(rows: DataFrame, n: int, of: Callable[[np.ndarray], np.ndarray], d: int) -> np.ndarray:
    """The covariance of ``of(x)``, which is centred, with divisor n; what centring has left is taken off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d))
        for batch in batches:
            y = of(matrix_of(batch.column(0))) if batch.num_rows else np.zeros((0, d))
            total[:d] += y.T @ y
            total[d] += y.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "sums"])

    each = rows.mapInArrow(lean(run), "i int, sums array<double>").select("i", F.posexplode("sums").alias("j", "s"))
    m = np.zeros((d + 1, d))
    for r in each.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        m[r["i"], r["j"]] = r["s"]
    left = m[d] / n
    return (m[:d] + m[:d].T) / 2 / n - np.outer(left, left)


def fit(df: DataFrame, vector: str = "x", wanted: int = COMPONENTS) -> Whitening | None:
    """Fit on all vectors of integers: three passes over them. None where there are no vectors.

    Null vectors and those without dimensions are left out; vectors of different lengths
    are an error. Repeated rows count each time. Only components with a variance above
    that of rounding are kept, so constant or dependent dimensions give fewer of them.
    """
    rows = df.select(F.col(vector).alias("x")).filter(F.size("x") > 0)
    n, total = sums(rows)
    if not n:
        return None
    mean = np.array([s / n for s in total])
    v = covariance(rows, n, lambda x: x - mean, len(total))
    e, vectors = components(v, wanted)
    model = Whitening(n, total, e, vectors, float(np.trace(v)), 0.0)
    if not len(e):
        return model
    error = np.abs(covariance(rows, n, model.apply, len(e)) - np.eye(len(e))).max()
    return Whitening(n, total, e, vectors, model.trace, float(error))


def whiten(df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "x") -> DataFrame:
    """(key, deviation decimal(38), whitened array<double>) of each row that has a vector.

    ``deviation`` is the exact sum over the dimensions of (n x - sum)^2. Null and repeated
    keys stay, other columns are left out. An empty table gives an empty one.
    """
    kind = df.schema[key].dataType
    n, total = model.n, np.array(model.sums, object)
    exact = T.DecimalType(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column(1))
            most = max(abs(n * int(v) - s) for side in (x.min(0), x.max(0)) for v, s in zip(side, model.sums))
            if most * most * x.shape[1] < 1 << 63 and n * int(np.abs(x).max()) < 1 << 63:
                deviation = pa.array(((n * x - np.array(model.sums, np.int64)) ** 2).sum(1)).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([Decimal(int(v)) for v in ((n * x.astype(object) - total) ** 2).sum(1)], pa.decimal128(38, 0))
            y = model.apply(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], names=["key", "deviation", "whitened"])

    schema = T.StructType().add("key", kind).add("deviation", exact).add("whitened", T.ArrayType(T.DoubleType()))
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("x")).filter(F.size("x") > 0)
    return rows.mapInArrow(lean(run), schema).withColumnRenamed("key", key)
