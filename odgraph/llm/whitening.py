"""Whitening of vectors on the leading components of their covariance.

Every vector becomes integers, ``x = floor(256 * c)``.  The covariance is over
the distinct integer vectors.  Its sums are exact: Spark tasks add up whole
numbers of vectors centred at the rounded mean (double-precision products stay
below 2**53, or Python's integers take over), and the remaining shift of less
than a unit is taken out in exact arithmetic before the only rounding.

The leading components come from slicing the spectrum.  The inertia of
``V - s*I``, read off an LDL^T factorisation with symmetric pivoting, counts
the eigenvalues above s; bisection with that count isolates one eigenvalue (or
a cluster that double precision does not separate), Rayleigh quotient
iteration then converges cubically, and counts just below and above certify
that the value has the number it was given.

The driver holds d x d numbers, with d at most ``MAX_DIMS``.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odgraph.llm.common import cut

SCALE = 256
COMPONENTS = 4
MAX_DIMS = 1024
_EPS = np.finfo(np.float64).eps
#: Eigenvalues nearer than this share of the largest are taken together.
CLUSTER = 1e-11
#: Eigenvalues nearer than this have their vectors made orthogonal together.
NEAR = 1e-5
#: Share of the largest eigenvalue below which a component counts as flat.
FLAT = 1e-13
_PART = 1 << 60


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, zero and negative eigenvalues of a symmetric matrix:
    the signs of D in LDL^T with pivots of one or two rows (Bunch and Kaufman)."""
    a = np.array(a, dtype=np.float64)
    n, k = len(a), 0
    signs = [0, 0, 0]
    alpha = (1 + 17 ** 0.5) / 8

    def swap(i, j):
        if i != j:
            a[[i, j], k:] = a[[j, i], k:]
            a[k:, [i, j]] = a[k:, [j, i]]

    def count(value):
        signs[0 if value > 0 else 1 if value == 0 else 2] += 1

    while k < n:
        below = np.abs(a[k + 1:, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        most = below[r - k - 1] if len(below) else 0.0
        single = True
        if abs(a[k, k]) < alpha * most:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            other = row.max()
            if abs(a[k, k]) * other < alpha * most * most:
                single = abs(a[r, r]) >= alpha * other
                swap(k if single else k + 1, r)
        if single:
            count(a[k, k])
            if a[k, k] != 0 and k + 1 < n:
                column = a[k + 1:, k].copy()
                a[k + 1:, k + 1:] -= np.outer(column, column / a[k, k])
            k += 1
        else:
            p, q, s = a[k, k], a[k + 1, k], a[k + 1, k + 1]
            det = (p / q) * (s / q) - 1  # of the pivot over its squared off-diagonal
            if det < 0:
                signs[0] += 1
                signs[2] += 1
            else:
                count(p + s)
                count(p + s)
            if k + 2 < n:
                columns = a[k + 2:, k:k + 2].copy()
                a[k + 2:, k + 2:] -= columns @ np.linalg.solve(np.array([[p, q], [q, s]]), columns.T)
            k += 2
    return tuple(signs)


def _solve(a: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    eye = np.eye(len(a))
    for nudge in (0.0, 4.0, 64.0):
        try:
            y = np.linalg.solve(a - (shift + nudge * _EPS * scale) * eye, right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    return right


def leading(v: np.ndarray, number: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` largest eigenvalues (falling) of a covariance and their unit
    eigenvectors in columns; flat components have value 0 and a zero column."""
    d = len(v)
    number = min(number, d)
    values, vectors = np.zeros(number), np.zeros((d, number))
    scale = float(np.abs(v).sum(axis=1).max()) if d else 0.0
    if scale == 0 or not np.isfinite(scale):
        return values, vectors
    eye = np.eye(d)
    counts: dict[float, int] = {}

    def above(x):
        if x not in counts:
            counts[x] = inertia(v - x * eye)[0]
        return counts[x]

    flat = FLAT * scale
    rank = above(flat)
    slack = 256 * _EPS * scale
    k = 1
    while k <= min(number, rank):
        low = max((x for x, c in counts.items() if c >= k), default=flat)
        high = min((x for x, c in counts.items() if c < k and x > low), default=scale * (1 + 1e-9))
        found = None
        while found is None:
            together = above(low) - above(high)
            if together > 1 and high - low > CLUSTER * scale or high - low > 0.05 * high:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= k else (low, middle)
                continue
            found = _pairs(v, low, high, together, vectors[:, :k - 1], scale, slack)
            if found is None:
                if high - low <= slack:
                    raise ArithmeticError("an eigenvalue could not be isolated")
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= k else (low, middle)
        for e, x in zip(*found):
            if k > number:
                break
            if not above(e + slack) < k <= above(e - slack):
                raise ArithmeticError(f"component {k} has another number by its count")
            values[k - 1], vectors[:, k - 1] = e, x
            k += 1
    # near eigenvalues: orthogonal vectors of the space that they span together
    live = int((values > 0).sum())
    first = 0
    for end in range(1, live + 1):
        if end == live or values[end - 1] - values[end] > NEAR * scale:
            if end - first > 1:
                values[first:end], vectors[:, first:end] = _ritz(v, vectors[:, first:end])
            first = end
    for j in range(live):
        x = vectors[:, j]
        vectors[:, j] = x * (1 if x[np.abs(x).argmax()] > 0 else -1)
    return values, vectors


def _ritz(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and vectors inside the space of the columns of ``x``."""
    x = np.linalg.qr(x)[0]
    small = x.T @ v @ x
    inside, turn = np.linalg.eigh((small + small.T) / 2)
    return inside[::-1], x @ turn[:, ::-1]


def _pairs(v, low, high, together, before, scale, slack):
    """The ``together`` eigenpairs between two shifts, or None where the iteration
    leaves the interval."""
    d = len(v)
    x = np.sin(np.arange(1, d * together + 1, dtype=np.float64) ** 1.5).reshape(together, d).T
    for _ in range(3):
        x -= before @ (before.T @ x)
        x = np.linalg.qr(_solve(v, (low + high) / 2, np.linalg.qr(x)[0], scale))[0]
    if together == 1:
        x = x[:, 0]
        for _ in range(30):
            e = float(x @ v @ x)
            rest = v @ x - e * x
            if np.linalg.norm(rest) <= 4 * _EPS * scale:
                break
            y = _solve(v, e, x, scale)
            x = y / np.linalg.norm(y)
        if not low - slack <= e <= high + slack or np.linalg.norm(rest) > slack:
            return None
        return [e], [x]
    # a cluster: the invariant space by inverse iteration, then the pairs inside it
    for _ in range(6):
        x -= before @ (before.T @ x)
        x = np.linalg.qr(_solve(v, (low + high) / 2, np.linalg.qr(x)[0], scale))[0]
    e, x = _ritz(v, x)
    if np.linalg.norm(v @ x - x * e, axis=0).max() > slack + (high - low):
        return None
    return list(map(float, e)), list(x.T)


@dataclass
class Whitening:
    """What vectors are whitened with; ``sums`` are exact."""

    dims: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def __post_init__(self):
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(self.dims)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows (nan for flat components)."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, (x - self.mean) @ self.vectors / np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of ``(n * x - S) ** 2`` of every integer row, exact."""
        most = max([int(np.abs(x.astype(object)).max()) if x.size else 0, *map(abs, self.sums)]) if x.size else 0
        widest = self.n * most + max(map(abs, self.sums), default=0)
        if widest * widest * max(self.dims, 1) < 1 << 63:
            return ((self.n * x - np.array(self.sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((self.n * int(c) - s) ** 2 for c, s in zip(row, self.sums)) for row in x]


def integers(vec_col: str) -> Column:
    """``floor(256 * c)`` of every entry; null for a vector that is null, empty or
    has an entry that is null or not finite."""
    fine = F.forall(vec_col, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    whole = F.transform(vec_col, lambda c: F.floor(c.cast("double") * SCALE))
    return F.when(fine & (F.size(vec_col) > 0), whole)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


def _totals(rows: DataFrame, dims: int, block) -> dict[int, int]:
    """Exact sums over all rows of the numbers that ``block(x)`` gives for rows x
    of ``x`` (an object array); Spark adds them up by place."""

    def work(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = block(_matrix(batch.column(0), dims))
                total = part if total is None else total + part
        if total is not None:
            flat = [int(t) for t in total.ravel()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(flat)), pa.int32()),
                 pa.array([Decimal(t // _PART) for t in flat], pa.decimal128(38, 0)),
                 pa.array([Decimal(t % _PART) for t in flat], pa.decimal128(38, 0))], ["place", "high", "low"])

    parts = rows.select("x").mapInArrow(work, "place int, high decimal(38,0), low decimal(38,0)")
    sums = parts.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {r["place"]: int(r["high"]) * _PART + int(r["low"]) for r in sums.collect()}


def _gram(z: np.ndarray) -> np.ndarray:
    """Exact products of the columns of integer rows."""
    most = int(np.abs(z).max()) if z.size and z.dtype != object else 1 << 62
    if most < 1 << 22:
        step = max(1, (1 << 53) // max(most * most, 1))
        out = np.zeros((z.shape[1], z.shape[1]), dtype=object)
        for at in range(0, len(z), step):
            part = z[at:at + step].astype(np.float64)
            out = out + (part.T @ part).astype(np.int64)
        return out
    z = z.astype(object)
    return z.T @ z


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Learn from the distinct integer vectors of the commonest length (the
    smaller of equally common ones).  The driver receives one row a length,
    ``dims`` sums and ``dims ** 2`` products."""
    x = vectors.select(integers(vec_col).alias("x")).where("x is not null")
    distinct = cut(x.distinct(), "whitening-distinct")
    sizes = distinct.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "dims").first()
    if common is None:
        return Whitening(0, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    dims, n = common["dims"], common["n"]
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of more than {MAX_DIMS} entries")
    rows = distinct.where(F.size("x") == dims)
    found = _totals(rows, dims, lambda a: a.astype(object).sum(axis=0) if np.abs(a.astype(np.float64)).max() >= 2.0 ** 31
                    else a.sum(axis=0).astype(object))
    sums = [found[i] for i in range(dims)]
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def centred(a):
        wide = max(map(abs, centre)) >= 1 << 40 or np.abs(a.astype(np.float64)).max() >= 2.0 ** 40
        return _gram(a.astype(object) - np.array(centre, dtype=object) if wide else a - np.array(centre, dtype=np.int64))

    products = _totals(rows, dims, centred)
    left = [s - n * c for s, c in zip(sums, centre)]
    v = np.array([[(n * products[i * dims + j] - left[i] * left[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    values, axes = leading(v, components)
    model = Whitening(dims, n, sums, values, axes, float(np.trace(v)))
    model.identity_error = _identity_error(rows, model)
    return model


def _identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened fit vectors' covariance minus the identity."""
    live = np.flatnonzero(model.values > 0)
    k = len(live)
    if not k:
        return None
    held = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        total = np.zeros(k + k * k)
        for batch in batches:
            w = held.value.project(_matrix(batch.column(0), held.value.dims))[:, live]
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["place", "value"])

    sums = rows.select("x").mapInArrow(work, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.array([r["value"] for r in sums.orderBy("place").collect()]) / model.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding",
           carry: tuple[Column, ...] = ()) -> DataFrame:
    """One row for each vector and component: the id, the columns in ``carry``,
    ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``
    and ``identity_error``.

    Vectors that are null, empty, of another length than the model's or hold a
    null or non-finite entry have no rows; repeated rows and null ids stay; an
    empty table gives an empty one.  ``whitened`` is null for a component
    without spread, ``explained`` where no vector has any, ``deviation`` where
    it passes 64 bits.
    """
    held = vectors.sparkSession.sparkContext.broadcast(model)
    rows = vectors.select(F.col(id_col), *carry, integers(vec_col).alias("_x")).where(F.size("_x") == model.dims)
    last = len(rows.columns) - 1
    added = T.StructType([T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                          T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                          T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])

    def work(batches):
        m = held.value
        k = len(m.values)
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _matrix(batch.column(last), m.dims)
            each = batch.select(list(range(last))).take(pa.array(np.repeat(np.arange(batch.num_rows), k)))
            deviation = [y if y < 1 << 63 else None for y in m.deviations(x)]
            whitened = m.project(x).ravel()
            size = len(whitened)
            explained = m.values / m.trace if m.trace > 0 else np.full(k, np.nan)
            yield pa.RecordBatch.from_arrays(
                [*each.columns, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                 pa.array(np.full(size, m.n, dtype=np.int64)),
                 pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(batch.num_rows), k))),
                 pa.array(whitened, from_pandas=True), pa.array(np.tile(explained, batch.num_rows), from_pandas=True),
                 pa.array([m.identity_error] * size, pa.float64())], [*each.schema.names, *added.names])

    return rows.mapInArrow(work, T.StructType([*rows.schema.fields[:last], *added.fields]))
