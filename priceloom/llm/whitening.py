"""Whitening of vectors: decorrelated components of unit variance.

Sums over the distinct vectors are exact integers, so centring loses nothing to the vectors' common offset.
Every task multiplies its centred vectors into one small matrix; only these are added up. The scatter is
factored by Cholesky with pivoting, and one-sided Jacobi rotations make the columns of the triangular factor
orthogonal: their squared lengths are the eigenvalues, the normalised columns the components. Small
eigenvalues stay accurate, as the scatter itself is never rotated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from priceloom.session import settle

_EPS = float(np.finfo(float).eps)
#: Sums of doubles are added as integers of 30 digits: no order of tasks changes them.
_UNITS = 10.0**30


# --- the factorisation, of a dimension x dimension matrix --------------------------------------------


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order): ``scatter[order][:, order]`` is ``factor @ factor.T``, with one column per rank.

    The largest remaining diagonal entry comes next; below rounding of the first one the rest is zero.
    """
    rest, size = np.array(scatter, float), len(scatter)
    factor, order = np.zeros((size, size)), np.arange(size)
    least = 16 * size * _EPS * rest.diagonal().max(initial=0.0)
    for k in range(size):
        at = k + int(rest.diagonal()[k:].argmax())
        if rest[at, at] <= least:
            return factor[:, :k], order
        for whole in (rest, rest.T, factor, order):
            whole[[k, at]] = whole[[at, k]]
        column = rest[k:, k] / np.sqrt(rest[k, k])
        factor[k:, k] = column
        rest[k + 1 :, k + 1 :] -= np.outer(column[1:], column[1:])
    return factor, order


def _pairings(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which all pairs of ``size`` columns meet once."""
    seats = list(range(size + size % 2))
    half = len(seats) // 2
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[:half], seats[:half - 1 : -1], strict=True) if max(a, b) < size]
        if pairs:
            yield tuple(np.array(pairs).T)
        seats.insert(1, seats.pop())


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times a rotation, with orthogonal columns. A round turns all its pairs of columns at once."""
    turned, size = np.array(factor, float), factor.shape[1]
    enough = max(factor.shape) * _EPS
    for _ in range(sweeps):
        still = True
        turned = turned[:, np.argsort(-(turned**2).sum(axis=0), kind="stable")]
        for i, j in _pairings(size):
            a, b = turned[:, i], turned[:, j]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            skew = np.abs(ab) > enough * np.sqrt(aa * bb)
            if not skew.any():
                continue
            still = False
            i, j, a, b = i[skew], j[skew], a[:, skew], b[:, skew]
            ratio = (bb - aa)[skew] / (2 * ab[skew])
            tangent = np.where(ratio < 0, -1.0, 1.0) / (np.abs(ratio) + np.hypot(1.0, ratio))
            cosine = 1 / np.hypot(1.0, tangent)
            turned[:, i], turned[:, j] = cosine * a - cosine * tangent * b, cosine * tangent * a + cosine * b
        if still:
            return turned
    raise RuntimeError(f"columns not orthogonal after {sweeps} sweeps")


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of a positive semidefinite matrix, falling; none for its null space.

    Of both signs of a vector the one whose largest entry is positive.
    """
    factor, order = pivoted_cholesky(scatter)
    if not factor.shape[1]:
        return np.zeros(0), np.zeros((len(scatter), 0))
    turned = one_sided_jacobi(factor)
    values = (turned**2).sum(axis=0)
    falling = np.argsort(-values, kind="stable")
    vectors = np.empty_like(turned)
    vectors[order] = turned / np.sqrt(values)
    vectors = vectors[:, falling]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[falling], vectors * sign


# --- the distributed sums ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Centre:
    """``n`` distinct vectors, their exact sums, and bounds of their entries per dimension."""

    n: int
    sums: tuple[int, ...]
    low: tuple[int, ...]
    high: tuple[int, ...]

    @property
    def reach(self) -> int:
        """No entry of n * x - S is further from zero."""
        return max(max(self.n * h - s, s - self.n * l) for s, l, h in zip(self.sums, self.low, self.high, strict=True))

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit integers where they hold it, else Python's."""
        near = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s - self.n * (s // self.n) for s in self.sums]
        small = self.reach + 2 * self.n < 1 << 62
        kind = np.int64 if small else object
        return (x - near).astype(kind) * (self.n if small else int(self.n)) - np.array(rest, kind)

    def deviations(self, offsets: np.ndarray) -> pa.Array:
        """Sums of squared offsets, exact."""
        kind = pa.decimal128(38, 0)
        if offsets.dtype != object and len(self.sums) * self.reach**2 < 1 << 63:
            return pa.array((offsets * offsets).sum(axis=1)).cast(kind)
        return pa.array([Decimal(sum(int(v) ** 2 for v in row)) for row in offsets], kind)


@dataclass(frozen=True)
class Whitening:
    """``components`` (dimension x k) with the eigenvalues of the covariance, falling, and its trace."""

    centre: Centre
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = float("nan")

    def whiten(self, offsets: np.ndarray) -> np.ndarray:
        return (offsets / self.centre.n).astype(float) @ (self.components / np.sqrt(self.values))


def whole_numbers(vector: Column, scale: float = 64.0, shift: int = 1_000_000) -> Column:
    """floor(scale * c) + shift of each entry, as long. Raises beyond 2 ** 52, where doubles have gaps."""

    def whole(entry: Column) -> Column:
        scaled = entry.cast("double") * scale
        too_large = F.raise_error(F.lit("vector entry too large for an exact whole number")).cast("long")
        return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled) + shift).otherwise(too_large)

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    """Neither null nor empty, every entry there and finite."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def _matrices(batches: Iterator[pa.RecordBatch], column: int, rows: int = 2_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Some rows at a time, with their vectors as one matrix of 64-bit integers."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part, part.column(column).flatten().to_numpy().reshape(part.num_rows, -1)


def centre_of(distinct: DataFrame) -> Centre | None:
    """Count, exact sums and bounds of vectors (x: array<long>); ``None`` without any.

    One row per dimension and task is added up. Vectors of different lengths raise ValueError.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, upper, lower, n = None, None, 0, 0, 0
        for part, x in _matrices(batches, 0):
            ends = (x.min(axis=0), x.max(axis=0))
            low, high = ends if low is None else (np.minimum(low, ends[0]), np.maximum(high, ends[1]))
            # In halves, so that no sum of 64-bit integers overflows.
            upper, lower, n = upper + (x >> 26).sum(axis=0), lower + (x & (1 << 26) - 1).sum(axis=0), n + len(x)
        if n:
            columns = [np.arange(len(low)), np.full(len(low), n), upper, lower, low, high]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["position", "n", "upper", "lower", "low", "high"]
    lengths = distinct.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if lengths[0] is None:
        return None
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors of {lengths[0]} to {lengths[1]} entries")
    parts = distinct.select("x").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    found = parts.groupBy("position").agg(
        F.sum("n"), (exact("upper") * (1 << 26) + exact("lower")).cast("decimal(38,0)"), F.min("low"), F.max("high")
    )
    rows = sorted(found.collect())
    return Centre(rows[0][1], *(tuple(int(r[i]) for r in rows) for i in (2, 3, 4)))


def _mean_products(distinct: DataFrame, n: int, rows_of: Callable[[np.ndarray], np.ndarray], bound: float) -> np.ndarray:
    """Mean of v v' over all vectors, v being ``rows_of`` them; no entry of v is larger than ``bound``.

    Every task sends one matrix, entry by entry; whatever order they come in, the sum is the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches, 0):
            v = rows_of(x)
            total = v.T @ v if total is None else total + v.T @ v
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "part"])

    parts = distinct.select("x").mapInArrow(run, "i long, j long, part double")
    units = (F.col("part") / F.lit(bound) / F.lit(bound) / F.lit(float(n)) * F.lit(_UNITS)).cast("decimal(38,0)")
    found = parts.groupBy("i", "j").agg(F.sum(units).alias("total")).collect()
    size = 1 + max(r["i"] for r in found)
    out = np.empty((size, size))
    for r in found:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = float(r["total"]) / _UNITS * bound * bound
    return out


def fit(vectors: DataFrame, components: int = 16) -> Whitening | None:
    """The whitening of vectors (x: array<long>), each distinct one counted once; ``None`` without any.

    Copies are dropped in every task before they are shuffled. What reaches the driver are sums per
    dimension and pair of dimensions. At most ``components``, fewer where the vectors span less.
    """
    distinct = settle(vectors.select("x").distinct(), "distinct")
    centre = centre_of(distinct)
    if centre is None:
        return None
    n = centre.n
    centred = lambda x: (centre.offsets(x) / n).astype(float)
    spread = centre.reach / n
    if not spread:
        return Whitening(centre, np.zeros(0), np.zeros((len(centre.sums), 0)), 0.0)
    covariance = _mean_products(distinct, n, centred, spread)
    values, found = eigen(covariance)
    model = Whitening(centre, values[:components], found[:, :components], float(np.trace(covariance)))
    bound = spread * len(centre.sums) / float(np.sqrt(model.values[-1]))
    whitened = _mean_products(distinct, n, lambda x: model.whiten(centre.offsets(x)), bound)
    error = float(np.abs(whitened - np.eye(len(whitened))).max())
    return Whitening(centre, model.values, model.components, model.trace, error)


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0,
           shift: int = 1_000_000, components: int = 16) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of each vector and component.

    Entries become whole numbers x = floor(scale * c) + shift first. ``n`` distinct x have sums S;
    ``deviation`` (decimal) is the exact sum of (n * x - S) ** 2, ``whitened`` the projection of x - S / n on
    the component over the root of its eigenvalue, ``explained`` the eigenvalue's share of the trace, and
    ``identity_error`` the largest entry by which the covariance of the whitened x misses the identity.

    Vectors that are null, empty or hold null or non-finite entries are left out. Repeated rows each come out,
    null keys too; other columns are ignored. Fewer components exist where the vectors span less, and none,
    so no row, where all are equal or the table is empty. Vectors of different lengths raise ValueError.
    """
    rows = vectors.where(usable(F.col(vector))).select(
        F.col(key).alias("key"), whole_numbers(F.col(vector), scale, shift).alias("x")
    )
    model = fit(rows, components)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for part, x in _matrices(batches, 1):
            count = len(x)
            again = pa.array(np.repeat(np.arange(count), k))
            offsets = model.centre.offsets(x)
            told = [
                part.column(0).take(again),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                pa.array(np.full(count * k, model.centre.n)),
                model.centre.deviations(offsets).take(again),
                pa.array(model.whiten(offsets).ravel()),
                pa.array(np.tile(model.values / model.trace, count)),
                pa.array(np.full(count * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(told, names)

    names = [part.split()[0] for part in schema.split(", ")]
    if model is None or not len(model.values):
        found = vectors.sparkSession.createDataFrame([], schema)
    else:
        found = rows.mapInArrow(run, schema)
    return found.withColumnRenamed("key", key)
