"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Entries become floor(SCALE * entry) + SHIFT; SCALE * entry saturates at +-LIMIT.
SCALE, SHIFT, LIMIT = 64, 1_000_000, 1 << 61
#: Components returned, numbers held at a time by a task, sums collected by a task before it hands them on.
COMPONENTS, CELLS, SUMS = 32, 1 << 20, 1 << 22
LOW = (1 << 31) - 1
SWEEPS = 60


def integers(values: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000 as long."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * values), -float(LIMIT), float(LIMIT)).astype(np.int64) + SHIFT


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their integers) by length; rows without a usable vector are left out."""
    column = batch.column("vector")
    flat = column.flatten()
    size = np.where(np.asarray(column.is_valid()), np.asarray(column.value_lengths().fill_null(0)), 0).astype(np.int64)
    start = np.cumsum(size) - size
    values = np.asarray(flat.fill_null(np.nan)).astype(np.float64)
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    usable = (size > 0) & (bad[start + size] == bad[start])
    for d in np.unique(size[usable]).tolist():
        rows = np.flatnonzero(usable & (size == d))
        for at in range(0, len(rows), max(1, CELLS // d)):
            own = rows[at : at + max(1, CELLS // d)]
            yield own, integers(values[start[own][:, None] + np.arange(d)])


class Sums:
    """Sums of arrays by vector length, handed on as rows (size, at, columns...) that Spark adds up."""

    def __init__(self, names: list[str], kind: pa.DataType):
        self.names, self.kind, self.held = names, kind, {}

    def add(self, size: int, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = self.held.get(size)
        if own is None:
            if sum(len(a[0]) for a in self.held.values()) + len(arrays[0]) > SUMS:
                yield from self.rows()
            own = self.held[size] = [np.zeros_like(a) for a in arrays]
        for total, a in zip(own, arrays, strict=True):
            total += a

    def rows(self) -> Iterator[pa.RecordBatch]:
        held, self.held = self.held, {}
        for size, arrays in held.items():
            n = len(arrays[0])
            columns = [pa.array(np.full(n, size, np.int32)), pa.array(np.arange(n)), *(pa.array(a, self.kind) for a in arrays)]
            yield pa.RecordBatch.from_arrays(columns, ["size", "at", *self.names])


@dataclass
class Fit:
    """What whitens the vectors of one length: x - centre - shift, projected on `axes`."""

    n: int
    centre: np.ndarray  # long, near the mean
    rest: list[int]  # sum of x - centre
    values: np.ndarray  # eigenvalues, falling
    axes: np.ndarray  # (dimension, component), unit columns
    trace: float
    error: float | None = None

    def projection(self) -> np.ndarray:
        """Columns that whiten; components without variance give NaN."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, self.axes / np.sqrt(self.values), np.nan)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond the range of long."""
        z = x - self.centre
        most = self.n * max(int(z.max(initial=0)), -int(z.min(initial=0))) + max(map(abs, self.rest))
        if most * most * x.shape[1] < 1 << 63:
            d = self.n * z - np.array(self.rest, np.int64)
            return np.einsum("ij,ij->i", d, d).tolist()
        d = self.n * z.astype(object) - np.array(self.rest, object)
        return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """G with G G' = v: columns of a factor that is triangular in the order of its pivots; as many as the rank."""
    d = len(v)
    left, rest, order = np.zeros((d, d)), v.diagonal().copy(), np.arange(d)
    least = d * np.finfo(float).eps * max(rest.max(initial=0), 0)
    rank = 0
    for k in range(d):
        p = k + int(np.argmax(rest[order[k:]]))
        if not rest[order[p]] > least:
            break
        order[[k, p]] = order[[p, k]]
        at, below = order[k], order[k + 1 :]
        left[at, k] = np.sqrt(rest[at])
        left[below, k] = (v[below, at] - left[below, :k] @ left[at, :k]) / left[at, k]
        rest[below] -= left[below, k] ** 2
        rank += 1
    return left[:, :rank]


def rounds(n: int) -> list[np.ndarray]:
    """Every pair of n columns once, as rounds of disjoint pairs."""
    seats = list(range(n + n % 2))
    made = []
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[: len(seats) // 2], reversed(seats[len(seats) // 2 :]), strict=True) if max(a, b) < n]
        made.append(np.array([(min(p), max(p)) for p in pairs], np.int64).reshape(-1, 2))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return made


def one_sided_jacobi(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues of g g', falling; their unit vectors): rotate columns until all are orthogonal."""
    g = g.copy()
    n = g.shape[1]
    tolerance = max(4, len(g)) * np.finfo(float).eps
    turns = rounds(n) if n > 1 else []
    for _ in range(SWEEPS):
        g = g[:, np.argsort(-(g * g).sum(axis=0), kind="stable")]
        turned = False
        for pairs in turns:
            i, j = pairs[:, 0], pairs[:, 1]
            a, b = g[:, i], g[:, j]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            far = np.abs(ab) > tolerance * np.sqrt(aa * bb)
            if far.any():
                turned = True
                zeta = (bb - aa)[far] / (2 * ab[far])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                c = 1 / np.hypot(1, t)
                a, b = a[:, far], b[:, far]
                g[:, i[far]], g[:, j[far]] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    else:
        raise ArithmeticError(f"no convergence in {SWEEPS} sweeps")
    norms = np.sqrt((g * g).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, g[:, order] / norms[order]


def principal(v: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues and unit vectors of a covariance; 0 and completing vectors beyond its rank."""
    values, axes = one_sided_jacobi(pivoted_cholesky(v))
    rank, k = len(values), min(components, len(v))
    if rank < k:
        rest = np.linalg.qr(axes, mode="complete")[0][:, rank:] if rank else np.eye(len(v))
        values, axes = np.append(values, np.zeros(len(v) - rank)), np.concatenate([axes, rest], axis=1)
    axes = axes[:, :k]
    signs = np.where(axes[np.abs(axes).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    return values[:k], axes * signs


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))


def _added(rows: DataFrame, run, names: list[str], kind: str) -> dict[int, np.ndarray]:
    """Sums by size, position and name; what reaches the driver depends on the dimension only."""
    parts = rows.select("vector").mapInArrow(run, f"size int, at long, {', '.join(f'{n} {kind}' for n in names)}")
    table = parts.groupBy("size", "at").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    size, at = table.column("size").to_numpy(), table.column("at").to_numpy()
    held = np.array([table.column(n).to_numpy() for n in names])
    found = {}
    for s in np.unique(size).tolist():
        own = np.flatnonzero(size == s)
        found[s] = held[:, own[np.argsort(at[own])]]
    return found


def fitted(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Fit]:
    """A fit for each vector length, from all usable vectors of that length, in three passes of sums.

    Integers are centred on a whole number next to their mean before they are multiplied, and what is left of the
    mean is taken off exactly afterwards; sums of products are exact up to 2^53. The
    driver meets one d x d matrix for each length d.
    """
    rows = _rows(vectors, id_col, vector_col)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["n", "high", "low"], pa.int64())
        for batch in batches:
            for own, x in matrices(batch):
                yield from sums.add(x.shape[1], np.full(x.shape[1], len(own)), (x >> 31).sum(axis=0), (x & LOW).sum(axis=0))
        yield from sums.rows()

    fits = {}
    for d, (n, high, low) in _added(rows, first, ["n", "high", "low"], "long").items():
        n, total = int(n[0]), [int(h) * (LOW + 1) + int(w) for h, w in zip(high, low, strict=True)]
        centre = [(2 * t + n) // (2 * n) for t in total]
        fits[d] = Fit(n, np.array(centre, np.int64), [t - n * c for t, c in zip(total, centre, strict=True)], np.zeros(0), np.zeros((d, 0)), 0.0)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["product"], pa.float64())
        for batch in batches:
            for _, x in matrices(batch):
                z = (x - fits[x.shape[1]].centre).astype(np.float64)
                yield from sums.add(x.shape[1], (z.T @ z)[np.triu_indices(x.shape[1])])
        yield from sums.rows()

    for d, (products,) in _added(rows, second, ["product"], "double").items():
        fit, v = fits[d], np.zeros((d, d))
        v[np.triu_indices(d)] = products / fit.n
        rest = np.array([r / fit.n for r in fit.rest])
        v = v + np.triu(v, 1).T - np.outer(rest, rest)
        fit.values, fit.axes = principal(v, components)
        fit.trace = float(v.trace())

    def third(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["product"], pa.float64())
        for batch in batches:
            for _, x in matrices(batch):
                fit = fits[x.shape[1]]
                w = fit.centred(x) @ fit.projection()[:, fit.values > 0]
                yield from sums.add(x.shape[1], np.concatenate([w.sum(axis=0), (w.T @ w).ravel()]))
        yield from sums.rows()

    for d, (sums,) in _added(rows, third, ["product"], "double").items():
        fit = fits[d]
        k = int((fit.values > 0).sum())
        mean, second_moments = sums[:k] / fit.n, sums[k:].reshape(k, k) / fit.n
        if k:
            fit.error = float(np.abs(second_moments - np.outer(mean, mean) - np.eye(k)).max())
    return fits


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable vector and component.

    Vectors that are null or empty or hold a null or non-finite entry are left out; vectors of each
    length are a fit list of their own. 64 times an entry saturates at +-2^61. `deviation` is null beyond the range of
    long. Components beyond the rank (equal vectors, fewer vectors than dimensions) have
    explained 0 and a null `whitened`; identity_error is over the others, null if there are none.
    Null and repeated ids stay, repeated rows count as often as they come, an empty table
    gives no rows, further columns are ignored.
    """
    fits = fitted(vectors, id_col, vector_col, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for own, x in matrices(batch):
                fit = fits[x.shape[1]]
                k, step = len(fit.values), max(1, CELLS // (8 * max(1, len(fit.values))))
                explained = fit.values / fit.trace if fit.trace > 0 else np.zeros(k)
                for at in range(0, len(own), step):
                    part = x[at : at + step]
                    m = len(part)
                    w = fit.centred(part) @ fit.projection()
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(np.repeat(own[at : at + m], k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, fit.n)),
                            pa.array(fit.deviations(part), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(w.ravel(), from_pandas=True),
                            pa.array(np.tile(explained, m)), pa.array([fit.error] * (m * k), pa.float64()),
                        ],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    result = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return _rows(vectors, id_col, vector_col).mapInArrow(run, result)
