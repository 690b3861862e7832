"""Embedding whitening by incremental eigendecomposition.

Each task keeps the spectrum (number, mean, eigenvalues and eigenvectors of the scatter) of the rows it has seen. A centred
row changes it by a rank-one term: the new eigenvalues are the roots of a secular equation, the eigenvectors follow in
closed form, and what a term doesn't touch (no share in it, or an eigenvalue shared with another) is deflated. A second
spectrum is taken in by one such update for each of its eigenvectors and one for the shift of the mean, in a tree of
tasks. The last step projects all rows on the basis found and solves the small problem that is left (Rayleigh-Ritz).

Entries are counted in 64ths, as integers, so sums and deviations are exact.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.session import materialise

COMPONENTS = 16
#: Entries become floor(STEP * entry) + OFFSET; beyond EXACT a double isn't exact.
STEP, OFFSET, EXACT = 64, 1_000_000, 1 << 53
#: Rows centred together; more rows than dimensions are first rotated into as many rows with the same scatter.
BLOCK = 4_096
#: Partial results that one task takes in.
FAN_IN = 32
#: Components below this share of the first eigenvalue count as empty.
EMPTY = 1e-12
#: Rayleigh-Ritz steps at most, and the deviation from the identity at which they end.
STEPS, GOOD = 3, 1e-9
_EPS = float(np.finfo(float).eps)


# --- one rank-one update

def secular_roots(poles: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots r of 1 + sum(weight / (poles - r)) = 0, and poles - r for each root (rows) and pole (columns).

    ``poles`` rise strictly and weights are positive, so one root lies behind each pole. It is sought from the nearer of
    its two poles, by a rational model with these poles that bisection guards.
    """
    k = len(poles)
    total = weight.sum()
    after = np.append(poles[1:], poles[-1] + total)
    half = (after - poles) / 2
    low_half = 1 + (weight / (poles - (poles + half)[:, None])).sum(1) >= 0
    near = low_half.copy()
    near[-1] = True
    delta = poles - np.where(near, poles, after)[:, None]
    low, high = np.where(near, 0.0, -half), np.where(near, half, 0.0)
    if not low_half[-1]:
        low[-1], high[-1] = half[-1], 2 * half[-1]
    at = (low + high) / 2
    i = np.arange(k)
    lower = np.tri(k)
    for _ in range(100):
        gap = delta - at[:, None]
        part = weight / gap
        value = 1 + part.sum(1)
        over = value > 0
        high, low = np.where(over, at, high), np.where(over, low, at)
        if np.all((np.abs(value) <= 8 * _EPS * (1 + np.abs(part).sum(1))) | (high - low <= 2 * _EPS * np.abs(at))):
            break
        slope = part / gap
        below = (slope * lower).sum(1)
        every = slope.sum(1)
        left, right = gap[i, i], gap[i, np.minimum(i + 1, k - 1)]
        c = value - left * below - right * (every - below)
        a = (left + right) * value - left * right * every
        b = left * right * value
        with np.errstate(all="ignore"):
            root = np.sqrt(np.abs(a * a - 4 * b * c))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = left[-1] + left[-1] ** 2 * every[-1] / (value[-1] - left[-1] * every[-1])
            new = at + step
            at = np.where((new > low) & (new < high), new, (low + high) / 2)
    gap = delta - at[:, None]
    return np.where(near, poles, after) + at, np.where(gap == 0, np.finfo(float).tiny, gap)


def _deflated(values: np.ndarray, basis: np.ndarray, z: np.ndarray, least: float) -> np.ndarray:
    """The places that take part in the update; equal eigenvalues are rotated (in place) so that only one of them does.

    What changes the matrix by no more than ``least`` is left out.
    """
    keep = np.flatnonzero(np.abs(z) * np.sqrt(z @ z) > least)
    if len(keep) < 2:
        return keep
    x, y = z[keep[:-1]], z[keep[1:]]
    if np.all(np.abs(np.diff(values[keep]) * x * y / (x * x + y * y)) > least):
        return keep
    stay, last = [], keep[0]
    for j in keep[1:]:
        norm = float(np.hypot(z[last], z[j]))
        c, s = z[j] / norm, z[last] / norm
        if abs((values[j] - values[last]) * c * s) > least:
            stay.append(last)
        else:
            old, new = basis[:, last].copy(), basis[:, j].copy()
            basis[:, last], basis[:, j] = c * old - s * new, s * old + c * new
            lower, upper = values[last], values[j]
            values[last], values[j] = c * c * lower + s * s * upper, s * s * lower + c * c * upper
            z[last], z[j] = 0.0, norm
        last = j
    return np.array([*stay, last])


def rank_one(values: np.ndarray, basis: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of basis @ diag(values) @ basis.T + outer(term, term)."""
    values, basis, z = values.copy(), basis.copy(), basis.T @ term
    size = float(z @ z)
    if size == 0:
        return values, basis
    keep = _deflated(values, basis, z, 8 * _EPS * max(float(np.abs(values).max()), size))
    if not len(keep):
        return values, basis
    keep = keep[np.argsort(values[keep], kind="stable")]
    poles = values[keep]
    while len(keep) > 1 and np.any(np.diff(poles) <= 0):  # equal after rotation: part them by the least there is
        poles = np.maximum.accumulate(np.where(np.append(False, np.diff(poles) <= 0), np.nextafter(poles, np.inf), poles))
    roots, gap = secular_roots(poles, z[keep] ** 2)
    # the term for which these roots are exact; eigenvectors made from it are orthogonal
    apart = poles[:, None] - poles
    np.fill_diagonal(apart, 1.0)
    own = np.sqrt(np.abs(np.prod(-gap / apart, axis=0)))
    vectors = np.copysign(own, z[keep])[:, None] / gap.T
    vectors /= np.sqrt((vectors ** 2).sum(0))
    values[keep], basis[:, keep] = roots, basis[:, keep] @ vectors
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


class Spectrum:
    """Number, mean, and eigenvalues and eigenvectors of the scatter of some rows."""

    def __init__(self, dims: int):
        self.n, self.mean = 0, np.zeros(dims)
        self.values, self.basis = np.zeros(dims), np.eye(dims)

    def _take(self, n: int, mean: np.ndarray, terms) -> None:
        shift = (mean - self.mean) * np.sqrt(self.n * n / (self.n + n))
        for term in [*terms, shift]:
            self.values, self.basis = rank_one(self.values, self.basis, term)
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add(self, rows: np.ndarray) -> None:
        """Rows as centred rank-one updates."""
        for start in range(0, len(rows), BLOCK):
            block = rows[start:start + BLOCK]
            mean = block.mean(0)
            terms = block - mean
            if len(terms) > len(mean):
                terms = np.linalg.qr(terms, mode="r")
            self._take(len(block), mean, terms)

    def join(self, other: Spectrum) -> None:
        if other.n:
            self._take(other.n, other.mean, (other.basis * np.sqrt(np.maximum(other.values, 0))).T)

    def packed(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.values, self.basis.ravel()]).tobytes()

    @staticmethod
    def unpacked(data: bytes, dims: int) -> Spectrum:
        flat, own = np.frombuffer(data), Spectrum(dims)
        own.n, own.mean, own.values = int(flat[0]), flat[1:dims + 1], flat[dims + 1:2 * dims + 1]
        own.basis = flat[2 * dims + 1:].reshape(dims, dims)
        return own


# --- what tasks send, and how it comes together

def _matrix(column, dims: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def _one(state: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"state": pa.array([state], pa.binary())})


def _together(parts: DataFrame, merge) -> bytes | None:
    """The merge of all states in ``parts``; tasks take in FAN_IN of them at a time, the driver the last few."""
    def run(batches):
        found = None
        for batch in batches:
            for state in batch.column(0).to_pylist():
                found = state if found is None else merge(found, state)
        if found is not None:
            yield _one(found)

    parts = materialise(parts, "states")
    left = parts.count()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        parts = materialise(parts.repartition(left).mapInArrow(run, "state binary"), "states")
    found = None
    for row in parts.collect():
        found = bytes(row[0]) if found is None else merge(found, bytes(row[0]))
    return found


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension."""
    def run(batches):
        n, total = 0, [0] * dims
        for batch in batches:
            rows = _matrix(batch.column(0), dims)
            n += len(rows)
            high, low = (rows >> 32).sum(0).tolist(), (rows & 0xFFFFFFFF).sum(0).tolist()
            total = [t + (h << 32) + w for t, h, w in zip(total, high, low)]
        yield _one(json.dumps([n, total]).encode())

    def merge(a, b):
        (n, x), (m, y) = json.loads(a), json.loads(b)
        return json.dumps([n + m, [p + q for p, q in zip(x, y)]]).encode()
    found = _together(fit.select("x").mapInArrow(run, "state binary"), merge)
    return tuple(json.loads(found)) if found else (0, [0] * dims)


def _spectrum(fit: DataFrame, dims: int, middle: np.ndarray) -> Spectrum:
    def run(batches):
        own = Spectrum(dims)
        for batch in batches:
            own.add((_matrix(batch.column(0), dims) - middle).astype(float))
        if own.n:
            yield _one(own.packed())

    def merge(a, b):
        own = Spectrum.unpacked(a, dims)
        own.join(Spectrum.unpacked(b, dims))
        return own.packed()
    return Spectrum.unpacked(_together(fit.select("x").mapInArrow(run, "state binary"), merge), dims)


def _projected(fit: DataFrame, dims: int, middle: np.ndarray, rest: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """basis.T @ scatter @ basis over the centred rows."""
    def run(batches):
        total = np.zeros((basis.shape[1],) * 2)
        for batch in batches:
            own = (_matrix(batch.column(0), dims) - middle - rest) @ basis
            total += own.T @ own
        yield _one(total.tobytes())

    def merge(a, b):
        return (np.frombuffer(a) + np.frombuffer(b)).tobytes()
    found = _together(fit.select("x").mapInArrow(run, "state binary"), merge)
    return np.frombuffer(found).reshape(basis.shape[1], -1)


# --- fit and transform

def counted(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows whose vector is whole: x = floor(64 * entry) + 1000000 for each entry."""
    whole = F.forall(vector_col, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < EXACT // STEP))  # false for NaN
    x = F.transform(vector_col, lambda c: F.floor(c.cast("double") * STEP).cast("long") + F.lit(OFFSET).cast("long"))
    return (vectors.select(F.col(id_col).cast("long").alias(id_col), F.when(whole, x).alias("x")).where("x is not null"))


class Whitening:
    """A fitted transformation: components (columns of ``basis``), their eigenvalues, and exact sums of the fit list."""

    def __init__(self, n: int, sums: list[int], basis: np.ndarray, values: np.ndarray, trace: float, identity_error: float):
        self.n, self.sums, self.basis, self.values = n, sums, basis, values
        self.trace, self.identity_error = trace, identity_error


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers and what is left, so that centring keeps all digits."""
    return np.array([s // n for s in sums], dtype=np.int64), np.array([s % n for s in sums], dtype=float) / n


def _signed(basis: np.ndarray) -> np.ndarray:
    """Each component with its largest entry positive."""
    top = basis[np.argmax(np.abs(basis), axis=0), np.arange(basis.shape[1])]
    return basis * np.where(top < 0, -1.0, 1.0)


def fit(x: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the rows of ``x`` (column x, arrays of ``dims`` longs), each taken once; None without any row."""
    x = materialise(x.select("x").dropDuplicates(), "fit")
    n, sums = _sums(x, dims)
    if not n:
        return None
    middle, rest = _centre(n, sums)
    basis = np.linalg.qr(_spectrum(x, dims, middle).basis)[0]
    for _ in range(STEPS):
        values, turn = np.linalg.eigh(_projected(x, dims, middle, rest, basis) / n)
        basis = np.linalg.qr(basis @ turn)[0][:, ::-1]
        falling = values[::-1]
        there = int(np.count_nonzero(falling[:components] > EMPTY * max(falling[0], 0)))
        chosen, kept = _signed(basis[:, :there]), falling[:there]
        if not there:
            return Whitening(n, sums, chosen, kept, 0.0, 0.0)
        white = _projected(x, dims, middle, rest, chosen / np.sqrt(kept)) / n
        error = float(np.abs(white - np.eye(there)).max())
        if error <= GOOD:
            break
    return Whitening(n, sums, chosen, kept, float(values.sum()), error)


def _deviation(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - sum) ** 2 as exact integers; None where a long can't hold it."""
    most = max([abs(n * int(e) - s) for end in (rows.min(0), rows.max(0)) for e, s in zip(end, sums)], default=0)
    if most * most * rows.shape[1] < 1 << 63 and n * int(np.abs(rows).max()) < 1 << 62 and max(map(abs, sums)) < 1 << 62:
        return ((rows * n - np.array(sums, dtype=np.int64)) ** 2).sum(1).tolist()
    exact = [sum((n * e - s) ** 2 for e, s in zip(row, sums)) for row in rows.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def transform(x: DataFrame, fitted: Whitening, id_col: str = "vec_id") -> DataFrame:
    """One row for each row of ``x`` and component."""
    dims, size = len(fitted.sums), fitted.basis.shape[1]
    middle, rest = _centre(fitted.n, fitted.sums)
    turn = fitted.basis / np.sqrt(fitted.values)
    n, sums, share, error = fitted.n, fitted.sums, fitted.values / fitted.trace, fitted.identity_error

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(1), dims)
            white = (rows - middle - rest) @ turn
            every = np.repeat(np.arange(len(rows)), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(every)), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(rows))),
                 pa.array(np.full(len(every), n)), pa.array(_deviation(rows, n, sums), pa.int64()).take(pa.array(every)),
                 pa.array(white.ravel()), pa.array(np.tile(share, len(rows))), pa.array(np.full(len(every), error))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return x.select(id_col, "x").mapInArrow(run, f"{id_col} long, component int, n long, deviation long, whitened double, "
                                                 "explained double, identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error for each whole vector and component.

    Fitted on the different vectors, each once; repeated rows and rows without id are all transformed. A vector that is
    null, holds a null, NaN or infinite entry, or one of 2**47 or more, is dropped. So are vectors of another length than
    most (of two equally common lengths the larger counts). Components without variance are left out; vectors that are
    all the same have none, so there is no row. A deviation too large for a long is null. Other columns are ignored.
    """
    x = counted(vectors, id_col, vector_col)
    usual = x.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = usual["dims"] if usual else 0
    x = x.where(F.size("x") == dims)
    fitted = fit(x, dims, components) if dims else None
    if fitted is None or not len(fitted.values):
        fitted = Whitening(1, [0] * max(dims, 1), np.zeros((max(dims, 1), 0)), np.zeros(0), 1.0, 0.0)
        return transform(x.where("false"), fitted, id_col)
    return transform(x, fitted, id_col)
