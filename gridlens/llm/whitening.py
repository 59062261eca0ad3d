"""Embedding whitening: leading principal components of integer-scaled vectors.

An entry c becomes ``floor(scale * c) + shift`` as a long. Dimension sums are
exact; the covariance (divisor n) is summed from centred rows, one d x d
partial matrix a task, added up row by row in a fixed order. The d x d
eigenproblem is solved on the driver (d is checked against ``MAX_DIMS``):
Householder reflections make the matrix tridiagonal, Sturm counts bisect its
leading eigenvalues, and inverse iteration gives their vectors, those of close
eigenvalues orthogonalised against each other. The components (d x k numbers)
are broadcast and every row is projected where it lies.

Defined cases: rows whose vector is null, holds a null, NaN or infinite entry
are dropped, also those whose length is not the most frequent one (of equally
frequent ones the longest) and empty vectors; scaled entries are held to
+-2^53; repeated rows and null ids each count; an empty table gives no rows; a
component without variance (eigenvalue at most d * 2^-52 of the largest) has a
null ``whitened``; ``deviation`` is null where it passes 64 bits, then
``deviation_approx`` tells it as a double. Other columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import materialize

SCALE, SHIFT = 1024, 100_000
#: Largest dimension: a task and the driver hold d x d doubles (128 MB).
MAX_DIMS = 4096
#: Partial matrices are added in groups of the tasks with equal id mod this.
FAN_IN = 1024
_LOW = np.int64((1 << 26) - 1)
_MOST = float(1 << 53)


@dataclass
class Whitening:
    """``vectors`` is d x k; ``values`` fall; ``sums`` are exact."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


# ---------------------------------------------------------- eigenvectors (driver)
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit Householder vectors of a symmetric matrix."""
    a, mirrors = np.array(a, np.float64), []
    for k in range(len(a) - 2):
        v = a[k + 1:, k].copy()
        alpha = -np.copysign(np.linalg.norm(v), v[0])
        v[0] -= alpha
        size = np.linalg.norm(v)
        v = v / size if size else np.zeros_like(v)
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = 2 * (p - (v @ p) * v)
        block -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = alpha
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def sturm_counts(diag: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Number of eigenvalues of the tridiagonal matrix below each ``x``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, float(np.max(off * off, initial=0.0)))
    q = diag[0] - x
    below = (q < 0).astype(np.int64)
    for d, e in zip(diag[1:], off):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d - x - e * e / q
        below += q < 0
    return below


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, bisected to neighbouring doubles."""
    reach = np.concatenate([[0], np.abs(off)]) + np.concatenate([np.abs(off), [0]])
    width = max(float(np.max(np.abs(diag) + reach)), np.finfo(float).tiny)
    lo, hi = np.full(k, float(np.min(diag - reach)) - width * 1e-12), np.full(k, float(np.max(diag + reach)) + width * 1e-12)
    rank = len(diag) - 1 - np.arange(k)  # ascending position of the wanted ones
    while True:
        mid = lo + (hi - lo) / 2
        open_ = (mid > lo) & (mid < hi) & (hi - lo > width * 1e-17)
        if not open_.any():
            return hi
        above = sturm_counts(diag, off, mid) > rank
        hi, lo = np.where(open_ & above, mid, hi), np.where(open_ & ~above, mid, lo)


def _solve_shifted(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) y = b by elimination with row exchanges."""
    n = len(diag)
    d, u, u2, y = list(diag - shift), list(off) + [0.0], [0.0] * n, list(b)
    for i in range(n - 1):
        low = off[i]
        if abs(d[i]) >= abs(low):
            pivot = d[i] if d[i] else tiny
            f = low / pivot
            d[i] = pivot
            d[i + 1] -= f * u[i]
            y[i + 1] -= f * y[i]
        else:
            f = d[i] / low
            d[i], d[i + 1], u[i] = low, u[i] - f * d[i + 1], d[i + 1]
            u2[i], u[i + 1] = u[i + 1], -f * u[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
    out = np.zeros(n)
    for i in range(n - 1, -1, -1):
        rest = y[i] - (u[i] * out[i + 1] if i + 1 < n else 0.0) - (u2[i] * out[i + 2] if i + 2 < n else 0.0)
        out[i] = rest / (d[i] if abs(d[i]) > tiny else tiny)
    return out


def tridiagonal_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of falling ``values`` by inverse iteration. A value
    within a thousandth of the norm of its predecessor belongs to its cluster:
    its vector is kept orthogonal to those found before in the cluster."""
    norm = max(float(np.max(np.abs(diag), initial=0.0) + 2 * np.max(np.abs(off), initial=0.0)), np.finfo(float).tiny)
    eps, out, first, used = np.finfo(float).eps, np.zeros((len(diag), len(values))), 0, None
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shift = value if j == first else min(value, used - 2 * eps * norm)
        used = shift
        y = np.random.default_rng(j).standard_normal(len(diag))
        for _ in range(6):
            y /= np.max(np.abs(y))
            y = _solve_shifted(diag, off, shift, y, eps * norm * 1e-3)
            y /= np.max(np.abs(y))
            for _ in range(2):
                y -= out[:, first:j] @ (out[:, first:j].T @ y)
            y /= np.linalg.norm(y)
        out[:, j] = y
    return out


def leading_components(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues and unit eigenvectors (columns; the entry of
    largest size is positive)."""
    scale = float(np.max(np.abs(cov), initial=0.0))
    if not scale:
        return np.zeros(k), np.eye(len(cov))[:, :k]
    diag, off, mirrors = tridiagonal(cov / scale)
    values = leading_values(diag, off, k)
    vectors = tridiagonal_vectors(diag, off, values)
    for i in range(len(mirrors) - 1, -1, -1):
        v = mirrors[i][:, None]
        vectors[i + 1:] -= 2 * v @ (v.T @ vectors[i + 1:])
    vectors /= np.linalg.norm(vectors, axis=0)
    big = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(k)]
    return values * scale, vectors * np.where(big < 0, -1.0, 1.0)


# ------------------------------------------------------------------ Spark side
def usable(rows: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Rows (all columns) with a finite vector of the most frequent length,
    and that length (0: there are none)."""
    v = F.col(column)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.withColumn(column, v.cast("array<double>")).where(v.isNotNull() & (F.size(v) > 0) & finite)
    top = rows.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("m")).orderBy(F.desc("m"), F.desc("d")).first()
    if top is None:
        return rows.limit(0), 0
    if top["d"] > MAX_DIMS:
        raise ValueError(f"vectors of {top['d']} entries; at most {MAX_DIMS}")
    return rows.where(F.size(v) == top["d"]), top["d"]


def _scaled(col: pa.Array, d: int) -> np.ndarray:
    c = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return np.clip(np.floor(SCALE * np.clip(c, -_MOST, _MOST)), -_MOST, _MOST).astype(np.int64) + SHIFT


def _sums(rows: DataFrame, column: str, d: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            x = _scaled(b.column(0), d)
            n, high, low = n + len(x), high + (x >> 26).sum(axis=0), low + (x & _LOW).sum(axis=0)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(-1, d, dtype=np.int32)), pa.array(np.concatenate([[0], high])),
            pa.array(np.concatenate([[n], low]))], ["dim", "high", "low"])

    found = (rows.select(column).mapInArrow(run, "dim int, high long, low long").groupBy("dim")
             .agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())  # d + 1 rows
    total = {r["dim"]: (r["high"] << 26) + r["low"] for r in found}
    return total[-1], [total[i] for i in range(d)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n: the whole part is taken off exactly first."""
    return (x - np.array([s // n for s in sums], np.int64)).astype(np.float64) - np.array([s % n / n for s in sums])


def _covariance(rows: DataFrame, column: str, n: int, sums: list[int]) -> np.ndarray:
    d = len(sums)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.zeros((d, d))
        for b in batches:
            z = _centred(_scaled(b.column(0), d), n, sums)
            c += z.T @ z
        part = TaskContext.get().partitionId()
        if c.any():
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, part, np.int32)),
                pa.array([r.tobytes() for r in c], pa.binary())], ["i", "part", "line"])

    def add(t: pa.Table) -> pa.Table:
        lines = np.frombuffer(b"".join(t["line"].to_pylist()), np.float64).reshape(-1, d)
        order = np.argsort(t["part"].to_numpy(), kind="stable")
        out = np.zeros(d)
        for k in order:
            out += lines[k]
        return pa.table({"i": t["i"].slice(0, 1), "part": pa.array([int(t["part"].to_numpy().min()) % FAN_IN], pa.int32()),
                         "line": pa.array([out.tobytes()], pa.binary())})

    schema = "i int, part int, line binary"
    lines = rows.select(column).mapInArrow(partial, schema)
    lines = lines.groupBy("i", (F.col("part") % FAN_IN).alias("g")).applyInArrow(add, schema)
    lines = lines.groupBy("i").applyInArrow(add, schema)
    cov = np.zeros((d, d))
    for r in lines.toLocalIterator():  # d rows of d doubles
        cov[r["i"]] = np.frombuffer(r["line"], np.float64)
    return (cov + cov.T) / (2 * n)


def fit(rows: DataFrame, column: str, components: int = 8) -> Whitening:
    """Components of the ``usable`` rows (a written table: it is read twice)."""
    first = rows.select(F.size(column).alias("d")).first()
    if first is None:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    n, sums = _sums(rows, column, first["d"])
    cov = _covariance(rows, column, n, sums)
    values, vectors = leading_components(cov, min(components, len(sums)))
    return Whitening(n, sums, values, vectors, float(np.trace(cov)))


def _exact_squares(x: np.ndarray, z: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum over dimensions of (n * x - S)^2 modulo 2^64, whether it is below
    2^63, and its size as a double: the double tells the multiple of 2^64."""
    apart = x.astype(np.uint64) * np.uint64(n) - np.array([s & (1 << 64) - 1 for s in sums], np.uint64)
    low = (apart * apart).sum(axis=1, dtype=np.uint64)
    size = ((z * n) ** 2).sum(axis=1)
    fits = (np.round((size - low.astype(np.float64)) / 2.0 ** 64) == 0) & (low < np.uint64(1 << 63))
    return low.astype(np.int64), fits, size


def project(rows: DataFrame, id_column: str, column: str, model: Whitening) -> DataFrame:
    """(vec_id, deviation, deviation_approx, w array): ``w`` are the whitened
    coordinates, null without variance."""
    d, k = len(model.sums), len(model.values)
    shared = rows.sparkSession.sparkContext.broadcast((model.n, model.sums, model.values, model.vectors))  # d * k numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, values, vectors = shared.value
        none = values <= d * np.finfo(float).eps * max(float(np.max(values, initial=0.0)), 0.0)
        lead = vectors / np.sqrt(np.where(none, 1.0, values))
        for b in batches:
            x = _scaled(b.column(1), d)
            z = _centred(x, n, sums)
            low, fits, size = _exact_squares(x, z, n, sums)
            w = z @ lead
            flat = pa.array(w.reshape(-1), mask=np.tile(none, len(w)))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(low, mask=~fits), pa.array(size),
                pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * k), flat)],
                ["vec_id", "deviation", "deviation_approx", "w"])

    kind = rows.schema[id_column].dataType.simpleString()
    return rows.select(id_column, column).mapInArrow(
        run, f"vec_id {kind}, deviation long, deviation_approx double, w array<double>")


def identity_error(projected: DataFrame, k: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity, over the components with variance."""
    at = [F.col("w")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = projected.agg(*[F.covar_pop(at[i], at[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max((abs(c - (i == j)) for (i, j), c in zip(pairs, got) if c is not None), default=0.0)


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = 8) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_approx): a row per usable row and component."""
    rows, d = usable(vectors.select(F.col(id_column), F.col(column)), column)
    rows = materialize(rows, "whitening-rows")
    model = fit(rows, column, components)
    projected = materialize(project(rows, id_column, column, model), "whitening-projected")
    error, k = 0.0, len(model.values)
    if model.n:
        error = identity_error(projected, k)
    parts = F.array(*[F.lit(float(e / model.trace) if model.trace else 0.0) for e in model.values]) if k else F.array().cast("array<double>")
    out = projected.select("vec_id", "deviation", "deviation_approx", F.posexplode("w").alias("_at", "whitened"))
    return out.select("vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                      "whitened", F.element_at(parts, F.col("_at") + 1).alias("explained"),
                      F.lit(float(error)).alias("identity_error"), "deviation_approx")
