"""Whitening of vectors by Chebyshev-filtered subspace iteration.

Vectors are read as integers (``floor(256 * entry)``); the fit runs over each distinct one once.
A block of directions Q, some more than are wanted, is improved by polynomials in the
covariance V, which is never formed: every application is one pass over the stored fit list that
centres the vectors and adds up X'XQ, task by task. A Chebyshev polynomial of V stays small on
the interval that holds the unwanted spectrum and grows beyond it, so each round of ``DEGREE``
passes damps the unwanted directions by a large factor. QR and Rayleigh-Ritz turn the filtered
block into eigenvectors. Rounds go on until every wanted direction is certified: its residual
|Vq - eq|, divided by the distance to the nearest other eigenvalue, bounds its error. The lower
end of the spectrum comes from a Lanczos run that rides along with the first round.

What travels is small and of fixed size: the block (dimension times ``COMPONENTS + GUARDS + 1``
numbers) goes to the tasks, and as many sums come back, after Spark has added up those of all
tasks. Passes read a written table, so a lost executor costs the tasks of one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .common import space

SCALE = 256
COMPONENTS = 4
#: Directions kept beside the wanted ones.
GUARDS = 20
DEGREE = 10
MOST_ROUNDS = 100
#: A direction is certified when the bound of its error is below this.
ERROR = 1e-11
#: Residuals below this part of the largest eigenvalue are rounding, as far as they no longer
#: shrink from round to round; equal eigenvalues, which have no distance, end there.
ROUNDING = 1e-11
#: Eigenvalues below this part of the largest are zero.
ZERO = 1e-12
LONG = 2**63 - 1
#: Rows that are centred at a time within a task.
SLICE = 2048


@dataclass(frozen=True)
class Fit:
    """The eigenvectors of the fit list's covariance, largest eigenvalue first.

    ``total`` holds the exact sums of the ``n`` vectors, ``components`` has a row for each
    component with an eigenvalue above zero, ``residuals`` certify them. ``identity_error`` is
    the largest absolute entry of the whitened fit list's covariance minus the identity.
    """

    n: int
    total: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray
    residuals: np.ndarray
    passes: int
    identity_error: float

    @property
    def dimension(self) -> int:
        return len(self.total)

    @property
    def mean(self) -> np.ndarray:
        return np.array([t / self.n for t in self.total], np.float64)


def usable(vector: str) -> Column:
    """True for vectors that are there and hold neither null nor non-finite entries."""
    number = lambda c: c.cast("double")
    bad = F.exists(F.col(vector), lambda c: c.isNull() | F.isnan(number(c)) | (F.abs(number(c)) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def integers(vector: str, dimension: int) -> Column:
    """``floor(256 * entry)`` as longs, which stop at their ends; zeros fill up short vectors."""
    whole = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))))
    missing = F.lit(dimension) - F.size(vector)
    return F.concat(whole, F.array_repeat(F.lit(0).cast("bigint"), F.greatest(missing, F.lit(0))))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _sums(fit_list: DataFrame, dimension: int, width: int, of: Callable[[np.ndarray], np.ndarray], kind: str = "DOUBLE"):
    """Sum over all vectors of the matrix (any rows by ``width``) that ``of`` gives for a slice.

    Each task adds up its own; Spark adds up the tasks' rows, one key for each row of the matrix.
    """
    names = [f"v{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = _matrix(batch.column(0), dimension)
            for at in range(0, len(rows), SLICE):
                part = of(rows[at : at + SLICE])
                total = part if total is None else total + part
        if total is not None:
            columns = [pa.array(np.arange(len(total), dtype=np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in total.T)]
            yield pa.RecordBatch.from_arrays(columns, ["i", *names])

    schema = ", ".join(["i INT", *(f"{n} {kind}" for n in names)])
    exact = "decimal(38,0)" if kind == "BIGINT" else "double"
    found = fit_list.select("x").mapInArrow(run, schema).groupBy("i").agg(*(F.sum(F.col(n).cast(exact)).alias(n) for n in names))
    return [list(r)[1:] for r in sorted(found.collect(), key=lambda r: r.i)]


def _halves(rows: np.ndarray) -> np.ndarray:
    """Sums of the upper and lower 32 bits, which do not overflow, by dimension."""
    return np.stack([(rows >> 32).sum(axis=0), (rows & 0xFFFFFFFF).sum(axis=0)], axis=1)


class _Lanczos:
    """Three-term recurrence on one vector; its small matrix brackets the spectrum."""

    def __init__(self, start: np.ndarray):
        self.basis, self.alpha, self.beta = [start / np.linalg.norm(start)], [], []

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def step(self, applied: np.ndarray) -> bool:
        basis = np.array(self.basis)
        self.alpha.append(float(applied @ self.vector))
        rest = applied - basis.T @ (basis @ applied)
        rest -= basis.T @ (basis @ rest)
        self.beta.append(float(np.linalg.norm(rest)))
        if self.beta[-1] <= 1e-12 * max(map(abs, self.alpha)):
            return False
        self.basis.append(rest / self.beta[-1])
        return True

    def lowest(self) -> float:
        k = len(self.alpha)
        small = np.diag(self.alpha) + np.diag(self.beta[: k - 1], 1) + np.diag(self.beta[: k - 1], -1)
        values, vectors = np.linalg.eigh(small)
        return max(0.0, values[0] - self.beta[k - 1] * abs(vectors[-1, 0]))


def eigen(apply: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int, guards: int = GUARDS, degree: int = DEGREE):
    """``values, vectors (as columns), residuals`` of the ``wanted`` largest eigenvalues.

    ``apply`` multiplies a block by a symmetric positive semidefinite matrix.
    """
    block, wanted = min(dimension, wanted + guards), min(dimension, wanted)
    random = np.random.default_rng(20)
    q = np.eye(dimension) if block == dimension else np.linalg.qr(random.standard_normal((dimension, block)))[0]
    lanczos = _Lanczos(random.standard_normal(dimension)) if block < dimension else None
    low, best = 0.0, np.inf
    for _ in range(MOST_ROUNDS):
        applied = apply(q)
        small = q.T @ applied
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1]
        values, turn = values[order], turn[:, order]
        q, applied = q @ turn, applied @ turn
        residuals = np.linalg.norm(applied - q * values, axis=0)
        top = max(values[0], 0.0)
        gaps = np.array([np.min(np.abs(np.delete(values, j) - values[j]), initial=np.inf) for j in range(wanted)])
        worst = residuals[:wanted].max()
        with np.errstate(divide="ignore", invalid="ignore"):
            certified = residuals[:wanted] <= ERROR * gaps
        stuck = worst <= ROUNDING * top and worst > best / 4
        if block == dimension or top == 0 or certified.all() or stuck:
            break
        best = min(best, worst)
        # Chebyshev polynomial on [low, high], scaled at the top to stay in range.
        high = max(values[-1], low + ROUNDING * top)
        centre, half = (high + low) / 2, (high - low) / 2
        scale = half / (centre - top)
        before, now, factor = q, (applied - centre * q) * (scale / half), scale
        for _ in range(degree - 1):
            if lanczos:
                both = apply(np.column_stack([now, lanczos.vector]))
                product = both[:, :-1]
                if not lanczos.step(both[:, -1]):
                    low, lanczos = lanczos.lowest(), None
            else:
                product = apply(now)
            following = 1 / (2 / scale - factor)
            before, now, factor = now, 2 * (following / half) * (product - centre * now) - factor * following * before, following
        if lanczos:
            low, lanczos = lanczos.lowest(), None
        q = np.linalg.qr(now)[0]
    return values[:wanted], q[:, :wanted], residuals[:wanted]


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """Learn from the distinct integer vectors of ``vectors``; None if there is no usable one.

    Vectors that are null or hold null or non-finite entries are left out. Shorter vectors are
    filled up with zeros. Equal vectors count once, however many rows hold them. A component
    whose eigenvalue is zero (constant vectors, fewer dimensions) has no whitened value and is
    left out. Components of equal eigenvalues are any orthonormal basis of their space.
    """
    rows = vectors.select(F.col(vector).alias("vector")).filter(usable("vector"))
    dimension = rows.agg(F.max(F.size("vector"))).first()[0]
    if not dimension:
        return None
    work = space(vectors.sparkSession, "whitening")
    # Distinct within each task first: copies of one vector travel once from each.
    listed = work.write(rows.select(integers("vector", dimension).alias("x")).distinct(), "fit")
    n = listed.count()
    halves = _sums(listed, dimension, 2, _halves, "BIGINT")
    total = [int(high) * 2**32 + int(low) for high, low in halves]
    mean = np.array([t / n for t in total], np.float64)

    def centred(x: np.ndarray) -> np.ndarray:
        return x.astype(np.float64) - mean

    trace = sum(r[0] for r in _sums(listed, dimension, 1, lambda x: (centred(x) ** 2).sum(axis=0)[:, None])) / n
    passes = 0

    def apply(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ block)

        return np.array(_sums(listed, dimension, block.shape[1], product)) / n

    values, vectors_, residuals = eigen(apply, dimension, components)
    kept = values > ZERO * max(values[0], 0.0)
    values, vectors_, residuals = values[kept], vectors_[:, kept], residuals[kept]
    # Either sign is right; the largest entry is made positive.
    vectors_ = vectors_ * np.sign(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(len(values))])
    white = vectors_ / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ white
        return np.vstack([z.T @ z, z.sum(axis=0)])

    error = 0.0
    if len(values):
        found = np.array(_sums(listed, dimension, len(values), moments)) / n
        error = float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(len(values))).max())
    return Fit(n, total, trace, values, vectors_.T, residuals, passes, error)


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Exact sums of (n * x - total) squared; None where a long does not hold it."""
    rough = n * x.astype(np.float64) - np.array(total, np.float64)
    safe = (rough**2).sum(axis=1) < 2.0**62
    if max((abs(t) for t in total), default=0) < 2**62:
        near = x[safe]
        exact = n * near - np.array(total, np.int64) if np.abs(near, dtype=np.float64).max(initial=0.0) * n < 2.0**62 else None
    else:
        exact = None
    if exact is None:
        safe = np.zeros(len(x), bool)
    found: list[int | None] = [None] * len(x)
    if safe.any():
        for at, value in zip(np.flatnonzero(safe).tolist(), (exact * exact).sum(axis=1).tolist()):
            found[at] = value
    for at in np.flatnonzero(~safe).tolist():
        value = sum((n * v - t) ** 2 for v, t in zip(x[at].tolist(), total))
        found[at] = value if value <= LONG else None
    return found


def whiten(vectors: DataFrame, model: Fit, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key, deviation, whitened`` of every usable row; ``whitened`` has an entry for each component.

    Rows may repeat and ``key`` may be null; other columns are not read. Vectors longer than the
    fitted ones cannot be projected and give an error. A deviation beyond a long is null.
    """
    mean, white = model.mean, (model.components.T / np.sqrt(model.values))
    n, total, dimension = model.n, model.total, model.dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                x = _matrix(rows.column(1), dimension)
                z = (x.astype(np.float64) - mean) @ white
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * z.shape[1])
                lists = pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(z).ravel()))
                deviation = pa.array(_deviations(x, n, total), pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column(0), deviation, lists], [key, "deviation", "whitened"])

    rows = vectors.select(F.col(key), F.col(vector).alias("vector")).filter(usable("vector"))
    rows = rows.select(key, integers("vector", dimension).alias("x"))
    kinds = [rows.schema[key], StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))]
    return rows.mapInArrow(run, StructType(kinds))


def by_component(vectors: DataFrame, model: Fit | None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row for each usable vector and component, numbered from 1, with the fit's figures.

    No rows where nothing could be fitted: an empty table, or vectors that are all alike.
    """
    schema = f"{key} BIGINT, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    explained = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    rows = whiten(vectors, model, vector, key).select(key, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        key,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
