"""Whitening of vectors by shifted CholeskyQR.

The centred rows C are never in one place. A distributed pass gives the Gram matrix C'C; the Cholesky factor R1 of the Gram
matrix plus a small shift always exists, and solving X R1 = C row by row gives rows that are nearly orthogonal. The same
pass over these rows gives R2, and so on until the Gram matrix is the identity but for rounding, usually two or three passes.
The product R = ... R2 R1 is the triangular factor of C to working precision, where the Gram matrix itself
would have squared its condition. The singular value decomposition of R (a small matrix, on the driver) has the
components of C. Every pass reads the vectors again; tasks return sums, never rows.

Vectors become whole numbers first, so sums and deviations are exact. n x - S is exact, so centring rounds once.

Defined results: vectors that are null, empty, hold null or non-finite entries, or entries whose whole number has no place in a long
(beyond 2^62), are dropped; vectors of different lengths are fitted apart, each length by itself; repeated and null ids stay
rows of their own; components whose eigenvalue is nothing but rounding (constant vectors, fewer vectors
than dimensions) have null ``whitened`` and are left out of identity_error; a deviation that has no place in a long is null; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import written

#: Fixed values of the contract: entries become floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 1024, 100_000
LARGEST = float(2**62)
COMPONENTS = 8
#: A Gram matrix this close to the identity gives orthogonality to working precision when its factor is applied.
CLOSE, PASSES = 1e-8, 8
#: Singular values below this part of the largest are rounding.
NOTHING = 1e-12
ROWS = 1024


@dataclass
class Fit:
    """The components of vectors of one length."""

    n: int
    sums: list[int]
    factors: list[np.ndarray] = field(default_factory=list)
    components: np.ndarray | None = None  # rows
    eigenvalues: np.ndarray | None = None
    trace: float = 0.0

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n x - S, exact (as Python's integers where 64 bits might not do), and x - S / n."""
        far = max(int(np.abs(x).max(initial=0)), 1)
        if self.n * far < 2**62 and max(map(abs, self.sums), default=0) < 2**62:
            exact = x * self.n - np.array(self.sums, np.int64)
            return exact, exact / self.n
        exact = x.astype(object) * self.n - np.array(self.sums, object)
        return exact, np.array([[int(v) / self.n for v in row] for row in exact], np.float64).reshape(x.shape)

    def scale(self) -> np.ndarray:
        """Standard deviations of the components; 0 for those that are rounding."""
        own = np.sqrt(self.eigenvalues)
        return np.where(own > own.max(initial=0) * NOTHING, own, 0.0)


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """X with X R = rows, for the product R of the factors: one triangular solve after the other."""
    for r in factors:
        out = np.empty_like(rows)
        for k in range(r.shape[0]):
            out[:, k] = (rows[:, k] - out[:, :k] @ r[:k, k]) / r[k, k]
        rows = out
    return rows


def _numbers(embeddings: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, dim and x (whole numbers) of the vectors that count."""
    given = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    sound = (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST / SCALE))
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    return given.where(F.coalesce(sound, F.lit(False))).select("vec_id", F.size("v").alias("dim"), x.alias("x"))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length in a batch: the rows' numbers and their vectors as a matrix."""
    dims = batch.column("dim").to_numpy()
    flat = batch.column("x").flatten().to_numpy()
    ends = np.cumsum(dims)
    for dim in np.unique(dims):
        own = np.flatnonzero(dims == dim)
        for i in range(0, len(own), ROWS):
            at = own[i : i + ROWS]
            yield int(dim), at, flat[(ends[at] - dim)[:, None] + np.arange(dim)]


def _summed(numbers: DataFrame, part: Callable[[int, np.ndarray], np.ndarray], kind: str) -> dict[int, tuple[int, np.ndarray]]:
    """For each length the number of vectors and the sum of ``part`` (a matrix of few rows) over them.

    Tasks add up their own; what they return is added by place in Spark, so the driver gets one matrix a length.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for dim, _, x in _by_dim(batch):
                found = part(dim, x)
                if dim in held:
                    held[dim][0] += len(x)
                    held[dim][1] += found
                else:
                    held[dim] = [len(x), found]
        for dim, (n, found) in held.items():
            rows = pa.array(list(found), pa.list_(pa.from_numpy_dtype(found.dtype)))
            yield pa.RecordBatch.from_arrays([pa.array([dim] * len(found)), pa.array(range(len(found))), pa.array([n] * len(found)), rows], names=["dim", "i", "n", "row"])

    total = F.sum(F.col("value").cast("decimal(38,0)")) if kind == "long" else F.sum("value")
    parts = numbers.mapInArrow(task, f"dim long, i long, n long, row array<{kind}>").select("dim", "i", "n", F.posexplode("row").alias("j", "value"))
    out: dict[int, tuple[int, np.ndarray]] = {}
    for dim, i, j, n, value in parts.groupBy("dim", "i", "j").agg(F.sum("n").alias("n"), total.alias("value")).collect():
        if dim not in out:
            rows = 2 if kind == "long" else dim
            out[dim] = n, np.zeros((rows, dim), object if kind == "long" else np.float64)
        out[dim][1][i, j] = int(value) if kind == "long" else value
    return out


def _halves(dim: int, x: np.ndarray) -> np.ndarray:
    # two sums of 32 bits each, so that no task's sum overflows
    return np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])


def fit(numbers: DataFrame) -> dict[int, Fit]:
    """The fit of each length."""
    fits = {dim: Fit(n, [int(hi) * 2**32 + int(lo) for hi, lo in halves.T]) for dim, (n, halves) in _summed(numbers, _halves, "long").items()}
    open_ = set(fits)
    for number in range(PASSES):
        if not open_:
            break

        def gram(dim: int, x: np.ndarray, fits=fits, open_=frozenset(open_)) -> np.ndarray:
            if dim not in open_:
                return np.zeros((dim, dim))
            q = solved(fits[dim].centred(x)[1], fits[dim].factors)
            return q.T @ q

        for dim, (n, g) in _summed(numbers, gram, "double").items():
            if dim not in open_:
                continue
            if not number:
                fits[dim].trace = float(np.trace(g)) / n
            full = np.diag(g) > 0.5
            if not np.trace(g):  # all vectors are equal
                open_.discard(dim)
            elif number and np.abs(g - np.eye(dim))[np.ix_(full, full)].max(initial=0) <= CLOSE:
                open_.discard(dim)
            fits[dim].factors.append(_cholesky(g, n, shift=not number))
    for own in fits.values():
        r = np.eye(len(own.sums))
        for factor in own.factors:
            r = factor @ r
        _, values, components = np.linalg.svd(r)
        if not own.trace:
            values = np.zeros_like(values)
        # either sign will do; this one does not depend on the library
        side = np.sign(components[np.arange(len(components)), np.abs(components).argmax(axis=1)])
        own.components, own.eigenvalues = components * side[:, None], values**2 / own.n
    return fits


def _cholesky(g: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """The upper triangular R with R'R = g, plus a shift if asked for or needed."""
    dim = len(g)
    most = float(np.linalg.norm(g, 2))
    least = min(11 * (n * dim + dim * (dim + 1)) * np.finfo(float).eps / 2, 1e-3) * most or np.finfo(float).tiny
    if not shift:
        try:
            r = np.linalg.cholesky(g).T
            if np.diag(r).min() > 1e-7 * np.diag(r).max():
                return r
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(g + least * np.eye(dim)).T
        except np.linalg.LinAlgError:
            least *= 10


def project(numbers: DataFrame, fits: dict[int, Fit], components: int = COMPONENTS) -> DataFrame:
    """vec_id, dim, deviation and whitened (an array of up to ``components`` values) of each vector."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for dim, at, x in _by_dim(batch):
                own = fits[dim]
                exact, centred = own.centred(x)
                size = float(np.abs(exact).max(initial=0))
                if exact.dtype != object and size * size * dim < 2.0**62:
                    deviation = pa.array((exact * exact).sum(axis=1), pa.int64())
                else:
                    totals = (sum(int(v) ** 2 for v in row) for row in exact)
                    deviation = pa.array([v if v < 2**63 else None for v in totals], pa.int64())
                scale = own.scale()[:components]
                values = centred @ own.components[:components].T
                with np.errstate(divide="ignore", invalid="ignore"):
                    values = values / scale
                flat = pa.array(values.ravel(), mask=np.tile(scale == 0, len(at)))
                whitened = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * len(scale), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array([dim] * len(at)), deviation, whitened], names=["vec_id", "dim", "deviation", "whitened"])

    return numbers.mapInArrow(task, "vec_id long, dim long, deviation long, whitened array<double>")


def identity_error(projected: DataFrame, dim: int, fitted: Fit, components: int = COMPONENTS) -> float:
    """The largest difference of the covariance of ``whitened`` from the identity, centred before multiplying."""
    own = projected.where(F.col("dim") == dim)
    some = [k for k, x in enumerate(fitted.scale()[:components]) if x]
    if not some:
        return 0.0
    means = own.agg(*(F.avg(F.col("whitened")[k]) for k in some)).first()
    away = {k: F.col("whitened")[k] - F.lit(m) for k, m in zip(some, means)}
    pairs = [(a, b) for a in some for b in some if a <= b]
    found = own.agg(*(F.avg(away[a] * away[b]) for a, b in pairs)).first()
    return max(abs(x - (a == b)) for (a, b), x in zip(pairs, found))


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    numbers = _numbers(embeddings, vec_id, vector)
    fits = fit(numbers)
    spark = embeddings.sparkSession
    projected = written(project(numbers, fits, components), "whitened")
    rows = []
    for dim, own in fits.items():
        error = identity_error(projected, dim, own, components)
        parts = own.eigenvalues / own.trace if own.trace else np.zeros(dim)
        rows += [(dim, k + 1, own.n, float(parts[k]), error) for k in range(min(components, dim))]
    about = spark.createDataFrame(rows, "dim long, component int, n long, explained double, identity_error double")
    each = projected.select("vec_id", "dim", "deviation", F.posexplode("whitened").alias("place", "whitened")).withColumn("component", F.col("place") + 1)
    # a few rows for each length that occurs
    joined = each.join(about, ["dim", "component"])
    return joined.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
