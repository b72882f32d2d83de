"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors are quantised to whole numbers once and written as packed blocks. Every product of the
covariance V with a thin matrix Q is one distributed pass, Xc'(Xc Q) / n with Xc centred before it is
multiplied: each task sums its blocks, Spark adds up the tasks' sums, and only dims x columns numbers
reach the driver. V itself is never formed.

A round filters the current basis by a Chebyshev polynomial of V (a three-term recurrence, a pass a
degree), which damps the spectrum below the smallest Ritz value against all above. QR makes the basis
orthonormal again, a Rayleigh-Ritz step turns it into approximate eigenvectors. Rounds end when the residuals
|V u - e u| of all wanted pairs are certified to be at the level of rounding. If rounds don't get there, the
basis is widened; with as many columns as dimensions one Rayleigh-Ritz step is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.store import saved
from lamina.llm.texts import lists

BLOCK = 4096  # vectors of a packed block
SCALE, SHIFT = 64, 1_000_000  # entry c counts as floor(SCALE * c) + SHIFT
EXTRA = 16  # columns of the basis beyond the wanted ones
DEGREE = 10  # passes of a filter
ROUNDS = 40  # before the basis is widened
#: Residuals, relative to the largest eigenvalue: certified at once, and certified once they stop shrinking.
CERTAIN, SETTLED = 1e-15, 1e-12
#: Eigenvalues below this share of the largest are rounding: no variance is left to scale.
NOTHING = 1e-12
DIRECT = 64  # matrices sent to the driver at most before they are added up in two steps


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `embedding` as doubles, of rows whose vector isn't null or empty and has finite entries only.

    Vectors of another than the usual dimension (that of most rows; of several the largest) can't be
    whitened with the others and are left out.
    """
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))
    rows = rows.where(v.isNotNull() & (F.size(v) > 0) & fine)
    sizes = rows.groupBy(F.size("embedding").alias("dims")).count()
    usual = sizes.orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    return rows.where(F.size("embedding") == usual[0]["dims"]) if usual else rows


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors as matrices of whole numbers, without SHIFT, of 4 or 8 bytes each."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            part = batch.slice(first, BLOCK)
            flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
            steps = np.floor(SCALE * flat)
            largest = np.abs(steps).max()
            if largest >= 1 << 53:
                raise ValueError("an embedding entry is too large to be counted in whole numbers")
            width = 4 if largest < 1 << 30 else 8
            yield pa.RecordBatch.from_arrays(
                [lists(part.column("vec_id"), np.array([part.num_rows])), pa.array([width], pa.int32()),
                 pa.array([steps.astype(f"i{width}").tobytes()], pa.binary())], ["ids", "width", "steps"])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole numbers, a row for each vector, of each block."""
    for batch in batches:
        for ids, width, steps in zip(batch.column("ids"), batch.column("width"), batch.column("steps"), strict=True):
            yield ids.values, np.frombuffer(steps.as_buffer(), f"i{width.as_py()}").reshape(len(ids), -1)


@dataclass
class Fit:
    """What all vectors have in common: their number, the sums of each dimension, and the components found."""

    blocks: DataFrame
    n: int
    sums: list[int]  # of whole numbers without SHIFT, exact
    vectors: np.ndarray  # dims x components, orthonormal columns
    values: np.ndarray  # eigenvalues, falling
    trace: float
    residual: float  # largest |V u - e u| of a kept pair, by the largest eigenvalue
    passes: int

    def centring(self) -> Centring:
        return Centring(self.n, self.sums)


class Centring:
    """Subtracts the mean: first its whole part, exactly, then what is left."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
        self.rest = [s - n * int(w) for s, w in zip(sums, self.whole, strict=True)]
        self.fraction = np.array([r / n for r in self.rest])

    def __call__(self, steps: np.ndarray) -> np.ndarray:
        return (steps - self.whole) - self.fraction

    def deviations(self, steps: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S) ** 2 of each vector, exact; an error if that is no 64-bit number."""
        near = steps - self.whole
        most = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if most * most * near.shape[1] < 1 << 63:
            return pa.array(((self.n * near - np.array(self.rest, np.int64)) ** 2).sum(axis=1))
        large = near.astype(object) * self.n - np.array(self.rest, object)
        return pa.array((large ** 2).sum(axis=1).tolist(), pa.int64())


def _added(blocks: DataFrame, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum over all blocks of the matrix that `make` has of a block's whole numbers; None without blocks.

    A task emits one matrix. Above `DIRECT` tasks their matrices are added up in about as many tasks as the
    square root first, so what the driver gets hardly grows with the input.
    """
    def summed(matrices: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for own in matrices:
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(total.shape[:1], pa.int32()), pa.array([total.dtype.str]), pa.array([total.tobytes()], pa.binary())],
                ["height", "kind", "total"])

    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from summed(make(steps) for _, steps in _matrices(batches))

    def of_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from summed(_matrix(*row.values()) for batch in batches for row in batch.to_pylist())

    schema = "height int, kind string, total binary"
    added = blocks.mapInArrow(of_blocks, schema)
    tasks = blocks.rdd.getNumPartitions()
    if tasks > DIRECT:
        added = added.repartition(math.isqrt(tasks)).mapInArrow(of_totals, schema)
    found = [_matrix(*row) for row in added.collect()]
    return sum(found[1:], found[0]) if found else None


def _matrix(height: int, kind: str, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(height, -1)


def fit(vectors: DataFrame, components: int = 32) -> Fit | None:
    """Eigenvectors of the covariance of all usable vectors; None if there are none.

    Components without variance (one vector only, equal vectors, a dimension that never changes) are left out.
    """
    blocks = saved(usable(vectors).mapInArrow(_packed, "ids array<long>, width int, steps binary"))
    counted = _added(blocks, lambda x: np.stack(
        [x.sum(axis=0, dtype=np.int64), np.full(x.shape[1], len(x), np.int64)], axis=1))
    if counted is None:
        return None
    n, sums = int(counted[0, 1]), [int(s) for s in counted[:, 0]]
    centred, dims = Centring(n, sums), len(sums)
    context, passes = blocks.sparkSession.sparkContext, 0

    def times_covariance(basis: np.ndarray) -> np.ndarray:
        """V times `basis`, one pass over all blocks."""
        nonlocal passes
        passes += 1
        shared = context.broadcast(basis)  # dims x columns numbers

        def product(steps: np.ndarray) -> np.ndarray:
            x = centred(steps)
            return x.T @ (x @ shared.value)

        try:
            return _added(blocks, product) / n
        finally:
            shared.destroy()

    trace = float(_added(blocks, lambda x: (centred(x) ** 2).sum(axis=0)).sum() / n)
    if not trace:
        return Fit(blocks, n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0, 0.0, passes)
    rng = np.random.default_rng(11)
    wanted, width, residual = min(components, dims), min(dims, components + EXTRA), np.inf
    basis = np.linalg.qr(rng.normal(size=(dims, width)))[0]
    for step in range(1, 100 * ROUNDS):
        image = times_covariance(basis)
        values, turn = np.linalg.eigh(basis.T @ image)  # Rayleigh-Ritz
        values, turn = values[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        off = np.linalg.norm(image - basis * values, axis=0)[:wanted]
        before, residual = residual, float(off.max() / values[0])
        if width == dims or residual <= CERTAIN or residual <= SETTLED and residual > before / 2:
            break
        if step % ROUNDS == 0:  # the wanted part is too near the rest: widen
            width = min(dims, 2 * width)
            basis = np.linalg.qr(np.hstack([basis, rng.normal(size=(dims, width - basis.shape[1]))]))[0]
            continue
        basis = np.linalg.qr(_filtered(times_covariance, basis, image, float(values[0]), float(values[-1])))[0]
    kept = values[:wanted] > NOTHING * values[0]
    return Fit(blocks, n, sums, basis[:, :wanted][:, kept], values[:wanted][kept], trace, residual, passes)


def _filtered(times: Callable[[np.ndarray], np.ndarray], basis: np.ndarray, image: np.ndarray, top: float, cut: float) -> np.ndarray:
    """A Chebyshev polynomial of V, small on 0 to `cut` and 1 near `top`, times `basis`; `image` is V times it."""
    half = max(cut, 1e-8 * top) / 2  # centre and half width of the damped interval
    scale = first = half / (half - top)
    last, now = basis, (image - half * basis) * (scale / half)
    for _ in range(DEGREE - 1):
        after = 1 / (2 / first - scale)
        last, now = now, 2 * (times(now) - half * now) * (after / half) - scale * after * last
        scale = after
    return now


def transform(fitted: Fit) -> DataFrame:
    """`vec_id`, `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error`: a row for each usable
    vector and component.

    `identity_error` is measured on what is returned: two more passes give the mean and then the centred
    covariance of all whitened values.
    """
    centred, k, n = fitted.centring(), len(fitted.values), fitted.n
    scaled = fitted.vectors / np.sqrt(fitted.values)
    spark, error = fitted.blocks.sparkSession, 0.0
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    if not k:
        return spark.createDataFrame([], schema)
    mean = _added(fitted.blocks, lambda x: (centred(x) @ scaled).sum(axis=0))[:, 0] / n

    def products(steps: np.ndarray) -> np.ndarray:
        w = centred(steps) @ scaled - mean
        return w.T @ w

    error = float(np.abs(_added(fitted.blocks, products) / n - np.eye(k)).max())
    explained = fitted.values / fitted.trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, steps in _matrices(batches):
            count, each = len(ids), np.repeat(np.arange(len(ids)), k)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                 pa.array(np.full(count * k, n, np.int64)), centred.deviations(steps).take(pa.array(each)),
                 pa.array((centred(steps) @ scaled).ravel()), pa.array(np.tile(explained, count)),
                 pa.array(np.full(count * k, error))], [c.split()[0] for c in schema.split(", ")])

    return fitted.blocks.select("ids", "width", "steps").mapInArrow(rows, schema)


def whiten(vectors: DataFrame, components: int = 32) -> DataFrame:
    """Fit on all usable vectors of `vec_id`, `embedding`, and their whitened values (see `transform`).

    Rows with a null, empty or non-finite vector or of an unusual dimension take no part. Rows without a
    vec_id and repeated rows count like any other. No usable vector, or no variance, gives no rows.
    Equal eigenvalues leave the choice of their eigenvectors open.
    """
    fitted = fit(vectors, components)
    if fitted is None:
        fitted = Fit(vectors, 0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, 0)
    return transform(fitted)
