"""Whitening of embeddings: leading covariance eigenvectors by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import staged

COMPONENTS = 16
GUARD = 32  # further vectors of the block: the filter separates the wanted ones from what lies behind these
SCALE, SHIFT = 64, 1_000_000
BLOCK_BYTES = 1 << 20
MAX_DEGREE = 12
GROWTH = 1e8  # greatest ratio of the amplifications of the first and the last wanted component in one filter
CERTIFIED = 1e-14  # greatest residual norm of a wanted component, relative to its eigenvalue
ROUNDING = 1e-10  # residuals below it that no longer shrink are rounding
MAX_PASSES = 2000
RANK = 1e-12  # eigenvalues below it, relative to the greatest, are zero
EXACT = float(1 << 52)


def finite(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows whose vector is not null and holds finite entries only."""
    x = F.col("embedding").cast("array<double>")
    able = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return vectors.where(F.coalesce(able, F.lit(False))).select("vec_id", x.alias("embedding"))


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    """The matrix of floor(SCALE * c) + SHIFT; shorter vectors are filled up with c = 0."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    lengths = np.diff(offsets)
    if (lengths == dims).all():
        values = flat.reshape(-1, dims)
    else:
        values = np.zeros((len(lengths), dims))
        values[np.arange(dims) < lengths[:, None]] = flat
    scaled = np.floor(SCALE * values)
    if scaled.size and np.abs(scaled).max() > EXACT:
        raise OverflowError("an embedding has an entry too large to be exact as an integer")
    return scaled.astype(np.int64) + SHIFT


def _packed(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _integers(batch.column("embedding"), dims)
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary())], names=["x"])


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors of a batch as few matrices of bounded size."""
    for batch in batches:
        rows, at = batch.column("x").to_pylist(), 0
        step = max(1, BLOCK_BYTES // max(1, len(rows[0]))) if rows else 1
        while at < len(rows):
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(rows[at:at + step])], pa.binary())], names=["block"])
            at += step


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Exact sums of the partition by dimension, and in a last cell its number of vectors."""
    totals = np.zeros(dims + 1, np.int64)
    for batch in batches:
        for block in batch.column("block"):
            x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dims)
            totals[:dims] += x.sum(axis=0)
            totals[dims] += len(x)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1, dtype=np.int32)), pa.array(totals)], names=["cell", "value"])


@dataclass(frozen=True)
class Centre:
    """The exact mean of n integer vectors: ``whole`` + ``rest`` / n, in each dimension 0 <= rest < n."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as exact integers."""
        near = x - self.whole
        if near.size and float(np.abs(near).max()) * self.n >= 2.0 ** 62:
            raise OverflowError("n * x - S does not fit 64 bits")
        return self.n * near - self.rest

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x) / self.n


@dataclass(frozen=True)
class FitList:
    """The distinct integer vectors in blocks in the shared folder, and their centre."""

    blocks: DataFrame
    dims: int
    centre: Centre

    def gather(self, compute: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum over all vectors of what ``compute`` gives for a matrix of centred ones.

        A partition adds up its blocks, and Spark the partitions cell by cell: ``size`` numbers reach the driver.
        """
        dims, centre = self.dims, self.centre

        def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for block in batch.column("block"):
                    x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dims)
                    total += compute(centre.centred(x)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["cell", "value"])

        summed = self.blocks.mapInArrow(partial_sums, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        return _cells(summed, size, np.float64)

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``: one pass over the data, which never forms the covariance itself."""
        return self.gather(lambda c: c.T @ (c @ q), q.size).reshape(q.shape) / self.centre.n

    def trace(self) -> float:
        return float(self.gather(lambda c: np.array([(c * c).sum()]), 1)[0]) / self.centre.n


def _cells(summed: DataFrame, size: int, kind: type) -> np.ndarray:
    found, out = summed.toArrow(), np.zeros(size, kind)
    out[found["cell"].to_numpy()] = found["value"].to_numpy()
    return out


def fit_list(vectors: DataFrame) -> FitList | None:
    """The fit list of a frame of ``finite`` vectors; None if there is nothing to fit."""
    dims = vectors.agg(F.max(F.size("embedding"))).first()[0]
    if not dims:
        return None
    distinct = vectors.select("embedding").mapInArrow(partial(_packed, dims=dims), "x binary").distinct()
    blocks = staged(distinct.mapInArrow(_blocked, "block binary"), "fit-list")
    summed = blocks.mapInArrow(partial(_sums, dims=dims), "cell int, value bigint").groupBy("cell").agg(F.sum("value").alias("value"))
    totals = _cells(summed, dims + 1, np.int64)
    n = int(totals[dims])
    whole = totals[:dims] // n
    return FitList(blocks, dims, Centre(n, whole, totals[:dims] - n * whole))


class _LowerBound:
    """A lower bound of the spectrum by Lanczos steps; its vector rides along in the passes of the block."""

    def __init__(self, start: np.ndarray) -> None:
        self.basis, self.alpha, self.beta, self.done = [start / np.linalg.norm(start)], [], [], False

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def advance(self, image: np.ndarray) -> None:
        if self.done:
            return
        self.alpha.append(float(image @ self.vector))
        known = np.array(self.basis)
        for _ in range(2):
            image = image - known.T @ (known @ image)
        self.beta.append(float(np.linalg.norm(image)))
        if self.beta[-1] <= 1e-10 * abs(self.alpha[0]) or len(self.basis) == len(image):
            self.done = True
        else:
            self.basis.append(image / self.beta[-1])

    def value(self) -> float:
        inner = self.beta[:len(self.alpha) - 1]
        least = np.linalg.eigvalsh(np.diag(self.alpha) + np.diag(inner, 1) + np.diag(inner, -1))[0]
        return max(0.0, float(least - self.beta[-1]))


@dataclass(frozen=True)
class Eigenpairs:
    values: np.ndarray  # falling
    vectors: np.ndarray  # a column each
    trace: float
    residual: float  # greatest residual norm of a component, relative to its eigenvalue
    passes: int


def leading(data: FitList, wanted: int = COMPONENTS, seed: int = 0) -> Eigenpairs:
    """The ``wanted`` leading eigenpairs of the covariance, fewer where its rank is less.

    A block of wanted + GUARD vectors is filtered with the Chebyshev polynomial that is small between the lower
    bound of the spectrum and the block's least Ritz value and grows fast above; one pass over the data per degree.
    QR and Rayleigh-Ritz follow. Their product with the covariance is the next filter's first step and gives the
    residuals at no further pass. It ends when all wanted residuals are certified and what the trace leaves for
    the vectors outside the block fits below the block's least Ritz value.
    """
    pick = np.random.default_rng(seed)
    k, b = min(wanted, data.dims), min(data.dims, wanted + GUARD)
    q = np.linalg.qr(pick.normal(size=(data.dims, b)))[0]
    lower = _LowerBound(pick.normal(size=data.dims))
    trace, passes, before = data.trace(), 1, np.inf
    if trace == 0:
        return Eigenpairs(np.zeros(0), np.zeros((data.dims, 0)), 0.0, 0.0, passes)

    def times(y: np.ndarray) -> np.ndarray:
        nonlocal passes
        if passes >= MAX_PASSES:
            raise ArithmeticError(f"no certified eigenvectors after {passes} passes")
        image = data.times(np.column_stack([y, lower.vector]))
        passes += 1
        lower.advance(image[:, -1])
        return image[:, :-1]

    while True:
        image = times(q)
        values, turn = np.linalg.eigh((q.T @ image + image.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        y, image = q @ turn, image @ turn
        kept = values[:k] > RANK * values[0]
        residual = float((np.linalg.norm(image[:, :k] - y[:, :k] * values[:k], axis=0)[kept] / values[:k][kept]).max())
        settled = residual <= CERTIFIED or (residual <= ROUNDING and residual > before / 2)
        if settled and trace - values.sum() <= (data.dims - b) * values[-1] + 1e-9 * trace:
            return Eigenpairs(values[:k][kept], y[:, :k][:, kept], trace, residual, passes)
        before = residual
        low, high = lower.value(), max(float(values[-1]), RANK * values[0])
        low = min(low, high * (1 - 1e-6))
        mid, half = (high + low) / 2, (high - low) / 2
        q = np.linalg.qr(_filtered(y, image, times, mid, half, float(values[0]), _degree(values[0], values[k - 1], mid, half)))[0]


def _degree(first: float, last: float, mid: float, half: float) -> int:
    """The greatest degree at which the first component does not swamp the last wanted one."""
    def gain(value: float) -> float:
        x = max(1.0, (value - mid) / half)
        return x + np.sqrt(x * x - 1)

    ratio = np.log(gain(first) / gain(last))
    return int(np.clip(np.log(GROWTH) / ratio if ratio > 0 else MAX_DEGREE, 2, MAX_DEGREE))


def _filtered(y: np.ndarray, image: np.ndarray, times: Callable, mid: float, half: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of the covariance applied to ``y``, scaled to stay near 1 at ``top``."""
    first = sigma = half / max(top - mid, half)
    older, newer = y, (image - mid * y) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        older, newer = newer, (times(newer) - mid * newer) * (2 * following / half) - older * (sigma * following)
        sigma = following
    return newer


WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """A row for each vector and leading component of ``vectors`` (vec_id, embedding, any others).

    Each entry c becomes the integer x = floor(64 * c) + 1000000. The components are those of the covariance of the
    distinct integer vectors; ``deviation`` is the exact sum of (n * x - S)**2, ``whitened`` the projection of
    the centred vector over the square root of the eigenvalue, ``explained`` the eigenvalue over the trace,
    ``identity_error`` the greatest entry of the whitened fit list's covariance less the identity, by a pass of
    its own.

    Null vectors and those with a null or non-finite entry are dropped. A shorter vector counts as filled up with
    zeros. Repeated rows count once in the fit list, and each has its rows in the result. Components without
    variance are left out: an empty table, or one of equal vectors only, gives no rows. It fails with an
    OverflowError where a deviation would not fit a long.
    """
    able = finite(vectors)
    data = fit_list(able)
    empty = able.sparkSession.createDataFrame([], WHITENED)
    if data is None:
        return empty
    pairs = leading(data, wanted)
    found = len(pairs.values)
    if not found:
        return empty
    dims, centre = data.dims, data.centre
    turn, explained = pairs.vectors / np.sqrt(pairs.values), pairs.values / pairs.trace

    def outer(c: np.ndarray) -> np.ndarray:
        z = c @ turn
        return z.T @ z

    error = float(np.abs(data.gather(outer, found * found).reshape(found, found) / centre.n - np.eye(found)).max())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = centre.scaled(_integers(batch.column("embedding"), dims))
            if scaled.size and (scaled.astype(float) ** 2).sum(axis=1).max() >= 2.0 ** 62:
                raise OverflowError("a deviation does not fit 64 bits")
            n = len(scaled)
            ids = pc.take(batch.column("vec_id"), pa.array(np.repeat(np.arange(n), found)))
            yield pa.RecordBatch.from_arrays([
                ids.cast(pa.int64()), pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), n)),
                pa.array(np.full(n * found, centre.n)), pa.array(np.repeat((scaled * scaled).sum(axis=1), found)),
                pa.array(((scaled / centre.n) @ turn).ravel()), pa.array(np.tile(explained, n)), pa.array(np.full(n * found, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return able.mapInArrow(rows, WHITENED)
