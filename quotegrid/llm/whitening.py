"""Whitening of embeddings on their leading components, found by Chebyshev-filtered subspace iteration.

Vectors are integers (scaled, floored, shifted), so counts, sums and deviations are exact. One pass over the centred vectors
X gives XᵀXQ / n for a block Q: each task sums the products of its rows (centred before multiplying) to one small matrix, and these are
added up by Spark. The covariance itself is never formed. A round applies a Chebyshev polynomial of it to the block, one
pass a degree: the recurrence stays within bounds on the unwanted part of the spectrum, from 0 to the least Ritz value, and
grows fast above it. Then QR, and Rayleigh-Ritz with one more pass, which also gives the residuals ``V q - e q`` that certify the components.

Small matrices only (dimensions x block) reach the driver or travel to the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from quotegrid.session import stage

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Columns of the block beyond the wanted ones, and degree of the polynomial of a round.
SPARE = 16
DEGREE = 10
#: Residuals relative to the largest eigenvalue that count as double precision; rounds end there, or when they stop falling.
CERTIFIED = 1e-14
ROUNDS = 60
#: Residuals relative to the largest eigenvalue above which a result is refused.
REFUSED = 1e-9
#: Eigenvalues below this share of the largest are rounding, not spread: no component.
RANK = 1e-12
SEED = 20_240_229
ROWS_AT_ONCE = 8192


def fit_list(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x``: vectors that are whole, as integers ``floor(SCALE * c) + SHIFT``.

    Left out are NULL vectors, vectors with a NULL, NaN or infinite entry, empty ones, and those shorter than the longest, which lack entries.
    """
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = embeddings.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(finite)
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    rows = stage(whole.select(F.col(id_column).alias("vec_id"), x.alias("x")), "whitening-vectors")
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    return rows if longest is None else rows.where(F.size("x") == longest)


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors as the rows of an integer matrix."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            x = pc.list_flatten(part.column("x")).to_numpy()
            yield part, x.reshape(part.num_rows, -1)


def summed(rows: DataFrame, function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of what ``function`` makes of a centred block of them: one array a task, added up by place."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in matrices(batches):
            part = function(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["sums"])

    places = rows.mapInArrow(partial, "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
    got = places.groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(got.num_rows)
    out[got.column("i").to_numpy()] = got.column("v").to_numpy()
    return out


@dataclass(frozen=True)
class Moments:
    """Rows, exact sums per dimension, and the trace of the covariance."""

    n: int
    sums: np.ndarray  # of Python integers
    trace: float

    @property
    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as a whole and a fractional part, so that centring loses no digit."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, dtype=np.int64), np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])


def centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return (x - mean[0]) - mean[1]


def moments(rows: DataFrame) -> Moments | None:
    """Counts and sums over all rows; None without rows."""
    found = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()  # one row per dimension
    if not found:
        return None
    found = sorted((r["i"], r["n"], int(r["s"])) for r in found)
    bare = Moments(found[0][1], np.array([s for _, _, s in found], dtype=object), 0.0)
    mean = bare.mean
    squares = summed(rows, lambda x: (centred(x, mean) ** 2).sum(axis=0))
    return Moments(bare.n, bare.sums, float(squares.sum() / bare.n))


def covariance_times(rows: DataFrame, known: Moments, block: np.ndarray) -> np.ndarray:
    """One pass: the covariance times ``block``."""
    mean = known.mean

    def product(x: np.ndarray) -> np.ndarray:
        c = centred(x, mean)
        return c.T @ (c @ block)

    return summed(rows, product).reshape(block.shape) / known.n


def filtered(apply: Callable[[np.ndarray], np.ndarray], block: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial of the operator on [0, cut], times ``block``; 1 at ``top``, so nothing overflows."""
    half = cut / 2
    sigma = first = half / (top - half)
    before, now = block, (apply(block) - half * block) * (sigma / half)
    for _ in range(degree - 1):
        then = 1 / (2 / first - sigma)
        before, now = now, 2 * (apply(now) - half * now) * (then / half) - (sigma * then) * before
        sigma = then
    return now


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors as columns, their eigenvalues falling, the residuals, and the passes they took."""

    vectors: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    passes: int


def leading_components(apply: Callable[[np.ndarray], np.ndarray], d: int, k: int = COMPONENTS, degree: int = DEGREE) -> Components:
    """The ``k`` leading eigenpairs (at most ``d``, and only of eigenvalues above rounding) of a symmetric operator without negative eigenvalues.

    Rounds go on until every residual is certified, or has stopped falling; then it must be small, or an error is raised.
    Equal eigenvalues leave their vectors open inside their space. Signs: the largest entry of a vector is positive.
    """
    passes = 0

    def counted(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return apply(block)

    width = min(d, k + SPARE)
    block = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, width)))[0]
    best, stale = np.inf, 0
    for _ in range(ROUNDS):
        image = counted(block)
        values, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors, image = block @ turn, image @ turn
        wanted = values[:k] > RANK * max(values[0], 0.0)
        m = int(wanted.sum())
        if not m:
            return Components(np.zeros((d, 0)), np.zeros(0), np.zeros(0), passes)
        residuals = np.linalg.norm(image[:, :m] - vectors[:, :m] * values[:m], axis=0)
        worst = residuals.max() / values[0]
        stale = 0 if worst < best / 2 else stale + 1
        if worst < best:
            best, found = worst, Components(_signed(vectors[:, :m]), values[:m], residuals, passes)
        if best <= CERTIFIED or (stale >= 2 and best <= REFUSED):
            break
        cut = max(values[-1], 0.0)
        if width == d or cut <= RANK * values[0]:  # the block holds the whole spectrum: no unwanted part to damp
            block = np.linalg.qr(image)[0] if width < d else np.linalg.qr(vectors)[0]
        else:
            block = np.linalg.qr(filtered(counted, vectors, cut, values[0], degree))[0]
    if best > REFUSED:
        raise ArithmeticError(f"components not certified: residual {best:.1e} of the largest eigenvalue")
    return found


def _signed(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).argmax(axis=0)
    return vectors * np.where(vectors[top, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def whiten(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each remaining vector and component.

    What remains is said at :func:`fit_list`. NULL and repeated ids are kept, one row each. There are fewer than ``k`` components where
    the vectors have fewer dimensions or spread in fewer, so none for equal vectors or a single one; an empty table gives an
    empty one. ``deviation`` is exact; beyond the range of a long it is NULL.
    """
    rows = fit_list(embeddings)
    known = moments(rows)
    if known is None:
        return rows.sparkSession.createDataFrame([], WHITENED + ", identity_error double")
    found = leading_components(lambda block: covariance_times(rows, known, block), len(known.sums), k)
    mean, m, n, sums = known.mean, len(found.values), known.n, known.sums
    scaled = found.vectors / np.sqrt(found.values)
    explained = found.values / known.trace if m else found.values

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x, mean) @ scaled
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    error = 0.0
    if m:
        totals = summed(rows, spread) / n
        mid = totals[m * m:]
        error = float(np.abs(totals[:m * m].reshape(m, m) - np.outer(mid, mid) - np.eye(m)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, part = np.array([int(s) // n for s in sums], dtype=object), np.array([int(s) % n for s in sums], dtype=object)
        for batch, x in matrices(batches):
            if not m:
                continue
            w = centred(x, mean) @ scaled
            far = int(np.abs(x - mean[0]).max()) * n + n
            if far * far * x.shape[1] < 1 << 63:
                off = (x - whole.astype(np.int64)) * n - part.astype(np.int64)
                deviation = (off * off).sum(axis=1).tolist()
            else:  # too large for long steps: Python integers
                off = (x.astype(object) - whole) * n - part
                deviation = [v if v < 1 << 63 else None for v in (off * off).sum(axis=1)]
            row = pa.array(np.repeat(np.arange(len(x)), m))
            yield pa.RecordBatch.from_arrays([
                pc.take(batch.column("vec_id").cast(pa.int64()), row), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * m, n, dtype=np.int64)), pc.take(pa.array(deviation, pa.int64()), row),
                pa.array(w.ravel()), pa.array(np.tile(explained, len(x))),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return rows.mapInArrow(project, WHITENED).withColumn("identity_error", F.lit(error))
