"""Whitening of vectors by the leading eigenvectors of their covariance.

The covariance is never formed. A distributed pass multiplies it with a block
of vectors: each task centres its rows, multiplies them with the block and the
result with the rows' transpose, and the tasks' sums are added up by Spark. The
eigenvectors come from a block Jacobi-Davidson iteration around that product:
Rayleigh-Ritz in a growing subspace, pairs locked as their residual reaches
double precision, and for each other pair a correction from its projected
equation, solved by some steps of MINRES, all pairs together in one pass a
step. The driver holds vectors of the number of dimensions, never rows.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telmart.llm.vectors import matrix, pieces_of, usable

COMPONENTS = 32
# Vectors beside the wanted ones in the first block, and steps of MINRES at most.
GUARD = 8
INNER_STEPS = 8
INNER_ACCURACY = 0.05
# Residual, as a share of the largest eigenvalue, at which a pair is locked.
LOCKED = 1e-14
# A pair that rounding keeps above LOCKED is at its end after so many rounds without gain.
PATIENCE = 3
# Eigenvalues below this share of the largest are taken as zero: no component.
NO_VARIANCE = 1e-10

Product = Callable[[np.ndarray], np.ndarray]


class Scaling:
    """Whole numbers x = floor(64 c) + 1000000 of usable vectors, less their
    means. n x - S is exact: means are split into a whole and a rest."""

    def __init__(self, d: int):
        self.d, self.n, self.whole, self.rest = d, 0, np.zeros(d, np.int64), np.zeros(d, np.int64)

    def learn(self, n: int, sums: list[int]) -> None:
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def whole_numbers(self, batch: pa.RecordBatch) -> np.ndarray:
        return np.floor(64 * matrix(batch, self.d).astype(np.float64)).astype(np.int64) + 1000000

    def scaled(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """n x - S, and which rows hold it exactly."""
        near = self.whole_numbers(batch) - self.whole
        fits = np.abs(near.astype(np.float64)).max(axis=1, initial=0) * self.n < 2.0 ** 62
        return near * self.n - self.rest, fits

    def values(self, batch: pa.RecordBatch) -> np.ndarray:
        """x - S / n, rounded once."""
        exact, fits = self.scaled(batch)
        if fits.all():
            return exact / self.n
        return (self.whole_numbers(batch) - self.whole) - self.rest / self.n


class Centred:
    """The rows of usable vectors with their scaling: sums over all of them."""

    def __init__(self, rows: DataFrame, d: int):
        self.rows, self.scaling = rows, Scaling(d)
        scaling = self.scaling

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(d + 1, np.int64)
            for batch in batches:
                for part in pieces_of(batch, d):
                    total[:d] += scaling.whole_numbers(part).sum(axis=0)
                    total[d] += part.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array(total)], ["at", "value"])

        sums = [0] * (d + 1)
        exact = F.sum(F.col("value").cast("decimal(38,0)"))
        for at, value in rows.mapInArrow(run, "at long, value long").groupBy("at").agg(exact).collect():
            sums[at] = int(value)
        self.n = sums[d]
        if self.n:
            scaling.learn(self.n, sums[:d])

    def summed(self, part_sums: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum, over all rows, of a flat array that ``part_sums`` makes of
        some centred rows."""
        scaling = self.scaling

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for part in pieces_of(batch, scaling.d):
                    total += part_sums(scaling.values(part))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["at", "value"])

        sums = self.rows.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
        found, out = sums.toArrow(), np.zeros(size)
        out[found["at"].to_numpy()] = found["value"].to_numpy()
        return out

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times a block of vectors: one pass over the rows."""
        sums = self.summed(lambda x: (x.T @ (x @ block)).reshape(-1), block.size)
        return sums.reshape(block.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda x: np.array([np.square(x).sum()]), 1)[0] / self.n)


def minres(apply: Product, right: np.ndarray, steps: int, accuracy: float) -> np.ndarray:
    """An approximate solution of apply(x) = right for every column by itself,
    for a symmetric ``apply``."""
    tiny = np.finfo(float).tiny
    norm = np.sqrt(np.square(right).sum(axis=0))
    v, v_old = right / np.maximum(norm, tiny), np.zeros_like(right)
    x, w, w_old = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    cos, cos_old, sin, sin_old = (np.full(len(norm), value) for value in (1.0, 1.0, 0.0, 0.0))
    beta, left = np.zeros(len(norm)), norm.copy()
    for _ in range(steps):
        image = apply(v)
        alpha = (v * image).sum(axis=0)
        image = image - alpha * v - beta * v_old
        after = np.sqrt(np.square(image).sum(axis=0))
        main = cos * alpha - cos_old * sin * beta
        length = np.maximum(np.hypot(main, after), tiny)
        turn = (v - sin_old * beta * w_old - (sin * alpha + cos_old * cos * beta) * w) / length
        cos_old, sin_old, cos, sin = cos, sin, main / length, after / length
        x += cos * left * turn
        left = -sin * left
        w_old, w, v_old, beta = w, turn, v, after
        v = np.where(after > 1e-14 * np.maximum(norm, tiny), image / np.maximum(after, tiny), 0.0)
        if (np.abs(left) <= accuracy * norm).all():
            break
    return x


def _beside(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the block adds to a basis."""
    block = block / np.maximum(np.sqrt(np.square(block).sum(axis=0)), np.finfo(float).tiny)
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10]
    return block[:, : len(basis) - basis.shape[1]]


def leading(product: Product, d: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors, of a
    symmetric operator without negative eigenvalues."""
    start = min(d, wanted + GUARD)
    most = min(d, 4 * wanted + GUARD)
    basis = np.linalg.qr(np.random.default_rng(13).standard_normal((d, start)))[0]
    image = product(basis)
    best, waited = np.full(wanted, np.inf), np.zeros(wanted, int)
    while True:
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, images = basis @ turn, image @ turn
        value, vector = values[:wanted], ritz[:, :wanted]
        residual = images[:, :wanted] - vector * value
        residual -= vector @ (vector.T @ residual)
        norm = np.sqrt(np.square(residual).sum(axis=0))
        gain = norm < best / 2
        waited = np.where(gain, 0, waited + 1)
        best = np.minimum(best, norm)
        open_pairs = np.flatnonzero((norm > LOCKED * max(values[0], 0.0)) & (waited < PATIENCE))
        if not len(open_pairs) or basis.shape[1] == d:
            return value, vector
        shift = value[open_pairs]

        def corrected(block: np.ndarray) -> np.ndarray:
            out = product(block) - block * shift
            return out - vector @ (vector.T @ out)

        step = minres(corrected, -residual[:, open_pairs], INNER_STEPS, INNER_ACCURACY)
        if basis.shape[1] + len(open_pairs) > most:
            kept = wanted + GUARD
            basis, image = ritz[:, :kept], images[:, :kept]
        more = _beside(step, basis)
        if not more.shape[1]:
            return value, vector
        basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])


def whitened(
    rows: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for
    every row with a usable vector and every component.

    Rows whose vector is null, empty, holds a null or non-finite entry, or has
    another length than the commonest one are left out. Rows with a null or a
    repeated identifier, and repeated vectors, count and stay one by one; other
    columns are ignored. There are at most as many components as directions
    with variance: none for an empty table, a single row or equal rows, which
    gives no rows. ``deviation`` is null where the exact number exceeds a long.
    """
    found, d = usable(rows, vector_column, [F.col(id_column).alias("vec_id")])
    kind = found.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    centred = Centred(found, d) if d else None
    trace = centred.trace() if centred and centred.n else 0.0
    if not trace > 0:
        return rows.sparkSession.createDataFrame([], schema)
    values, vectors = leading(centred.product, d, min(components, d))
    real = values > NO_VARIANCE * values[0]
    values, vectors = values[real], vectors[:, real]
    k, n, scaling = len(values), centred.n, centred.scaling
    scale = vectors / np.sqrt(values)
    mean = centred.summed(lambda x: (x @ scale).sum(axis=0), k) / n

    def outer(x: np.ndarray) -> np.ndarray:
        z = x @ scale - mean
        return (z.T @ z).reshape(-1)

    error = float(np.abs(centred.summed(outer, k * k).reshape(k, k) / n - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, d):
                exact, fits = scaling.scaled(part)
                fits &= np.square(exact.astype(np.float64)).sum(axis=1) < 2.0 ** 63 * (1 - 1e-9)
                deviation = np.where(fits[:, None], exact, 0)
                deviation = np.square(deviation).sum(axis=1)
                count = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(np.repeat(np.arange(count), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, n)),
                        pa.array(np.repeat(deviation, k), mask=np.repeat(~fits, k)),
                        pa.array((scaling.values(part) @ scale).reshape(-1)),
                        pa.array(np.tile(values / trace, count)),
                        pa.array(np.full(count * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return found.mapInArrow(run, schema)
