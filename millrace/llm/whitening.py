"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V is never formed from the data at once. One pass over the centred vectors X
gives XᵀXQ / n for a block Q of directions. A polynomial of V, built by the Chebyshev
recurrence of such passes, damps the part of the spectrum that is not wanted; QR and
Rayleigh-Ritz turn the block into approximate eigenvectors. That is repeated until residuals
certify every wanted pair, and until what lies outside the block is shown to hold no larger
eigenvalue.

Vectors are whole numbers (``fixed_point`` makes them), so sums, means and squared deviations
are exact and do not depend on how the table is partitioned. A task sends one d x p matrix,
matrices are added on executors first where there are many, and the driver holds a few.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

BLOCK_BYTES = 4 << 20
#: Passes of one filter, and filters before the block is doubled.
DEGREE, PATIENCE = 10, 12
#: Residual norm, in parts of the largest eigenvalue, that certifies a pair.
RESIDUAL = 1e-13
#: Directions with less variance than this part of the largest have none but rounding.
NO_VARIANCE = 1e-10
#: Matrices that the driver adds itself; more are added in groups on executors.
FEW = 64
#: Vectors that look for eigenvalues outside the block.
PROBES = 16
SEED = 20240711


def fixed_point(vector: Column, scale: int, offset: int = 0) -> Column:
    """array<long> of floor(scale * entry) + offset; null where an entry is null, not finite or beyond 2^61."""
    scaled = lambda c: F.floor(c.cast("double") * F.lit(float(scale)))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) * F.lit(float(scale)) >= F.lit(float(1 << 61)))
    return F.when(~F.exists(vector, bad), F.transform(vector, lambda c: scaled(c) + F.lit(offset).cast("long")))


@dataclass(frozen=True)
class Blocks:
    """Staged vectors: ids (array) and x (rows of 64-bit numbers, as bytes) of some rows each."""

    frame: DataFrame
    dim: int
    partitions: int

    def each(self, function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over all blocks of ``function`` of a block's rows; every task returns one sum."""
        dim = self.dim

        def run(batches):
            total = None
            for batch in batches:
                for data in batch.column("x"):
                    part = function(np.frombuffer(data.as_buffer(), np.int64).reshape(-1, dim))
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "total": [total.tobytes()]}
                )

        sums = self.frame.select("x").mapInArrow(run, "part int, total binary")
        if self.partitions > FEW:

            def add(rows):
                ordered = sorted(zip(rows.column("part").to_pylist(), rows.column("total").to_pylist()))
                total = sum(np.frombuffer(t) for _, t in ordered)
                return pa.table({"part": pa.array([ordered[0][0]], pa.int32()), "total": [total.tobytes()]})

            groups = int(self.partitions**0.5)
            sums = sums.groupBy((F.col("part") % groups).alias("slot")).applyInArrow(add, "part int, total binary")
        found = sorted((r["part"], bytes(r["total"])) for r in sums.collect())
        return sum(np.frombuffer(t) for _, t in found)

    def exact(self, function: Callable[[np.ndarray], list[int]]) -> list[int]:
        """Sum over all blocks of whole numbers, one for each dimension, of any size up to 38 digits."""
        dim = self.dim

        def run(batches):
            total = [0] * dim
            for batch in batches:
                for data in batch.column("x"):
                    part = function(np.frombuffer(data.as_buffer(), np.int64).reshape(-1, dim))
                    total = [a + int(b) for a, b in zip(total, part)]
            yield pa.RecordBatch.from_pydict(
                {"j": pa.array(range(dim), pa.int32()), "v": pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))}
            )

        sums = self.frame.select("x").mapInArrow(run, "j int, v decimal(38,0)").groupBy("j").agg(F.sum("v").alias("v"))
        found = {r["j"]: int(r["v"]) for r in sums.collect()}
        return [found[j] for j in range(dim)]


def blocks(vectors: DataFrame, vector_col: str, id_col: str) -> Blocks | None:
    """The usable vectors as staged blocks; None if there are none.

    Null vectors, vectors with null entries and empty vectors are left out, and so are those
    that do not have the most frequent length (of equally frequent ones the greatest).
    """
    x = F.col(vector_col)
    usable = vectors.select(F.col(id_col).alias("id"), x.cast("array<long>").alias("x")).where(
        x.isNotNull() & ~F.exists(x, lambda c: c.isNull()) & (F.size(x) > 0)
    )
    lengths = usable.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    if common is None:
        return None
    dim = common["dim"]
    step = max(1, BLOCK_BYTES // (8 * dim))
    id_type = usable.schema["id"].dataType.simpleString()

    def pack(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id"))
                data = np.asarray(part.column("x").flatten(), np.int64).tobytes()
                yield pa.RecordBatch.from_arrays([ids, pa.array([data], pa.binary())], names=["ids", "x"])

    packed = usable.where(F.size("x") == dim).mapInArrow(pack, f"ids array<{id_type}>, x binary")
    frame = stage(packed, "vector-blocks")
    return Blocks(frame, dim, frame.rdd.getNumPartitions())


@dataclass(frozen=True)
class Centre:
    """The exact mean: ``whole`` + ``rest`` / n in each dimension, with 0 <= rest < n."""

    n: int
    whole: np.ndarray
    rest: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Of each row, the exact sum of (n * x - S)^2 over the dimensions."""
        u = x - self.whole
        largest = self.n * (int(np.abs(u).max(initial=0)) + 1)
        if largest * largest * x.shape[1] < 1 << 63:
            away = u * self.n - np.array(self.rest, np.int64)
            return (away * away).sum(1).tolist()
        return [sum((self.n * a - r) ** 2 for a, r in zip(row, self.rest)) for row in u.tolist()]


def _column_sums(x: np.ndarray) -> list[int]:
    if int(np.abs(x).max(initial=0)) < (1 << 62) // max(1, len(x)):
        return x.sum(0).tolist()
    return x.astype(object).sum(0).tolist()


def centre_of(data: Blocks) -> Centre:
    n = int(data.each(lambda x: np.array([float(len(x))]))[0])
    sums = data.exact(_column_sums)
    return Centre(n, np.array([s // n for s in sums], np.int64), [s % n for s in sums])


def trace_of(data: Blocks, centre: Centre) -> Fraction:
    """The exact sum of the variances."""
    whole = centre.whole

    def squares(x):
        u = x - whole
        if int(np.abs(u).max(initial=0)) ** 2 < (1 << 62) // max(1, len(x)):
            return (u * u).sum(0).tolist()
        u = u.astype(object)
        return (u * u).sum(0).tolist()

    total = data.exact(squares)
    return sum((Fraction(t) - Fraction(r * r, centre.n) for t, r in zip(total, centre.rest)), Fraction(0)) / centre.n


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: values falling, the block and V times it turned to them."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    return values, q @ turn, vq @ turn


def _filtered(times: Callable[[np.ndarray], np.ndarray], q, vq, top: float, cut: float, degree: int) -> np.ndarray:
    """Chebyshev polynomial of V on the block: of size at most one on [0, cut], scaled by its growth at ``top``."""
    centre = half = cut / 2
    sigma = first = half / (top - centre)
    y, before = (vq - centre * q) * (sigma / half), q
    for _ in range(degree - 1):
        new = 1 / (2 / first - sigma)
        y, before = 2 * (times(y) - centre * y) * (new / half) - sigma * new * before, y
        sigma = new
    return y


def eigenpairs(times: Callable[[np.ndarray], np.ndarray], dim: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors (columns) of a positive semidefinite V.

    ``times`` multiplies a block by V. Pairs count as certified when all residuals
    |Vq - eq| are at most 1e-13 of the largest eigenvalue and nothing larger is found outside the
    block: exactly, if the rest of the space is small, else by a filtered block of random
    vectors. A block that does not converge is doubled; one that spans the space is exact.
    """
    rng = np.random.default_rng(SEED)
    wanted = min(k, dim)
    width = min(dim, wanted + max(8, wanted // 2))
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    turns = 0
    while True:
        values, q, vq = _ritz(q, times(q))
        top = values[0]
        if top <= 0:
            return np.zeros(wanted), q[:, :wanted]
        residuals = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0)
        cut = min(max(values[-1], NO_VARIANCE * top), values[0] * (1 - 1e-9))
        if q.shape[1] == dim or residuals.max() <= RESIDUAL * top * dim**0.5:
            probes = min(dim - q.shape[1], PROBES)
            if not probes:
                break
            outside = rng.standard_normal((dim, probes))
            outside = np.linalg.qr(outside - q @ (q.T @ outside))[0]
            v_outside = times(outside)
            if probes < dim - q.shape[1]:  # not the whole rest of the space: let the filter look further
                outside = _filtered(times, outside, v_outside, top, cut, DEGREE)
                outside = np.linalg.qr(outside - q @ (q.T @ outside))[0]
                v_outside = times(outside)
            if _ritz(outside, v_outside)[0][0] <= values[wanted - 1] + RESIDUAL * top * dim:
                break
            q = np.linalg.qr(np.hstack([q, outside]))[0]
            continue
        turns += 1
        if turns % PATIENCE == 0:
            more = rng.standard_normal((dim, min(dim - q.shape[1], q.shape[1])))
            q = np.linalg.qr(np.hstack([q, more]))[0]
            continue
        q = np.linalg.qr(_filtered(times, q, vq, top, cut, DEGREE))[0]
    return values[:wanted], q[:, :wanted]


@dataclass(frozen=True)
class Whitening:
    """What a table's vectors are whitened with: mean, eigenvalues, eigenvectors (columns), share of the variance."""

    centre: Centre
    values: np.ndarray
    components: np.ndarray
    explained: list[float]
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.values)


def fit(data: Blocks, k: int = 32) -> Whitening:
    """The k leading components of all vectors; fewer where fewer directions have any variance."""
    centre = centre_of(data)
    trace = trace_of(data, centre)

    def times(q):
        def part(x):
            z = centre.centred(x)
            return (z.T @ (z @ q)).ravel()

        return data.each(part).reshape(q.shape) / centre.n

    values, components = eigenpairs(times, data.dim, k)
    real = values > NO_VARIANCE * values[0] if values[0] > 0 else np.zeros(len(values), bool)
    values, components = values[real], components[:, real]
    model = Whitening(centre, values, components, [float(v) / float(trace) for v in values], 0.0)
    if not len(values):
        return model
    mean = data.each(lambda x: model.whitened(x).sum(0)) / centre.n

    def spread(x):
        w = model.whitened(x) - mean
        return (w.T @ w).ravel()

    covariance = data.each(spread).reshape(len(values), -1) / centre.n
    error = float(np.abs(covariance - np.eye(len(values))).max())
    return Whitening(centre, values, components, model.explained, error)


def whiten(vectors: DataFrame, vector_col: str, id_col: str, k: int = 32) -> DataFrame:
    """One row per usable vector: id, n, deviation, whitened (array of up to k), explained (array), identity_error.

    Vectors are arrays of whole numbers within 2^61, see ``fixed_point``. The fit is on all usable vectors:
    null vectors, vectors with null entries, empty ones and those not of the most frequent
    length are left out. ``n`` counts them; ``deviation`` is the exact sum of (n * x - S)^2
    (null beyond 38 digits), ``whitened`` the centred vector on each component over the root of
    its eigenvalue, ``explained`` the eigenvalue's share of the variance, ``identity_error``
    the largest absolute entry of the covariance of ``whitened`` minus the identity.

    Components come by falling eigenvalue, either sign, the same for all rows; of equal
    eigenvalues any basis may be returned. Directions without variance are no components: with
    equal vectors, or one, the arrays are empty. Ids are only carried along: null and
    repeated ids and repeated rows count and are returned row by row. An empty table gives no
    rows; other columns, whatever their names, are not read. Very long vectors are worked
    on whole: a task holds one block of rows and two matrices of dimension x 1.5 k.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    data = blocks(vectors, vector_col, id_col)
    model = fit(data, k) if data is not None else None
    schema = f"id {id_type}, n long, deviation decimal(38,0), whitened array<double>"
    if model is None:
        empty = vectors.sparkSession.createDataFrame([], schema)
        return empty.select("*", F.array().cast("array<double>").alias("explained"), F.lit(0.0).alias("identity_error"))
    dim, n = data.dim, model.centre.n

    def run(batches):
        for batch in batches:
            for ids, block in zip(batch.column("ids"), batch.column("x")):
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dim)
                found = model.whitened(x)
                sizes = np.arange(len(x) + 1, dtype=np.int32) * found.shape[1]
                away = [Decimal(v) if v < 10**38 else None for v in model.centre.deviations(x)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values, pa.array(np.full(len(x), n), pa.int64()), pa.array(away, pa.decimal128(38, 0)),
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(found.ravel(), pa.float64())),
                    ],
                    names=["id", "n", "deviation", "whitened"],
                )

    explained = F.array(*[F.lit(e) for e in model.explained]).cast("array<double>")
    return data.frame.mapInArrow(run, schema).select(
        "*", explained.alias("explained"), F.lit(model.identity_error).alias("identity_error")
    )
