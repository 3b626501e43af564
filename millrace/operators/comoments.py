"""Co-moments of all pairs of numeric columns in one scan, whatever pattern of values is missing.

For every pair the state has the rows in which both are present, the means and squared
deviations of each over those rows, and their co-moment. States of disjoint row sets merge
without loss of precision, so each task returns one state for its rows, states are merged in
groups on executors, and the driver merges a bounded number of k x k matrices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import quoted

#: States that reach the driver at most.
GROUPS = 32
#: Parts of the squared mean below which a variance is rounding.
ROUNDING = 1e-29


@dataclass(frozen=True)
class Comoments:
    """Matrices over pairs (i, j): rows with both, mean and squared deviations of column i, co-moment."""

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    cross: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> "Comoments":
        """State of the rows of ``x``, where NaN is a missing value."""
        here = ~np.isnan(x)
        endless = np.isinf(x)
        first = x[here.argmax(0), np.arange(x.shape[1])] if len(x) else np.zeros(x.shape[1])
        shift = np.where(np.isfinite(first), first, 0.0)
        z = np.where(here & ~endless, x - shift, 0.0)  # exactly zero in a constant column
        p = here.astype(np.float64)
        middle = z.sum(0) / np.maximum(p.sum(0), 1)
        z = np.where(here & ~endless, z - middle, 0.0)
        n = p.T @ p
        sums, squares = z.T @ p, (z * z).T @ p
        rows = np.maximum(n, 1)
        square = squares - sums * sums / rows
        square[square <= 1e-13 * squares] = 0.0
        cross = z.T @ z - sums * sums.T / rows
        if endless.any():  # no moments where an infinite value takes part
            bad = endless.astype(np.float64).T @ p > 0
            square[bad] = np.nan
            cross[bad | bad.T] = np.nan
        return cls(n, (shift + middle)[:, None] + sums / rows, square, cross)

    def merged(self, other: "Comoments") -> "Comoments":
        n = self.n + other.n
        rows = np.maximum(n, 1)
        apart = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        mean = np.where(self.n > 0, self.mean, other.mean) + apart * other.n / rows
        weight = self.n * other.n / rows
        return Comoments(
            n, mean, self.square + other.square + apart * apart * weight, self.cross + other.cross + apart * apart.T * weight
        )

    def packed(self) -> bytes:
        return np.stack([self.n, self.mean, self.square, self.cross]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> "Comoments":
        all_ = np.frombuffer(data)
        k = round((len(all_) / 4) ** 0.5)
        return cls(*all_.reshape(4, k, k))

    def varies(self) -> np.ndarray:
        """Where column i has a spread beyond rounding over the rows of the pair."""
        return self.square > ROUNDING * self.n * self.mean * self.mean

    def correlation(self) -> np.ndarray:
        """Pearson r of every pair over the rows with both; NaN where one of them is constant there."""
        both = self.varies() & self.varies().T
        with np.errstate(invalid="ignore", divide="ignore"):
            r = np.where(both, self.cross / np.sqrt(self.square * self.square.T), np.nan)
        return np.where(np.eye(len(r), dtype=bool) & both, 1.0, np.clip(r, -1.0, 1.0))


def comoments(df: DataFrame, columns: Sequence[str]) -> Comoments:
    """State of the columns over all rows; null and NaN are missing.

    One scan of the columns asked for. Columns may be any numeric type, and may be named twice.
    A table without rows gives pairs of no rows.
    """
    k = len(columns)
    wide = df.select(*[F.expr(f"cast({quoted(c)} as double)").alias(f"c{i}") for i, c in enumerate(columns)])

    def scan(batches):
        state = Comoments.of(np.zeros((0, k)))
        for batch in batches:
            state = state.merged(Comoments.of(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])))
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "state": [state.packed()]})

    def merge(rows: pa.Table) -> pa.Table:
        found = sorted(zip(rows.column("part").to_pylist(), rows.column("state").to_pylist()))
        return pa.table({"part": pa.array([found[0][0]], pa.int32()), "state": [_all_merged(s for _, s in found).packed()]})

    parts = wide.mapInArrow(scan, "part int, state binary")
    merged = parts.groupBy((F.col("part") % GROUPS).alias("slot")).applyInArrow(merge, "part int, state binary")
    found = sorted((r["part"], bytes(r["state"])) for r in merged.collect())
    return _all_merged((s for _, s in found), k)


def _all_merged(states, k: int | None = None) -> Comoments:
    total = None
    for s in states:
        state = Comoments.unpacked(s)
        total = state if total is None else total.merged(state)
    return Comoments.of(np.zeros((0, k))) if total is None else total
