"""Least squares for any subset of features from one matrix of co-moments.

One scan of the complete rows gives the co-moments of all features and the target. The sweep
operator then brings features into the regression and takes them out again, each in a step
on a k x k matrix, so that all subsets are fitted without another look at the data. Squared
errors on other rows follow from the co-moments of those rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import complete
from millrace.operators.comoments import comoments

#: A column whose variance is this part unexplained by the columns before it adds nothing.
SINGULAR = 1e-10
#: Features that all subsets are listed for at most: 2^16 fits.
MOST_FEATURES = 16


@dataclass(frozen=True)
class Moments:
    """Rows, means and co-moments of the columns of a design; the target is the last."""

    n: int
    mean: np.ndarray
    cross: np.ndarray


@dataclass(frozen=True)
class Design:
    """Numeric columns and, of each categorical one, a 0/1 column per level but the first.

    Leaving one level out keeps the columns independent of the intercept. ``parts`` has the
    columns of each feature. Levels not listed, and null, count as the first level.
    """

    numeric: tuple[str, ...]
    levels: dict[str, tuple]
    target: str

    @classmethod
    def of(cls, df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str] = (), most_levels: int = 1000) -> "Design":
        """The levels that occur in ``df``, in their order; more than ``most_levels`` in a column are an error."""
        levels = {}
        for c in categorical:
            found = df.select(c).where(F.col(c).isNotNull()).distinct().limit(most_levels + 1).collect()
            if len(found) > most_levels:
                raise ValueError(f"column {c} has more than {most_levels} levels")
            levels[c] = tuple(sorted(r[0] for r in found))
        return cls(tuple(numeric), levels, target)

    @property
    def parts(self) -> dict[str, list[int]]:
        out = {c: [i] for i, c in enumerate(self.numeric)}
        at = len(self.numeric)
        for c, values in self.levels.items():
            out[c] = list(range(at, at + max(0, len(values) - 1)))
            at += len(out[c])
        return out

    def moments(self, df: DataFrame) -> Moments:
        """Co-moments over the rows in which all numeric columns and the target are present."""
        columns = [F.col(c).cast("double") for c in self.numeric]
        for c, values in self.levels.items():
            columns += [F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0)) for v in values[1:]]
        columns.append(F.col(self.target).cast("double"))
        names = [f"x{i}" for i in range(len(columns))]
        rows = df.where(complete(df, [*self.numeric, self.target])).select(*[c.alias(n) for c, n in zip(columns, names)])
        found = comoments(rows, names)
        return Moments(int(found.n[0, 0]), found.mean.diagonal().copy(), found.cross)


def sweep(a: np.ndarray, k: int) -> None:
    """Bring column ``k`` into the regression, or take it out if it is in; in place."""
    pivot = a[k, k]
    row, column = a[k, :].copy(), a[:, k].copy()
    a -= np.outer(column, row) / pivot
    a[k, :], a[:, k] = row / abs(pivot), column / abs(pivot)
    a[k, k] = -1 / pivot


def _scaled(moments: Moments) -> tuple[np.ndarray, np.ndarray]:
    """The matrix to sweep: co-moments over the roots of the column's own, and those roots."""
    scale = np.sqrt(np.where(moments.cross.diagonal() > 0, moments.cross.diagonal(), 1.0))
    return moments.cross / np.outer(scale, scale), scale


def fit(train: Moments, columns: Sequence[int]) -> tuple[np.ndarray, float]:
    """Coefficients (0 for columns that depend on earlier ones) and the residual sum of squares."""
    last = len(train.mean) - 1
    a, scale = _scaled(train)
    used = []
    for k in columns:
        if a[k, k] > SINGULAR:
            sweep(a, k)
            used.append(k)
    coefficients = np.zeros(last)
    coefficients[used] = a[used, last] * scale[last] / scale[used]
    return coefficients, float(a[last, last] * scale[last] ** 2)


def r_squared_on(train: Moments, test: Moments, columns: Sequence[int]) -> float | None:
    """R squared on the rows of ``test`` of the regression fitted on those of ``train``; None without spread."""
    last = len(train.mean) - 1
    b, residual = fit(train, columns)
    spread = test.cross[last, last]
    if not spread > 0:
        return None
    if test is not train:
        away = (test.mean[last] - train.mean[last]) - b @ (test.mean[:last] - train.mean[:last])
        residual = spread - 2 * b @ test.cross[:last, last] + b @ test.cross[:last, :last] @ b + test.n * away * away
    return float(1 - residual / spread)


def all_subsets(df: DataFrame, target: str, features: Sequence[str], always: Sequence[str] = ()) -> DataFrame:
    """R squared of the regression on every non-empty subset of numeric ``features``: ``feature_set, n_features, r2``.

    The categorical columns ``always`` are in every regression. Subsets are named by their
    features in the order given, joined by ``+``. The table is scanned once, and each subset is
    one sweep away from the subset without its last feature. Rows with a missing value are
    left out; ``r2`` is null where the target has no spread. A feature that depends on those
    before it adds nothing.
    """
    if len(features) > MOST_FEATURES:
        raise ValueError(f"at most {MOST_FEATURES} features have their subsets listed")
    design = Design.of(df, target, features, always)
    train = design.moments(df)
    last = len(train.mean) - 1
    base, _ = _scaled(train)
    for k in (k for c in always for k in design.parts[c]):
        if base[k, k] > SINGULAR:
            sweep(base, k)
    rows = []

    def grow(a: np.ndarray, chosen: tuple[int, ...]) -> None:
        for k in range(chosen[-1] + 1 if chosen else 0, len(features)):
            more = a.copy()
            if more[k, k] > SINGULAR:
                sweep(more, k)
            names = "+".join(features[i] for i in (*chosen, k))
            rows.append((names, len(chosen) + 1, float(1 - more[last, last]) if train.cross[last, last] > 0 else None))
            grow(more, (*chosen, k))

    grow(base, ())
    return df.sparkSession.createDataFrame(rows, "feature_set string, n_features int, r2 double")
