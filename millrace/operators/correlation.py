"""Correlation, variance inflation and collinear-feature removal.

One scan gives the co-moments of all pairs of columns; everything after works on the k x k
matrix. The plan does not grow with the number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from millrace.functions.columns import complete
from millrace.operators.comoments import comoments


def correlation_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The full matrix as ``x, y, r``, each pair over the rows where both are present.

    ``r`` is null where one of the two is constant there; so is the diagonal of a constant column.
    """
    return _long(df, columns, comoments(df, columns).correlation())


def _long(df: DataFrame, columns: Sequence[str], corr: np.ndarray) -> DataFrame:
    rows = [
        (x, y, None if np.isnan(corr[i, j]) else float(corr[i, j]))
        for i, x in enumerate(columns)
        for j, y in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, "x string, y string, r double")


def _matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """The correlation matrix; a constant column has 1 on the diagonal only."""
    corr = comoments(df, columns).correlation()
    np.fill_diagonal(corr, 1.0)
    return corr


def _vif_of(corr: np.ndarray) -> np.ndarray:
    """Diagonal of the inverse; NaN where the matrix cannot be inverted."""
    if np.isnan(corr).any() or np.linalg.cond(corr) > 1e12:
        return np.full(len(corr), np.nan)
    return np.diag(np.linalg.inv(corr))


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, vif``. Null for all when a column is constant or a combination of others.

    Incomplete rows are left out first, so that all pairs describe the same rows.
    """
    values = _vif_of(_matrix(df.where(complete(df, list(columns))), columns))
    return df.sparkSession.createDataFrame(
        [(c, None if np.isnan(v) else float(v)) for c, v in zip(columns, values)],
        "feature string, vif double",
    )


def _linked(corr: np.ndarray, members: list[int], link: float) -> list[list[int]]:
    """Split the members into sets connected by |r| >= link."""
    left, groups = set(members), []
    while left:
        todo, group = [min(left)], []
        while todo:
            i = todo.pop()
            if i in left:
                left.remove(i)
                group.append(i)
                todo += [j for j in left if abs(corr[i, j]) >= link]
        groups.append(sorted(group))
    return groups


def drop_collinear(
    df: DataFrame, columns: Sequence[str], target: str, threshold: float = 5.0, link: float = 0.5
) -> DataFrame:
    """Decide which features to keep: ``feature, vif, target_r, kept``.

    Features whose VIF exceeds the threshold are grouped by mutual correlation; of each
    group the one most correlated with the target stays (then the one with lower VIF).
    """
    present = df.where(complete(df, [*columns, target]))
    corr = _matrix(present, [*columns, target])
    k = len(columns)
    feats, tr = corr[:k, :k], np.abs(corr[:k, k])
    if np.isnan(feats).any():
        raise ValueError("a feature is constant; remove it before testing collinearity")
    first = _vif_of(feats)
    singular = np.isnan(first).any()
    high = list(range(k)) if singular else [i for i in range(k) if first[i] > threshold]
    kept = set(range(k)) - set(high)
    for group in _linked(feats, high, link):
        kept.add(min(group, key=lambda i: (-np.nan_to_num(tr[i]), first[i], i)) if len(group) > 1 else group[0])
    return df.sparkSession.createDataFrame(
        [
            (c, None if singular else float(first[i]), None if np.isnan(corr[i, k]) else float(corr[i, k]), i in kept)
            for i, c in enumerate(columns)
        ],
        "feature string, vif double, target_r double, kept boolean",
    )
