"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_duplicates(df: DataFrame, keys: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Distinct rows, or one row per key.

    With keys, the row that comes first by ``order`` (then by all other columns) stays.
    It is found by a ``min`` over a struct, which combines map-side: a key that holds
    a third of all rows is never gathered and sorted in one task.
    """
    if not keys:
        return df.distinct()
    rest = [c for c in order if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    if not rest:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])
