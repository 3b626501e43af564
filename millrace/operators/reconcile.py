"""Compare two results that should be equal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import beyond_tolerance, quoted


def by_key(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, tolerance: float = 0.01
) -> DataFrame:
    """One row per key of either side with both values and a status:
    ``match``, ``differs``, ``left_only`` or ``right_only``. Null keys match each other."""
    a = left.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.col(value).alias("left_value"), F.lit(1).alias("_a"))
    b = right.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col(value).alias("right_value"), F.lit(1).alias("_b"))
    on = reduce(lambda x, y: x & y, [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys])
    lv, rv = F.col("left_value"), F.col("right_value")
    same = lv.eqNullSafe(rv) | F.coalesce(~beyond_tolerance(lv, rv, tolerance), F.lit(False))
    return a.join(b, on, "full_outer").select(
        *[F.when(F.col("_a").isNotNull(), F.col(f"_a_{k}")).otherwise(F.col(f"_b_{k}")).alias(k) for k in keys],
        "left_value",
        "right_value",
        F.abs(lv - rv).alias("abs_diff"),
        F.when(F.col("_b").isNull(), "left_only")
        .when(F.col("_a").isNull(), "right_only")
        .when(same, "match")
        .otherwise("differs")
        .alias("status"),
    )


def grand_totals(left: DataFrame, right: DataFrame, value: str, tolerance: float = 0.01) -> DataFrame:
    """One row: the totals of both sides, their difference, and whether they agree."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.sum(value).alias(name))

    rt = one(right, "right_total").scalar()
    return one(left, "left_total").select(
        "left_total",
        rt.alias("right_total"),
        F.abs(F.col("left_total") - rt).alias("abs_diff"),
        (~beyond_tolerance(F.col("left_total"), rt, tolerance)).alias("agrees"),
    )


def column_agreement(left: DataFrame, right: DataFrame) -> DataFrame:
    """``column_name, left_rows, right_rows, agrees`` per column: present values of each side, and whether
    the two hold the same values equally often. Order does not matter, and each side is read once.

    Columns are compared by name; the sums of two hashes per value stand for the values. The two
    halves of a hash, as signed 32-bit numbers, have sums of their own: bigints hold those of 4
    billion values without overflow, and are added much faster than decimals.
    """
    names = left.columns

    def sums(df: DataFrame, side: str) -> DataFrame:
        parts = []
        for i, c in enumerate(names):
            v = F.col(quoted(c))
            hashes = [F.when(v.isNotNull(), F.xxhash64(F.lit(seed), v)) for seed in (1, 2)]
            halves = [F.sum(half) for h in hashes for half in (F.shiftright(h, 32), F.shiftright(F.shiftleft(h, 32), 32))]
            parts.append(F.struct(F.lit(i).alias("i"), F.count(v).alias(f"{side}_rows"), F.array(*halves).alias(f"{side}_sums")))
        return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))

    both = sums(left, "left").join(sums(right, "right"), "i")
    name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1)
    same = (F.col("left_rows") == F.col("right_rows")) & F.col("left_sums").eqNullSafe(F.col("right_sums"))
    return both.select(name.alias("column_name"), "left_rows", "right_rows", same.alias("agrees"))
