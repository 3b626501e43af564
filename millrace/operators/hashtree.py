"""Reconcile two tables by a hash tree: only the parts that differ are looked at row by row.

Rows fall into buckets by the leading bits of a hash of their key. Both sides are reduced to
a count and an order-free checksum per bucket. Where these agree the rows agree; buckets
that differ are split by the next bits, until few rows are left, which are then compared as
they are. Tables that agree cost one pass over each and no shuffle of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import quoted
from millrace.session import stage

BITS = 12  # of the key hash that one level looks at
DEEPEST = 5  # levels: 60 of 64 bits
#: Rows in differing buckets that are compared without another level.
FEW_ROWS = 1_000_000
#: Differing buckets that a level splits at most; a difference so wide is compared at once.
MANY_BUCKETS = 4096


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def _bucket(keys: Sequence[str], level: int) -> Column:
    """The leading bits of the key hash down to a level."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(7), *_cols(keys)), 64 - BITS * level)


def bucket_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str], level: int = 1) -> DataFrame:
    """Per bucket: rows, and the sums of the 32-bit halves of two 64-bit hashes of each row.

    Sums do not depend on the order of rows and count repeated rows; they are exact for two
    billion rows per bucket, and combined before the shuffle. Nulls differ from all values.
    """
    # the pattern of nulls is hashed too, because a null leaves a hash unchanged
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in _cols(columns)])
    h1 = F.xxhash64(F.lit(1), nulls, *_cols(columns))
    h2 = F.xxhash64(F.lit(2), nulls, *reversed(_cols(columns)))
    low = F.lit((1 << 32) - 1).cast("bigint")
    return (
        df.select(_bucket(keys, level).alias("bucket"), h1.alias("h1"), h2.alias("h2"))
        .groupBy("bucket")
        .agg(
            F.count("*").alias("rows"),
            *[F.sum(part).alias(f"s{i}") for i, part in enumerate(
                p for h in ("h1", "h2") for p in (F.shiftright(h, 32), F.col(h).bitwiseAND(low))
            )],
        )
    )


def _differing(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], level: int) -> DataFrame:
    """Buckets whose sums differ, with their rows on both sides together."""
    sums = ["rows", *[f"s{i}" for i in range(4)]]
    a = bucket_sums(left, keys, columns, level)
    b = bucket_sums(right, keys, columns, level).select("bucket", *[(-F.col(c)).alias(c) for c in sums])
    both = a.unionByName(b).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in sums], F.sum(F.abs("rows")).alias("held"))
    return both.where(reduce(lambda x, y: x | y, [F.col(c) != 0 for c in sums])).select("bucket", "held")


def touched_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame | None, int]:
    """Staged buckets that differ and the level they are of; None if the tables agree."""
    inside_left, inside_right, found, level = left, right, None, 0
    while level < DEEPEST:
        level += 1
        found = stage(_differing(inside_left, inside_right, keys, columns, level), "differing-buckets")
        size = found.agg(F.count("*").alias("n"), F.coalesce(F.sum("held"), F.lit(0)).alias("held")).first()
        if not size["n"]:
            return None, level
        if size["held"] <= FEW_ROWS or size["n"] > MANY_BUCKETS:
            break
        inside_left, inside_right = (_within(side, keys, found, level) for side in (left, right))
    return found, level


def _within(df: DataFrame, keys: Sequence[str], buckets: DataFrame, level: int) -> DataFrame:
    """Rows in the buckets. The staged list has a known size, by which Spark chooses the join."""
    return df.join(buckets.select(F.col("bucket").alias("_bucket")), _bucket(keys, level) == F.col("_bucket"), "left_semi")


def row_differences(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that one side has more often than the other: the columns, ``left_rows``, ``right_rows``.

    The tables are compared as multisets of rows over ``columns`` (all of ``left`` if not given),
    which must contain the keys; their order, partitions and repeated rows do not matter,
    and nulls equal nulls. A changed row is two rows here, one of each side. Tables that agree,
    empty ones too, give no rows.
    """
    columns = list(columns or left.columns)
    left, right = left.select(*_cols(columns)), right.select(*_cols(columns))
    buckets, level = touched_buckets(left, right, keys, columns)
    if buckets is None:
        return left.limit(0).select("*", F.lit(0).cast("bigint").alias("left_rows"), F.lit(0).cast("bigint").alias("right_rows"))
    a = _within(left, keys, buckets, level).select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    b = _within(right, keys, buckets, level).select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    counted = a.union(b).groupBy(*_cols(columns)).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
    return counted.where("left_rows <> right_rows")


def tables_agree(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows of each side, rows that each has more often than the other, and whether the tables agree."""
    columns = list(columns or left.columns)
    found = stage(row_differences(left, right, keys, columns), "row-differences")
    more = lambda a, b: F.coalesce(F.sum(F.greatest(F.col(a) - F.col(b), F.lit(0))), F.lit(0))
    n = [df.agg(F.count("*")).scalar() for df in (left, right)]
    return found.agg(more("left_rows", "right_rows").alias("left_only"), more("right_rows", "left_rows").alias("right_only")).select(
        n[0].alias("left_rows"), n[1].alias("right_rows"), "left_only", "right_only",
        ((F.col("left_only") == 0) & (F.col("right_only") == 0)).alias("agrees"),
    )
