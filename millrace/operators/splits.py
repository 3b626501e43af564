"""Stratified split with exact sizes that does not depend on partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.quantiles import order_statistics
from millrace.session import stage

ROW = "_row_number"
CHUNK = 1 << 16


def allocate(sizes: dict, fraction: float) -> dict:
    """Test rows per class: ceil(fraction * n) in all, shared by largest remainder."""
    n = sum(sizes.values())
    wanted = math.ceil(fraction * n)
    exact = {c: s * wanted / n for c, s in sizes.items()}
    got = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(sizes, key=lambda c: (got[c] - exact[c], str(c)))
    for c in by_remainder[: wanted - sum(got.values())]:
        got[c] += 1
    return got


def _per_class(label: str, values: dict) -> Column:
    """A lookup of class values; the plan does not grow deeper with the number of classes."""
    known = {c: v for c, v in values.items() if c is not None}
    found = F.lit(None).cast("bigint")
    if known:
        table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        found = F.try_element_at(table, F.col(label)).cast("bigint")
    return F.when(F.col(label).isNull(), F.lit(values.get(None)).cast("bigint")).otherwise(found)


def _numbered_copies(df: DataFrame) -> DataFrame:
    """The rows with a number among their copies: copies are counted, which combines before
    the shuffle, and made again in chunks, so that no task has to number a large group."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / CHUNK)))
    chunks = counted.withColumn("_chunk", chunk).repartition(*df.columns, "_chunk")
    last = F.least(F.col("_copies"), (F.col("_chunk") + 1) * CHUNK) - 1
    return chunks.select(*df.columns, F.explode(F.sequence(F.col("_chunk") * CHUNK, last)).alias(ROW))


def stratified_split(
    df: DataFrame, label: str, fraction: float = 0.2, seed: int = 42, key: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(train, test). Rows are ordered by a seeded hash; in each class those up to the exact
    cut value go to the test side.

    ``key`` names columns that tell rows apart; they go into the hash and not into the
    result. Without a key, copies of a row are numbered in a staged table and the number goes
    into the hash, so rows alike in all columns are spread over both sides like any others.
    Either way the same rows go to the test side however the table is partitioned.

    Rows equal in key and all columns share a hash. When the cut falls among such copies,
    the needed number of copies is generated for each side: copies are interchangeable, and
    no task has to number them one by one. The table is scanned four times before the two
    sides are read; stage it first when it comes from a join.
    """
    if not key:
        df, key = stage(_numbered_copies(df), "numbered"), [ROW]
    train, test = _split(df, label, fraction, seed)
    return train.drop(*key), test.drop(*key)


def _split(df: DataFrame, label: str, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    spark = df.sparkSession
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    take = allocate(sizes, fraction)
    hashed = df.withColumn("_h", F.xxhash64(F.lit(seed), *df.columns))
    cuts = order_statistics(
        hashed.where(_per_class(label, take) > 0),
        "_h",
        1,
        lambda n, _: F.least(_per_class(label, take), n) - 1,
        by=[label],
    )
    found = cuts.collect()
    cut = {r[label]: r["at0"] for r in found}
    need = {r[label]: take[r[label]] - r["below0"] for r in found}
    h, at = F.col("_h"), _per_class(label, cut)
    below = F.coalesce(h < at, F.lit(False))
    level = F.coalesce(h == at, F.lit(False))
    if all(r["equal0"] == need[r[label]] for r in found):
        to_test = below | level
        return hashed.where(~to_test).drop("_h"), hashed.where(to_test).drop("_h")

    # Copies of a few distinct rows sit exactly on the cut.
    test = hashed.where(below).drop("_h")
    train = hashed.where(~below & ~level).drop("_h")
    copies = hashed.where(level).groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    for r in copies.orderBy(*[F.col(c).cast("string") for c in df.columns]).collect():
        k = min(need[r[label]], r["_copies"])
        need[r[label]] -= k
        one = [F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields]
        if k:
            test = test.unionByName(spark.range(k).select(*one))
        if r["_copies"] > k:
            train = train.unionByName(spark.range(r["_copies"] - k).select(*one))
    return train, test
