"""Summaries that new landings are merged into.

A state holds, per group, what a sum, mean and count are made of: exact integer parts of the
sum, whether all values fit them, the plain sum, and the number of values. States of
different rows merge by adding, so a landing is summarised once, its state is stored, and a
report reads states only. The result equals one run over all rows, bit for bit where the
values fit the units of ``scale`` decimals; other groups have plain sums, whose last digits
depend on the order of addition as in any run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import DECIMALS, fits, fixed_parts, fixed_total, missing, present

PARTS = ("_s0", "_s1", "_s2")
LANDING = "landing"


def summary_state(df: DataFrame, keys: Sequence[str], value: str, scale: int = DECIMALS) -> DataFrame:
    """``keys`` and the state of the present values of each group; null keys form groups."""
    v = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        *[F.sum(p).alias(n) for n, p in zip(PARTS, fixed_parts(v, scale))],
        F.coalesce(F.bool_and(fits(v, scale)), F.lit(True)).alias("_fits"),
        F.sum(present(v)).alias("_plain"),
        F.count(present(v)).alias("_n"),
    )


def _added() -> list[Column]:
    sums = [F.sum(c).alias(c) for c in (*PARTS, "_plain", "_n")]
    return [*sums, F.bool_and("_fits").alias("_fits")]


def merged(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States added up per group of ``keys``, which may be fewer than the state has."""
    return state.groupBy(*keys).agg(*_added())


def finish(state: DataFrame, keys: Sequence[str], value: str, scale: int = DECIMALS, order: bool = True) -> DataFrame:
    """``total_<value>, avg_<value>, item_count`` per group of ``keys``, as ``named_agg`` gives them.

    ``scale`` must be that of the state.
    """
    total = F.when(F.col("_fits"), fixed_total([F.col(p) for p in PARTS], scale)).otherwise(F.col("_plain"))
    sums = merged(state, keys).select(*keys, total.alias(f"total_{value}"), F.col("_n").alias("item_count"))
    mean = F.try_divide(F.col(f"total_{value}"), F.col("item_count").cast("double"))
    out = sums.select(*keys, f"total_{value}", mean.alias(f"avg_{value}"), "item_count")
    return out.orderBy(F.desc(f"total_{value}"), *keys) if order else out


def missing_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, missing, rows``: counts of missing values, which merge by adding."""
    columns = list(columns or df.columns)
    counts = [F.struct(F.lit(c).alias("column_name"), F.count_if(missing(df, c)).alias("missing"), F.count("*").alias("rows")) for c in columns]
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def merged_missing(state: DataFrame) -> DataFrame:
    """``column_name, missing_count, missing_pct`` over all landings, worst first."""
    sums = state.groupBy("column_name").agg(F.sum("missing").alias("missing_count"), F.sum("rows").alias("_rows"))
    pct = F.round(F.try_divide(F.col("missing_count") * 100.0, F.col("_rows").cast("double")), 3)
    return sums.select("column_name", "missing_count", pct.alias("missing_pct")).orderBy(F.desc("missing_count"), "column_name")


def store(state: DataFrame, path: str, landing: str) -> None:
    """Store the state of a landing. A landing stored again replaces its former state and no other."""
    named = state.withColumn(LANDING, F.lit(landing))
    named.write.partitionBy(LANDING).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The states of all landings, one row per landing and group; small beside the data."""
    return spark.read.parquet(path).drop(LANDING)
