"""Missing-value removal and the interquartile-range fence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import complete, missing
from millrace.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Fence:
    """Quartiles of a column and the inclusive range of values kept."""

    q1: float
    q3: float
    lower: float
    upper: float

    @classmethod
    def from_quartiles(cls, q1: float, q3: float, k: float = 1.5) -> "Fence":
        reach = k * (q3 - q1)
        return cls(q1, q3, q1 - reach, q3 + reach)


def drop_missing(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows in which every required column is present."""
    return df.where(complete(df, required))


def cleaning_report(df: DataFrame, required: list[str]) -> DataFrame:
    """One row: rows before and after the removal, rows dropped, missing per column."""
    ok = F.count_if(complete(df, required))
    return df.agg(
        F.count("*").alias("rows_before"),
        ok.alias("rows_after"),
        (F.count("*") - ok).alias("rows_dropped"),
        *[F.count_if(missing(df, c)).alias(f"missing_{c}") for c in required],
    )


def iqr_fence(df: DataFrame, value: str, k: float = 1.5) -> Fence:
    """Exact fence of a column. Two scans; two numbers come back to the driver, so that
    the filter below is a literal range that reaches the file scan."""
    row = exact_quantiles(df, value, {"q1": 0.25, "q3": 0.75}).first()
    if row["q1"] is None:
        raise ValueError(f"no values in column {value}")
    return Fence.from_quartiles(row["q1"], row["q3"], k)


def within_fence(df: DataFrame, value: str, fence: Fence) -> DataFrame:
    """Rows inside the fence, both ends included."""
    # NaN sorts above every number in Spark, so the upper bound drops it too.
    return df.where(F.col(value).between(fence.lower, fence.upper))


def fence_report(df: DataFrame, value: str, fence: Fence) -> DataFrame:
    """One row: the fence and the rows before, after and removed."""
    kept = F.count_if(F.col(value).between(fence.lower, fence.upper))
    return df.agg(
        F.lit(fence.q1).alias("q1"),
        F.lit(fence.q3).alias("q3"),
        F.lit(fence.q3 - fence.q1).alias("iqr"),
        F.lit(fence.lower).alias("lower"),
        F.lit(fence.upper).alias("upper"),
        F.count("*").alias("rows_before"),
        kept.alias("rows_after"),
        (F.count("*") - kept).alias("rows_removed"),
    )


def clean(df: DataFrame, required: list[str], value: str, k: float = 1.5) -> tuple[DataFrame, Fence]:
    """Drop incomplete rows, then rows outside the fence of what is left."""
    present = drop_missing(df, required)
    fence = iqr_fence(present, value, k)
    return within_fence(present, value, fence), fence


def fence_frame(spark: SparkSession, fence: Fence) -> DataFrame:
    """The fence as a one-row DataFrame."""
    return spark.createDataFrame(
        [(fence.q1, fence.q3, fence.q3 - fence.q1, fence.lower, fence.upper)],
        "q1 double, q3 double, iqr double, lower double, upper double",
    )
