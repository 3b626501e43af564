"""Grouped sums, means and counts, and the sorts that go with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import DECIMALS, mean, month_key, month_start, present, total
from millrace.operators.quantiles import exact_quantiles


def _named(df: DataFrame, value: str, scale: int | None) -> list[Column]:
    kind = df.schema[value].dataType
    count = F.count(present(F.col(value)) if isinstance(kind, T.FractionalType) else F.col(value))
    if isinstance(kind, (T.IntegralType, T.DecimalType)):  # decimal sums of these are exact at any size
        whole = F.sum(F.col(value).cast("decimal(20,0)") if isinstance(kind, T.IntegralType) else F.col(value))
        sums = [whole.cast("double"), F.try_divide(whole, count).cast("double")]
    else:
        sums = [total(F.col(value), scale), mean(F.col(value), scale)]
    return [sums[0].alias(f"total_{value}"), sums[1].alias(f"avg_{value}"), count.alias("item_count")]


def named_agg(
    df: DataFrame, keys: Sequence[str], value: str = "amount", scale: int | None = DECIMALS, order: bool = True
) -> DataFrame:
    """``total_<value>, avg_<value>, item_count`` per group, largest total first.

    Null keys form groups; missing values count in none of the three. Whole numbers,
    decimals and values of up to ``scale`` decimals are summed exactly, whatever the
    order of the rows; other values, and all with None, give plain floating sums.
    """
    out = df.groupBy(*keys).agg(*_named(df, value, scale))
    return out.orderBy(F.desc(f"total_{value}"), *keys) if order else out


def with_month(df: DataFrame, date: str = "order_date", name: str = "order_month") -> DataFrame:
    return df.withColumn(name, month_key(df, date))


def by_month(df: DataFrame, date: str, name: str, aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per month, oldest first; the month becomes text after grouping."""
    grouped = df.groupBy(month_start(df, date).alias(name)).agg(*aggs)
    return grouped.withColumn(name, month_key(grouped, name)).orderBy(name)


def monthly_trend(
    df: DataFrame, date: str = "order_date", value: str = "amount", scale: int | None = DECIMALS
) -> DataFrame:
    """Sum, mean and count by month, oldest first."""
    return by_month(df, date, "order_month", _named(df, value, scale))


def monthly_total(
    df: DataFrame, date: str = "order_date", value: str = "amount", scale: int | None = DECIMALS
) -> DataFrame:
    """Only the sum by month, oldest first."""
    return by_month(df, date, "order_month", _named(df, value, scale)[:1])


def frequency(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, most frequent first."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)


def compare_groups(df: DataFrame, key: str, value: str, scale: int | None = DECIMALS) -> DataFrame:
    """Count, mean and exact median of ``value`` per group."""
    means = df.groupBy(key).agg(F.count(present(F.col(value))).alias("n"), mean(F.col(value), scale).alias("mean"))
    medians = exact_quantiles(df, value, {"median": 0.5}, by=[key]).select(
        F.col(key).alias("_key"), "median"
    )
    return (
        means.join(medians, F.col(key).eqNullSafe(F.col("_key")), "left")
        .select(key, "n", "mean", "median")
        .orderBy(key)
    )


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency counts ``n`` in long form; rows with a null in either column are left out.

    The name ``n`` is taken; ``association.pair_counts`` counts columns of any name.
    """
    if "n" in (a.lower(), b.lower()):
        raise ValueError("a column named n would clash with the counts; use pair_counts")
    return (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(a, b)
        .agg(F.count("*").alias("n"))
    )


def crosstab_wide(df: DataFrame, a: str, b: str, values: list | None = None) -> DataFrame:
    """The same counts with one column per value of ``b``, zeros where nothing occurs."""
    wide = crosstab(df, a, b).groupBy(a).pivot(b, values).agg(F.sum("n"))
    return wide.fillna(0).orderBy(a)


def top(df: DataFrame, n: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the largest ``by``; ``ties`` must make the order total."""
    return df.orderBy(F.desc(by), *ties).limit(n)


def row_with_least(df: DataFrame, label: str, metric: str) -> DataFrame:
    """The label that has the smallest metric, and that metric."""
    # A struct orders by metric, then label: partial aggregation, and ties are settled.
    least = df.agg(F.min(F.struct(metric, label)).alias("s"))
    return least.select(F.col(f"s.{label}").alias(label), F.col(f"s.{metric}").alias(metric))
