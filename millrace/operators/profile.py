"""Profiles of a table: schema, missing values, consistency between columns.

Each profile reads the table once, however many columns it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import beyond_tolerance, complete, missing, percent, quoted


TOTAL = "_row_total"


def _counts_by_column(df: DataFrame, conditions: dict[str, Column], name: str) -> DataFrame:
    """Rows meeting each column's condition in long form: ``_row_total, column_name, name``.

    One aggregation computes all counts; only its single row is unpivoted.
    """
    counts = df.agg(F.count("*").alias(TOTAL), *[F.count_if(c).alias(n) for n, c in conditions.items()])
    return counts.unpivot(TOTAL, [F.col(quoted(n)) for n in conditions], "column_name", name)


def missing_report(df: DataFrame, columns: list[str] | None = None, only_missing: bool = True) -> DataFrame:
    """``column_name, missing_count, missing_pct``, most missing first."""
    conditions = {c: missing(df, c) for c in columns or df.columns}
    report = _counts_by_column(df, conditions, "missing_count")
    if only_missing:
        report = report.where(F.col("missing_count") > 0)
    return report.select(
        "column_name", "missing_count", percent(F.col("missing_count"), F.col(TOTAL)).alias("missing_pct")
    ).orderBy(F.desc("missing_count"), "column_name")


def schema_profile(df: DataFrame) -> DataFrame:
    """``position, column_name, data_type, non_null, row_count, column_count``."""
    present = _counts_by_column(df, {c: ~missing(df, c) for c in df.columns}, "non_null")
    names = F.array(*[F.lit(c) for c in df.columns])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in df.schema.fields])
    position = (F.array_position(names, F.col("column_name")) - 1).cast("int")
    return present.select(
        position.alias("position"),
        "column_name",
        F.get(types, position).alias("data_type"),
        "non_null",
        F.col(TOTAL).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
    ).orderBy("position")


def consistency_report(
    df: DataFrame, value: str, factors: tuple[str, str], tolerance: float = 1.0
) -> DataFrame:
    """One row: complete rows checked, rows where ``value`` is not the product of the
    factors within the tolerance, and their share in percent."""
    a, b = factors
    checked = F.count_if(complete(df, [value, a, b]))
    off = F.count_if(
        complete(df, [value, a, b]) & beyond_tolerance(F.col(value), F.col(a) * F.col(b), tolerance)
    )
    return df.agg(
        checked.alias("checked"), off.alias("mismatched"), percent(off, checked).alias("mismatch_pct")
    )
