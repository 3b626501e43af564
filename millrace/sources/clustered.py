"""Parquet clustered by a column: sorted files of bounded size and a manifest of their ranges.

A range of values then lies in few files, and the manifest says in which, so a reader opens
those only, whatever the number of files in the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import missing, quoted

MANIFEST = "_manifest"  # names that begin with an underscore are not read as data


def write_clustered(df: DataFrame, path: str, by: str, rows_per_file: int = 1_000_000, mode: str = "error") -> None:
    """Write ``df`` in files sorted by ``by``, each with one range of its values and some ``rows_per_file`` rows.

    Equal values may span files, so that a value with a third of the rows is written by many
    tasks; a hash of the row tells them apart. Missing values come first. The input is read twice:
    to count its rows and to write it.
    """
    files = max(1, -(-df.count() // rows_per_file))
    tie = F.xxhash64(*[F.col(quoted(c)) for c in df.columns])
    key = F.asc_nulls_first(F.when(~missing(df, by), F.col(quoted(by))))
    ordered = df.repartitionByRange(files, key, tie).sortWithinPartitions(key)
    # a range may come out larger than the sample promised
    ordered.write.mode(mode).option("maxRecordsPerFile", 2 * rows_per_file).parquet(path)
    ranges(df.sparkSession, path, by).coalesce(1).write.mode(mode).parquet(f"{path.rstrip('/')}/{MANIFEST}")


def ranges(spark: SparkSession, path: str, by: str) -> DataFrame:
    """``file, n_rows, n_missing, low, high`` of each file, read from the one column."""
    df = spark.read.parquet(path)
    v = F.when(~missing(df, by), F.col(quoted(by)))
    return (
        df.select(F.col("_metadata.file_path").alias("file"), v.alias("v"))
        .groupBy("file")
        .agg(F.count("*").alias("n_rows"), F.count_if(F.col("v").isNull()).alias("n_missing"), F.min("v").alias("low"), F.max("v").alias("high"))
    )


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The stored ranges of a clustered table."""
    return spark.read.parquet(f"{path.rstrip('/')}/{MANIFEST}")


def overlapping(spark: SparkSession, path: str, low: object, high: object) -> list[str]:
    """The files that may hold values between ``low`` and ``high``, both included."""
    found = manifest(spark, path).where((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
    return [r["file"] for r in found.select("file").orderBy("file").collect()]


def read_clustered(spark: SparkSession, path: str, by: str, low: object, high: object, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with ``by`` between ``low`` and ``high``, both included, from the files that may hold them."""
    everything = spark.read.parquet(path)
    files = overlapping(spark, path, low, high)
    df = spark.read.schema(everything.schema).parquet(*files) if files else everything.limit(0)
    df = df.where(F.col(quoted(by)).between(F.lit(low), F.lit(high)))
    return df.select(*columns) if columns else df
