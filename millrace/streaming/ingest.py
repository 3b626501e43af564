"""Landed payload files as a stream, checked with the same row rules as a batch.

The rules are row-local, so they need no state and no watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.validation import Field, validate_json


def checked_stream(spark: SparkSession, landing_dir: str, fields: Sequence[Field]) -> DataFrame:
    """One JSON record per line of each new file, with parsed fields and ``errors``."""
    return validate_json(spark.readStream.text(landing_dir), "value", fields)


def start_quarantine(checked: DataFrame, out_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """Append good and bad rows to ``is_valid=true|false`` folders, each exactly once, and
    stop when all files that have landed are processed."""
    return (
        checked.withColumn("is_valid", F.size("errors") == 0)
        .writeStream.format("parquet")
        .partitionBy("is_valid")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
