"""Writers, small-result reports, and the CSV/Parquet comparison."""

from __future__ import annotations

import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.validation import reject_documents
from millrace.sources.readers import CSV_FORMAT


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV files with a header; quotes inside a value are doubled, blanks around it are kept.

    An empty string and a null are both written as an empty field, which reads as null.
    """
    df.write.mode(mode).options(**CSV_FORMAT).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_rejects(checked: DataFrame, path: str, mode: str = "error") -> None:
    """Reject report as JSON lines, values with their own JSON types; a directory without rows when nothing was rejected."""
    reject_documents(checked).write.mode(mode).option("ignoreNullFields", False).json(path)


def _cell(value: object, digits: int) -> str:
    if value is None:
        return ""
    return f"{value:.{digits}f}" if isinstance(value, float) else str(value).replace("|", "\\|")


def markdown_table(df: DataFrame, order_by: str | None = None, digits: int = 2) -> str:
    """A summary as a Markdown table, sorted ascending. Every row comes to the driver, so
    aggregate before making a table."""
    if order_by:
        df = df.orderBy(order_by)
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(_cell(v, digits) for v in r) + " |" for r in df.toLocalIterator()]
    return "\n".join(lines)


def write_report(spark: SparkSession, path: str, title: str, sections: dict[str, DataFrame | str]) -> str:
    """A Markdown report of several small results, written as one text file; returns it."""
    parts = [f"# {title}"]
    for name, body in sections.items():
        parts.append(f"## {name}")
        parts.append(body if isinstance(body, str) else markdown_table(body))
    text = "\n\n".join(parts)
    spark.createDataFrame([(text,)], "value string").write.text(path)
    return text


def save_model(model: PipelineModel, path: str) -> str:
    """Save a fitted pipeline; a failing write is an OSError."""
    try:
        model.write().overwrite().save(path)
    except (Py4JJavaError, OSError) as e:
        raise OSError(f"cannot write the model to {path}") from e
    return path


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the data files below a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def _timed_ms(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return (time.perf_counter() - start) * 1000.0


def compare_formats(df: DataFrame, base_path: str) -> DataFrame:
    """Write and fully read ``df`` as CSV and Parquet: ``format, write_ms, read_ms, bytes``."""
    spark = df.sparkSession
    rows = []
    for name, write in (("csv", write_csv), ("parquet", write_parquet)):
        path = f"{base_path}/{name}"
        write_ms = _timed_ms(lambda: write(df, path))
        reader = spark.read.schema(df.schema).option("header", True).format(name)
        read_ms = _timed_ms(lambda: reader.load(path).write.format("noop").mode("overwrite").save())
        rows.append((name, write_ms, read_ms, stored_bytes(spark, path)))
    return spark.createDataFrame(rows, "format string, write_ms double, read_ms double, bytes bigint")
