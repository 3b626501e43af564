"""File readers with declared schemas and clear errors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import quoted
from millrace.session import stage
from millrace.sources.multiline import read_multiline_csv

CORRUPT = "_corrupt_record"
#: Header, doubled quotes inside quoted values, and blanks kept, as most tools write CSV.
CSV_FORMAT = {
    "header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


@contextmanager
def _clear_errors(path: str) -> Iterator[None]:
    """A path that is not there becomes a FileNotFoundError."""
    try:
        yield
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no input file at {path}") from e
        raise


def _ensure_readable(spark: SparkSession, path: str) -> None:
    with _clear_errors(path):
        first_line = spark.read.text(path).limit(1)
    if first_line.isEmpty():
        raise ValueError(f"no data to read in {path}")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    null_values: Sequence[str] = (),
    keep_corrupt: bool = False,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """Lazy CSV scan with header.

    The schema is declared; without one the types are inferred, which reads the file
    once more. Rows that do not parse stop the job (as far as the columns in use are
    concerned) unless ``keep_corrupt`` keeps their text in ``_corrupt_record``.
    ``null_values`` are further texts that mean missing, also when types are inferred.
    ``multi_line`` reads values with line breaks: by all cores and in no order with a
    schema and no other options, else by one task per file. An empty field is null, quoted
    or not.
    """
    _ensure_readable(spark, path)
    if multi_line and schema is not None and not options:
        return _multi_line(spark, path, schema, null_values, keep_corrupt)
    reader = spark.read.options(**CSV_FORMAT).option("multiLine", multi_line)
    reader = reader.option("enforceSchema", schema is None).options(**options)
    if schema is None and null_values:
        return _inferred(_blank_nulls(reader.option("mode", "FAILFAST").csv(path), null_values))
    if schema is None:
        df = reader.option("inferSchema", True).option("mode", "FAILFAST").csv(path)
        return df
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("enforceSchema", True)
        df = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
        return _blank_nulls(df, null_values, skip=(CORRUPT,))
    reader = reader.option("mode", "FAILFAST")
    if null_values:
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        df = _blank_nulls(reader.schema(texts).csv(path), null_values)
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return reader.schema(schema).csv(path)


def _multi_line(
    spark: SparkSession, path: str, schema: T.StructType | str, null_values: Sequence[str], keep_corrupt: bool
) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if keep_corrupt:
        return _blank_nulls(read_multiline_csv(spark, path, schema, CORRUPT), null_values, skip=(CORRUPT,))
    if null_values:
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        df = _blank_nulls(read_multiline_csv(spark, path, texts), null_values)
        return df.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
    return read_multiline_csv(spark, path, schema)


def _blank_nulls(df: DataFrame, null_values: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    if not null_values:
        return df
    return df.select(
        *[
            F.when(~F.col(f.name).isin(*null_values), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in skip
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _inferred(texts: DataFrame) -> DataFrame:
    """Text columns as the first type of a list that all their values have; one pass."""
    kinds = ("int", "bigint", "double", "date", "timestamp", "boolean")
    fails = [
        F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(k).isNull()).alias(f"{i}_{k}")
        for i, c in enumerate(texts.columns) for k in kinds
    ]
    seen = [F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(texts.columns)]
    found = texts.agg(*fails, *seen).first()
    kind = [
        next((k for k in kinds if found[f"{i}_n"] and not found[f"{i}_{k}"]), "string") for i in range(len(texts.columns))
    ]
    return texts.select(*[F.col(f"`{c}`").cast(k).alias(c) for c, k in zip(texts.columns, kind)])


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the text of rows that did not parse.

    The parse result is staged once: both halves then read Parquet, and Spark's rule
    against raw scans of the corrupt-record column alone does not apply.
    """
    parsed = stage(df, "parsed")
    bad = F.col(CORRUPT).isNotNull()
    return parsed.where(~bad).drop(CORRUPT), parsed.where(bad).select(CORRUPT)


def csv_table(spark: SparkSession, path: str, view: str, schema: T.StructType | str) -> None:
    """Make a CSV path a SQL table for ``spark.sql``."""
    read_csv(spark, path, schema).createOrReplaceTempView(view)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; a missing path is a FileNotFoundError."""
    with _clear_errors(path):
        return spark.read.parquet(path)
