"""CSV with line breaks inside quotes, read by all cores.

A reader that cuts a file into byte ranges does not know whether a range begins inside
quotes. So each range is first read for both cases: its lines are walked through once for a
beginning outside and once for one inside quotes, which leaves two bits. A prefix scan over
the ranges of a file settles how each begins. In the second pass every range gives its whole
records, and the pieces of records that lie across ranges are put together.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.session import stage

#: Kinds of pieces: a whole record, and the beginning, middle and end of one across ranges.
WHOLE, BEGIN, MIDDLE, END = range(4)


def ends_inside(line: str, inside: bool, separator: str = ",") -> bool:
    """Whether a line that begins inside or outside quotes ends inside them.

    Quotes open a value only at its beginning; within quotes a doubled quote is a quote;
    after the closing quote the value goes on to the next separator.
    """
    at = 0
    while True:
        if not inside and line.startswith('"', at):
            inside, at = True, at + 1
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('"', at + 1):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            inside, at = False, at + 1
        at = line.find(separator, at)
        if at < 0:
            return False
        at += len(separator)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files, ended by line feeds only, with the file and the first byte of their range."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("line")
    )


def _ranges_inside(lines: DataFrame, separator: str) -> list[tuple[str, int]]:
    """The ranges (file, first byte) that begin inside quotes: usually none or few."""

    def walk(batches):
        key, out, in_ = None, False, True
        for batch in batches:
            for file, at, line in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "line"))):
                if (file, at) != key:
                    if key:
                        yield pa.RecordBatch.from_pydict({"file": [key[0]], "at": [key[1]], "from_out": [out], "from_in": [in_]})
                    key, out, in_ = (file, at), False, True
                out = ends_inside(line, out, separator)
                in_ = ends_inside(line, in_, separator)
        if key:
            yield pa.RecordBatch.from_pydict({"file": [key[0]], "at": [key[1]], "from_out": [out], "from_in": [in_]})

    quoted = lines.where(F.col("line").contains('"'))  # other lines leave both cases as they are
    ends = quoted.mapInArrow(walk, "file string, at long, from_out boolean, from_in boolean")
    # A range ends as it began, or the other way round, or the same however it began. The last
    # range of the third sort and the number of turns since then give the state.
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = F.sum((F.col("from_out") & ~F.col("from_in")).cast("long")).over(before)
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out").cast("long") + F.col("turns"))
    known = ends.withColumn("turns", turns).withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))
    after = (F.coalesce("fixed", F.lit(0)) + F.col("turns")) % 2 == 1
    # ranges without quotes are not listed, so the state holds until the next one listed
    ends = stage(known.select("file", "at", after.alias("inside")), "quote-states")
    if ends.where("inside").isEmpty():
        return []
    starts = lines.groupBy("file", "at").agg(F.lit(False).alias("listed")).select("file", "at")
    all_ranges = starts.join(ends, ["file", "at"], "left")
    previous = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    begun = all_ranges.select("file", "at", F.last("inside", ignorenulls=True).over(previous).alias("inside")).where("inside")
    return [(r["file"], r["at"]) for r in begun.collect()]


def _pieces(lines: DataFrame, inside_at: Sequence[tuple[str, int]], separator: str) -> DataFrame:
    """(file, at, kind, first, text): whole records, and pieces of records across ranges, of each range.

    ``first`` marks the first whole record of a file.
    """
    begun_inside = set(inside_at)
    schema = "file string, at long, kind int, first boolean, text string"

    def piece(key, kind, lines_, first=False):
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([kind], pa.int32()), pa.array([first]), pa.array(["\n".join(lines_)])],
            names=["file", "at", "kind", "first", "text"],
        )

    def cut(batches):
        key, inside, held, opened_before, fresh = None, False, [], False, False

        def close():
            """What is left at the end of a range."""
            if key and held:
                yield piece(key, MIDDLE if opened_before else BEGIN, held, fresh)

        for batch in batches:
            texts = batch.column("line")
            has_quote = pc.match_substring(texts, '"').to_pylist()
            files, ats, values = (batch.column(c).to_pylist() for c in ("file", "at", "line"))
            whole: list[int] = []

            def flush(whole=whole, batch=batch):
                if whole:
                    at = pa.array(whole, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("file").take(at), batch.column("at").take(at), pa.array([WHOLE] * len(whole), pa.int32()),
                            pa.array([False] * len(whole)), batch.column("line").take(at),
                        ],
                        names=["file", "at", "kind", "first", "text"],
                    )
                    whole.clear()

            for i, line in enumerate(values):
                if (files[i], ats[i]) != key:
                    yield from flush()
                    yield from close()
                    key = (files[i], ats[i])
                    inside = opened_before = key in begun_inside
                    held, fresh = [], ats[i] == 0
                if fresh and not held and line in ("", "\r"):
                    continue  # empty lines before the header
                began = inside
                if has_quote[i]:
                    inside = ends_inside(line, inside, separator)
                if not began and not inside and not fresh:
                    whole.append(i)
                    continue
                held.append(line)
                if not inside:
                    yield from flush()
                    yield piece(key, END if opened_before else WHOLE, held, fresh and not opened_before)
                    held, opened_before, fresh = [], False, False
            yield from flush()
        yield from close()

    return lines.mapInArrow(cut, schema)


def records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """(file, first, text): every record of the files below ``path``; ``first`` marks the first one of a file."""
    lines = _lines(spark, path)
    inside_at = _ranges_inside(lines, separator)
    found = _pieces(lines, inside_at, separator)
    if not inside_at:
        # the only pieces are ends of files whose last value is not closed: records too
        return found.select("file", "first", "text")
    whole = found.where(F.col("kind") == WHOLE).select("file", "first", "text")
    across = stage(found.where(F.col("kind") != WHOLE), "record-pieces")
    # a range may end one record across ranges and begin another: its end comes first
    order = Window.partitionBy("file").orderBy("at", F.when(F.col("kind") == END, 0).otherwise(1))
    numbered = across.withColumn("record", F.sum((F.col("kind") == BEGIN).cast("long")).over(order))
    pieces = F.sort_array(F.collect_list(F.struct("at", F.when(F.col("kind") == END, 0).otherwise(1).alias("o"), "text")))
    joined = numbered.groupBy("file", "record").agg(pieces.alias("p"), F.max("first").alias("first"))
    text = F.array_join(F.transform("p", lambda x: x["text"]), "\n")
    return whole.unionByName(joined.select("file", "first", text.alias("text")))


def read_multiline_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, corrupt: str | None = None, separator: str = ","
) -> DataFrame:
    """CSV with header whose quoted values may hold line breaks, read in byte ranges by all cores.

    Rows are those that Spark's own multi-line reader gives, in no order. Values are quoted by
    double quotes, doubled inside; records end with a line feed, with or without a carriage
    return before it; empty lines are skipped. The header of each file must name the columns of
    the schema. A record that does not parse stops the job, or with ``corrupt`` is kept as
    text in the column of that name.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    options = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows = records(spark, path, separator).withColumn("text", F.regexp_replace("text", r"\r\z", "")).where("text <> ''")
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))])
    head = F.from_csv("text", names.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    wanted = F.array(*[F.lit(f.name) for f in schema.fields])
    found = F.array(*[head[f"c{i}"] for i in range(len(schema))])
    wrong = F.raise_error(F.concat(F.lit("header does not match the schema: "), F.col("text")))
    body = rows.where(~F.when(F.col("first"), F.when(found == wanted, True).otherwise(wrong.cast("boolean"))).otherwise(False))
    kept = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]) if corrupt else schema
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt} if corrupt else {"mode": "FAILFAST"}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.fields)
    return body.select(F.from_csv("text", ddl, options).alias("r")).select("r.*")


def csv_module_rows(spark: SparkSession, path: str, columns: Sequence[str], separator: str = ",") -> DataFrame:
    """The same records parsed by Python's csv module, all columns as text: a second opinion on a reader.

    An empty field is null. A record with another number of fields than ``columns`` stops the job.
    """

    def parse(batches):
        for batch in batches:
            rows = list(csv.reader(batch.column("text").to_pylist(), delimiter=separator, strict=True))
            for row in rows:
                if len(row) != len(columns):
                    raise ValueError(f"{len(row)} fields in place of {len(columns)}: {row[:5]}")
            values = [pa.array(column, pa.string()) for column in (zip(*rows) if rows else [()] * len(columns))]
            yield pa.RecordBatch.from_arrays(
                [pc.if_else(pc.equal(column, ""), pa.scalar(None, pa.string()), column) for column in values],
                names=[f"c{i}" for i in range(len(columns))],
            )

    body = records(spark, path, separator).where("not first").select(F.regexp_replace("text", r"\r\z", "").alias("text")).where("text <> ''")
    parsed = body.mapInArrow(parse, ", ".join(f"c{i} string" for i in range(len(columns))))
    return parsed.toDF(*columns)
