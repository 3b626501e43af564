"""Document fingerprints: all shingle hashes below a fixed fraction of the hash range.

Which hashes stay depends on their value alone, not on the other hashes of the text. So the
fingerprint of several texts together is made of theirs, a short text's part in a long one is
seen at the rate of the short one, and the share of the smaller fingerprint that the other one
has estimates how far the smaller set of shingles is contained in the larger.

A text none of whose hashes lies below the threshold keeps its smallest hash alone.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import sequence_hashes, slices
from millrace.llm.words import words_of
from millrace.session import stage

WORDS = 5
#: One in so many hashes stays.
SCALE = 8
#: Ranges of ids for each shuffle partition, see ``in_order``.
RANGES = 3


def limit_of(scale: int) -> int:
    """The threshold: hashes below it stay."""
    return (1 << 64) // scale


def sketches(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that stay, rising within each row, and the bounds of the rows.

    Shingles are five consecutive words, or the whole sequence where there are fewer; a
    row without words has none.
    """
    words = words_of(column)
    seeds = np.array([xxhash.xxh64_intdigest(w) for w in words.distinct.to_pylist()], np.uint64)
    hashes = seeds[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    sizes = np.diff(words.rows)
    counts = np.where(sizes >= WORDS, sizes - WORDS + 1, np.minimum(sizes, 1))
    runs = sequence_hashes(hashes, WORDS) if len(hashes) >= WORDS else np.zeros(0, np.uint64)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    row = np.repeat(np.arange(len(sizes)), counts)
    at = words.rows[row] + np.arange(len(row)) - bounds[row]
    full = sizes[row] >= WORDS
    values = np.zeros(len(row), np.uint64)
    values[full] = runs[at[full]]
    for i in np.flatnonzero(~full):
        a = at[i]
        values[i] = sequence_hashes(hashes[a : a + sizes[row[i]]], int(sizes[row[i]]))[0]
    stays = values < np.uint64(min(limit_of(scale), (1 << 64) - 1))
    some = np.zeros(len(sizes), bool)
    some[row[stays]] = True
    filled = np.flatnonzero(counts)
    if len(filled):
        least = np.zeros(len(sizes), np.uint64)
        least[filled] = np.minimum.reduceat(values, bounds[filled])
        stays |= ~some[row] & (values == least[row])
    row, values = row[stays], values[stays]
    order = np.lexsort((values, row))
    row, values = row[order], values[order]
    once = np.ones(len(row), bool)
    once[1:] = (row[1:] != row[:-1]) | (values[1:] != values[:-1])
    return values[once], np.searchsorted(row[once], np.arange(len(sizes) + 1))


def _texts(values: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Each row's hashes as text: base64 of little-endian 64-bit numbers, rising."""
    data = values.astype("<u8").tobytes()
    return [base64.b64encode(data[8 * a : 8 * b]).decode() for a, b in zip(bounds[:-1], bounds[1:])]


def _likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated containment, 0 to 1, of the smaller text's shingles in the other's, from two fingerprints.

    Two empty fingerprints are alike (1), an empty and another are not (0); null gives null.
    """

    @F.pandas_udf("double")
    def compare(x, y):
        hashes = lambda t: np.frombuffer(base64.b64decode(t), "<u8")
        return x.combine(y, lambda s, t: None if s is None or t is None else _likeness(hashes(s), hashes(t)))

    return compare(a, b)


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", scale: int = SCALE) -> DataFrame:
    """One row per input row: doc_id, fingerprint.

    Null counts as empty; a text without words has the empty fingerprint. Equal texts have
    equal fingerprints. Ids are only carried along: null and repeated ids, and repeated
    rows, give one row each. An empty table gives no rows; other columns, whatever their
    names, are not read. A very long text is read whole; its fingerprint is a fixed fraction
    of it.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                prints = _texts(*sketches(part.column("text"), scale))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return wanted.mapInArrow(run, f"doc_id {wanted.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def merged(prints: DataFrame, key: str, scale: int = SCALE) -> DataFrame:
    """(key, hash) rows: the fingerprint of all texts of each group of ``prints`` (key, fingerprint) together.

    It is left as rows, because that of a large group is large: nothing is gathered. Hashes are
    signed 64-bit numbers here. A group of empty fingerprints has no rows; rows with null
    fingerprint are ignored; null keys form a group.
    """

    def spread(batches):
        for batch in batches:
            sets = [np.frombuffer(base64.b64decode(t or ""), "<i8") for t in batch.column("fingerprint").to_pylist()]
            row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            values = np.concatenate(sets) if sets else np.zeros(0, "<i8")
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(row)), pa.array(values, pa.int64())], names=["key", "hash"])

    wanted = prints.select(F.col(key).alias("key"), "fingerprint")
    kind = wanted.schema["key"].dataType.simpleString()
    rows = wanted.mapInArrow(spread, f"key {kind}, hash long").distinct()
    # unsigned order of the hashes: the sign bit is turned
    rows = rows.withColumn("_place", F.col("hash").bitwiseXOR(F.lit(-(1 << 63))))
    least = stage(rows.groupBy(F.col("key").alias("_key")).agg(F.min("_place").alias("_least")), "least-hashes")
    kept = (F.col("_place") < limit_of(scale) - (1 << 63)) if scale > 1 else F.lit(True)
    joined = rows.join(least, F.col("key").eqNullSafe(F.col("_key")))
    return joined.where(kept | (F.col("_place") == F.col("_least"))).select(F.col("key").alias(key), "hash")


def in_order(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Rows (range, doc_id, text, next_only), sorted by falling id within each task, ranges apart.

    Ids are cut into ranges; each range ends with a copy of the row that follows it, marked
    ``next_only``, and after the last range comes the first row again. So every row's successor
    stands behind it, although no task holds more than some ranges. Null ids come last. Rows
    of equal id are ordered by a hash of their text; rows equal in both are the same.
    """
    spark = docs.sparkSession
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    keys = stage(rows.select("doc_id", "tie", "row"), "fingerprint-keys")
    ranged = keys.repartitionByRange(n, F.desc_nulls_last("doc_id"), F.desc("tie"), F.desc("row"))
    greatest = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.max(F.struct("doc_id", "tie", "row")).alias("k"))
    # one key for each range, whatever the size of the table
    found = [r["k"] for r in greatest.collect()]
    starts = sorted((k["doc_id"] is not None, k["doc_id"] or 0, k["tie"], k["row"]) for k in found)
    last = len(starts) - 1

    @F.udf("int", useArrow=True)
    def range_of(doc_id, tie, row):
        return last - min(last, bisect_left(starts, (doc_id is not None, doc_id or 0, tie, row)))

    kind = rows.schema["doc_id"].dataType
    firsts = spark.createDataFrame(
        [(last - i, s[1] if s[0] else None, s[2]) for i, s in enumerate(starts)], f"range int, head_id {kind.simpleString()}, head_tie long"
    )
    same = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    # rows that repeat may be the heads of several ranges: their text is found once
    heads = rows.join(F.broadcast(firsts.select("head_id", "head_tie").distinct()), same, "left_semi")
    texts = heads.groupBy("doc_id", "tie").agg(F.max("text").alias("text"))
    follows = texts.join(F.broadcast(firsts), same)
    before = F.when(F.col("range") == 0, F.lit(last)).otherwise(F.col("range") - 1).cast("int")
    follows = stage(follows.select(before.alias("range"), "doc_id", "tie", "text"), "fingerprint-heads")
    dealt = rows.select(range_of("doc_id", "tie", "row").alias("range"), "doc_id", "tie", "text", F.lit(False).alias("next_only"))
    dealt = dealt.unionByName(follows.withColumn("next_only", F.lit(True))).repartition("range")
    ordered = dealt.sortWithinPartitions("range", "next_only", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return ordered.select("range", "doc_id", "text", "next_only")


def edit(text: str, following: str) -> str:
    """The text whose last half is replaced by as many code points from the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_prints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", scale: int = SCALE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next one's are.

    Returns doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The next row is the one with the next lower id, after the last one the
    first; the edited text has its last floor(n_chars/2) code points replaced by the first as many (or all)
    of the next text.

    Null counts as empty; texts without words have the empty fingerprint, alike with each
    other (1) and with nothing else (0). Null ids come last; rows of equal id are ordered by a
    hash of their text, so ties and repeated rows have one result. A single row is its own
    next. An empty table gives no rows; other columns, whatever their names, are not read. A
    very long text is worked on whole, in one task. Ids are integers or strings.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)

    def run(batches):
        held = None  # the row whose successor has not come yet
        for batch in batches:
            for part in slices(batch, "text"):
                table = pa.Table.from_batches([part] if held is None else [held, part]).combine_chunks()
                part = table.to_batches()[0]
                held = part.slice(part.num_rows - 1)
                texts = part.column("text").to_pylist()
                own, at = sketches(part.column("text"), scale)
                rows = [i for i, extra in enumerate(part.column("next_only").to_pylist()[:-1]) if not extra]
                edited = [edit(texts[i], texts[i + 1]) for i in rows]
                new, to = sketches(pa.array(edited, pa.large_string()), scale)
                prints = _texts(own, at)
                sets = lambda i: own[at[i] : at[i + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array([len(texts[i]) for i in rows], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                        pa.array([prints[i] for i in rows], pa.string()),
                        pa.array(_texts(new, to), pa.string()),
                        pa.array([_likeness(sets(i), new[to[k] : to[k + 1]]) for k, i in enumerate(rows)], pa.float64()),
                        pa.array([_likeness(sets(i), sets(i + 1)) for i in rows], pa.float64()),
                    ],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return in_order(docs, text_col, id_col).mapInArrow(run, schema)
