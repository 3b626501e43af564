"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its content says so, each chunk becomes a small identifier,
and texts are equal exactly if their ordered lists of identifiers are. The text
is read once; what is shuffled afterwards are digests and lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.registry import unused
from millrace.session import stage

#: A chunk ends at the first of these letters before a space after 512 characters, after 4096 at the latest.
CHUNK = r"(?s).{512}.{0,3584}?[aeinrst.] |.{1,4096}"


def normal_text(text: Column) -> Column:
    """Each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\t-\r][ \t-\r]*| [ \t-\r]+", " ")


def recipes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, sha256 of the normalised text, and its chunks as (key, digest) pairs in order."""
    normal = docs.select(F.col(id_col).alias("doc_id"), normal_text(F.col(text_col)).alias("_text"))
    return normal.select(
        "doc_id",
        F.sha2("_text", 256).alias("text_sha256"),
        F.transform(
            F.regexp_extract_all("_text", F.lit(CHUNK), F.lit(0)),
            lambda c: F.struct(F.xxhash64(c).alias("key"), F.unhex(F.sha2(c, 256)).alias("digest")),
        ).alias("chunks"),
    )


def verified_ids(chunks: DataFrame) -> DataFrame:
    """Distinct chunks (key, digest) with an identifier that no other digest has.

    The identifier is the 64-bit key, verified against the SHA-256 of the bytes;
    where different chunks share a key, the rank of the digest tells them apart.
    """
    distinct = chunks.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n"))
    listed = distinct.groupBy("key").agg(F.sort_array(F.collect_list("digest")).alias("digests"))
    return listed.select("key", F.posexplode("digests").alias("rank", "digest")).select(
        "key", "digest", F.struct("key", "rank").alias("chunk_id")
    )


def exact_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they agree after each run of ``[\\x20\\x09-\\x0D]`` is
    replaced by one space. The smallest id of a group stays. Null counts as the
    empty text; empty texts form one group. Repeated rows (equal id and text)
    count in ``group_size`` and are all marked kept if their id is the smallest.
    A null id is never chosen while its group has another; a group of null ids
    alone keeps null and marks its rows kept. An empty table gives no rows; other
    columns of the input, whatever their names, are not used.
    """
    recipe = recipes(docs, text_col, id_col)
    numbered = stage(recipe.withColumn("row", F.monotonically_increasing_id()), "recipes")
    placed = numbered.select("row", F.posexplode("chunks").alias("pos", "chunk")).select("row", "pos", "chunk.*")
    known = placed.join(verified_ids(placed.select("key", "digest")), ["key", "digest"])
    lists = known.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "chunk_id"))).alias("list"))
    lists = lists.select("row", F.col("list.chunk_id").alias("list"))
    empty = F.array().cast("array<struct<key:bigint,rank:int>>")
    bearers = numbered.select("row", "doc_id", "text_sha256").join(lists, "row", "left")
    bearers = stage(bearers.withColumn("list", F.coalesce("list", empty)), "lists")
    groups = bearers.groupBy("list").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # staged, so that both sides of the join are plain shuffles and a huge group can be split
    return bearers.join(stage(groups, "groups"), "list").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows that stay, all columns unchanged; of rows with equal id and text one stays."""
    keep_id, keep_sha, sha = (unused(docs, n) for n in ("_keep_id", "_keep_sha", "_sha"))
    kept = exact_duplicates(docs, text_col, id_col).where("kept")
    kept = kept.select(F.col("doc_id").alias(keep_id), F.col("text_sha256").alias(keep_sha))
    marked = docs.withColumn(sha, F.sha2(normal_text(F.col(text_col)), 256))
    same = F.col(id_col).eqNullSafe(F.col(keep_id)) & (F.col(sha) == F.col(keep_sha))
    return marked.join(kept, same, "left_semi").dropDuplicates([id_col, sha]).drop(sha)
