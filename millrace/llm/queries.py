"""One query per operator, over the whole of its table."""

from __future__ import annotations

import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import language, quality, toxicity
from millrace.llm.bpe import round_trip
from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.fingerprints import edited_prints
from millrace.llm.hamming_search import hamming_top_k, sign_codes
from millrace.llm.near_dedup import near_duplicates
from millrace.llm.packing import pack
from millrace.llm.periodic_runs import periodic_runs, run_digest
from millrace.llm.registry import register, table
from millrace.llm.substring_dedup import substring_dedup
from millrace.llm.token_files import token_table
from millrace.llm.whitening import fixed_point, whiten

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


@register("op1_near_dedup")
def op1(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@register("op2_packing")
def op2(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


@register("op3_token_files")
def op3(spark, sf_dir):
    return token_table(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


@register("op4_substring_dedup")
def op4(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"))


@register("op5_byte_bpe")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return round_trip(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


@register("op6_quality")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    ratings = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("grade"))
    return quality.grade(docs, quality.fit(docs, ratings))


@register("op7_toxicity")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", fold.alias("fold")).where("fold <> 0")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


@register("op8_language")
def op8(spark, sf_dir):
    model = language.fit(table(spark, sf_dir, "documents"))
    found = language.identify(language.page_rows(table(spark, sf_dir, "pages")), model)
    return found.withColumnRenamed("id", "page_id")


EXACT_SQL = r"""
with normal as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
grouped as (select t, min(doc_id) as keep_id, count(*) as group_size from normal group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
from normal join grouped using (t)"""


@register("op9_exact_dedup", EXACT_SQL)
def op9(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


TOP_K_SQL = """
with codes as (
  select vec_id as id, list_transform(embedding, lambda x: case when x > 0 then 1 else 0 end) as bits
  from embeddings where embedding is not null),
pairs as (
  select q.id as query_id, c.id, list_sum(list_transform(list_zip(q.bits, c.bits),
    lambda z: case when z[1] <> z[2] then 1 else 0 end)) as distance
  from codes q, codes c where q.id % 100 = 0),
ranked as (select *, row_number() over (partition by query_id order by distance, id) as rank from pairs)
select query_id, cast(rank as int) as rank, id, cast(distance as int) as distance from ranked where rank <= 10"""


@register("op10_hamming_search", TOP_K_SQL)
def op10(spark, sf_dir):
    codes = sign_codes(table(spark, sf_dir, "embeddings"), "embedding", "vec_id")
    return hamming_top_k(codes, codes.where(F.col("id") % 100 == 0))


def repeated_tail(text: str, h: int) -> str:
    """Every word i >= a replaced by word a + (i - a) % p, where h, a hash of the id, sets a and p."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, g = len(words), h // 10
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[:a] + [words[a + i % p] for i in range(n - a)])


def with_repeated_tails(docs):
    """doc_id and text, where a tenth of the documents, chosen by their ids, has a periodic end."""

    def run(batches):
        for batch in batches:
            texts, hashes = batch.column("text").to_pylist(), batch.column("h").to_pylist()
            edited = [repeated_tail(t or "", h) if h is not None and h % 10 == 0 else t for t, h in zip(texts, hashes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(edited, pa.string())], names=["doc_id", "text"])

    return docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string"
    )


@register("op11_periodic_runs")
def op11(spark, sf_dir):
    return run_digest(periodic_runs(with_repeated_tails(table(spark, sf_dir, "documents"))))


@register("op12_whitening")
def op12(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", fixed_point(F.col("embedding"), 64, 1_000_000).alias("x"))
    rows = whiten(vectors, "x", "vec_id").select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("pos", "one"))
    return rows.select(
        F.col("id").alias("vec_id"), (F.col("pos") + 1).alias("component"), "n", F.col("deviation").try_cast("long").alias("deviation"),
        F.col("one.whitened").alias("whitened"), F.col("one.explained").alias("explained"), "identity_error",
    )


@register("op13_fingerprints")
def op13(spark, sf_dir):
    return edited_prints(table(spark, sf_dir, "documents"))
