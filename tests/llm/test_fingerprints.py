"""Fingerprints against plain sets, and on nulls, empty and long texts, ties, repeats and empty tables."""

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import queries as _  # noqa: F401  registers the queries
from millrace.llm.batches import sequence_hashes
from millrace.llm.fingerprints import SCALE, edit, edited_prints, fingerprints, likeness, merged, sketches
from millrace.llm.registry import QUERIES

SCHEMA = "doc_id bigint, text string"


def brute_sketch(text, scale):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    seeds = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    size = min(5, len(words))
    hashes = {int(sequence_hashes(seeds[i : i + size], size)[0]) for i in range(len(words) - size + 1)} if words else set()
    return sorted(h for h in hashes if h < 2**64 // scale) or sorted(hashes)[:1]


def brute_likeness(a, b):
    return len(set(a) & set(b)) / min(len(a), len(b)) if a and b else float(len(a) == len(b))


def text_of(sketch):
    return base64.b64encode(np.array(sketch, "<u8").tobytes()).decode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abé \n ", max_size=60), max_size=6), st.sampled_from([1, 2, 8]))
def test_sketches_equal_brute_force(texts, scale):
    values, bounds = sketches(pa.array([None, *texts], pa.string()), scale)
    assert [values[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [brute_sketch(t, scale) for t in [None, *texts]]


def brute_edited(data):
    """By falling id, null ids last, ties by text hash: what each row's result must be."""
    by = lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64((r[1] or "").encode(), seed=42).intdigest())
    signed = lambda k: (*k[:2], k[2] - (1 << 64) if k[2] >> 63 else k[2])
    ordered = sorted(data, key=lambda r: signed(by(r)), reverse=True)
    out = []
    for i, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        new = edit(text, following)
        own, to, after = (brute_sketch(t, SCALE) for t in (text, new, following))
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), text_of(own), text_of(to), brute_likeness(own, to), brute_likeness(own, after)))
    return sorted(out, key=repr)


def test_edited_prints_equal_brute_force(rows):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(300)]
    data = [(int(i), " ".join(rng.choice(words, rng.integers(0, 400)))) for i in rng.permutation(200)]
    found = edited_prints(rows(SCHEMA, data).repartition(7))
    assert found.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_edited(data)


def test_edges(rows):
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(30000))
    data = [
        (1, None), (2, ""), (3, " \n"), (4, "naïve 日本語 🙂 one two three four"), (9, "same text of six words here"), (9, "another text"),
        (8, "same text of six words here"), (7, long_text), (None, "null id"), (None, "null id"), (None, None), (6, "x"), (6, "x"),
    ]
    extra = ("range", "tie", "row", "next_only", "head_id", "n_chars", "fingerprint", "p")
    df = rows(SCHEMA, data).withColumns({c: F.lit(1) for c in extra})
    assert sorted((tuple(r) for r in edited_prints(df).collect()), key=repr) == brute_edited(data)
    one = edited_prints(rows(SCHEMA, [(1, "a b c d e f g")])).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 13
    nothing = edited_prints(rows(SCHEMA, []))
    assert nothing.count() == 0 and nothing.columns == list(one.__fields__)
    assert fingerprints(rows(SCHEMA, [])).count() == 0
    prints = {(r["doc_id"], r["fingerprint"]) for r in fingerprints(df).collect()}
    assert prints == {(i, text_of(brute_sketch(t, SCALE))) for i, t in data}


def test_a_third_of_all_rows_alike(rows):
    data = [(i, f"text {i}") for i in range(40)] + [(50, "copy of a row")] * 20
    assert sorted((tuple(r) for r in edited_prints(rows(SCHEMA, data).repartition(5)).collect()), key=repr) == brute_edited(data)


def test_string_ids(rows):
    found = edited_prints(rows("doc_id string, text string", [("b", "bb bb"), ("a", "aa"), (None, "cc")])).collect()
    assert {r["doc_id"]: r["edited_sha256"] for r in found} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in {"b": "bb aa", "a": "ac", None: "cb"}.items()
    }


def test_containment_is_estimated(rows):
    rng = np.random.default_rng(2)
    long_text = [f"w{rng.integers(10**9)}" for _ in range(20000)]
    cases = {1: long_text[500:2500], 2: long_text[3000:4000] + [f"v{i}" for i in range(1000)], 3: [f"u{i}" for i in range(2000)]}
    df = fingerprints(rows(SCHEMA, [(i, " ".join(t)) for i, t in cases.items()]))
    whole = fingerprints(rows(SCHEMA, [(0, " ".join(long_text))])).select(F.col("fingerprint").alias("whole"))
    found = {r["doc_id"]: r["near"] for r in df.crossJoin(whole).select("doc_id", likeness(F.col("fingerprint"), F.col("whole")).alias("near")).collect()}
    assert found[1] == 1.0 and abs(found[2] - 0.5) < 0.12 and found[3] == 0.0


def test_merged(rows):
    texts = [(1, "a", "one two three four five six seven"), (2, "a", " ".join(f"x{i}" for i in range(300))), (3, "b", "few words"), (4, None, ""), (5, "b", None)]
    docs = rows("doc_id bigint, source string, text string", texts)
    prints = fingerprints(docs).join(docs.select("doc_id", "source"), "doc_id")
    found = {}
    for r in merged(prints, "source").collect():
        found.setdefault(r["source"], set()).add(r["hash"] % (1 << 64))
    union = set(brute_sketch(texts[0][2], SCALE)) | set(brute_sketch(texts[1][2], SCALE))
    assert found == {"a": {h for h in union if h < 2**64 // SCALE}, "b": set(brute_sketch("few words", SCALE))}


def test_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = QUERIES["op13_fingerprints"](spark, sf).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_edited(docs)
