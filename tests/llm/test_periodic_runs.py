"""Periodic runs against brute force, and on nulls, empty and long texts, repeats and empty tables."""

import hashlib
import re
import zlib
from fractions import Fraction

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm.periodic_runs import periodic_runs, run_digest, runs_of
from millrace.llm import queries as _  # noqa: F401  registers the queries
from millrace.llm.registry import QUERIES
from millrace.llm.words import words_of

SCHEMA = "doc_id bigint, text string"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(w):
    """Every maximal stretch of period q, for each q, that has no smaller period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(6, 4 * q):
                if not any(all(w[x] == w[x + p] for x in range(i, i + size - p)) for p in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), max_size=9), st.integers(1, 9)), max_size=5))
def test_runs_equal_brute_force(parts):
    w = [x for block, times in parts for x in block * times]
    words = words_of(pa.array([None, " ".join(w), "x x x", "\t".join(w)]))
    row, start, length, period = runs_of(words)
    found = [[], [], [], []]
    for r, s, n, q in zip(row, start, length, period):
        found[r].append((s - words.rows[r], n, q))
    assert found == [[], brute_runs(w), [], brute_runs(w)]


def test_nested_runs_of_two_periods(rows):
    text = " ".join((["a"] * 8 + ["b"]) * 5)
    r = periodic_runs(rows(SCHEMA, [(1, text)])).first()
    assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == brute_runs(text.split())
    assert {x["period"] for x in r["runs"]} == {1, 9} and r["n_words"] == 45


def test_edges(rows):
    long_text = " ".join(f"w{i % 5000}" for i in range(60000))
    data = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c"), (5, "x " * 6), (5, "x " * 6), (6, "x x x x x"), (7, long_text), (8, "é é " * 9)]
    df = rows(SCHEMA, data).withColumns({c: F.lit(1) for c in ("runs", "h", "row", "start", "_best", "n_words", "collapsed")})
    found = periodic_runs(df)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()), key=repr)
    want = [(i, len(split(t)), brute_runs(split(t)) if i != 7 else [(0, 60000, 5000)]) for i, t in data]
    assert got == sorted([(*x, collapsed(split(t), x[2])) for x, (_, t) in zip(want, data)], key=repr)
    assert periodic_runs(rows(SCHEMA, [])).count() == 0
    assert run_digest(periodic_runs(rows(SCHEMA, []))).count() == 0


def test_greatest_exponent_is_exact(rows):
    texts = {1: "a b " * 3 + "a b c " + "x y z " * 5 + "x y", 2: " ".join(["a"] * 6 + ["b"] * 6), 3: "q"}
    for r in run_digest(periodic_runs(rows(SCHEMA, list(texts.items())))).collect():
        check_digest(r, split(texts[r["doc_id"]]))


def check_digest(r, w):
    runs = brute_runs(w)
    assert r["n_runs"] == len(runs)
    if runs:
        s, n, q = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (s, n, q, 1000 * n // q)
    else:
        assert r["start"] is r["length"] is r["period"] is r["exponent_milli"] is None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
    assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op11_periodic_runs"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    checked = 0
    for r in found:
        w, h = split(texts[r["doc_id"]]), zlib.crc32(str(r["doc_id"]).encode())
        if len(w) > 700:
            continue  # brute force takes the square of the words
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        check_digest(r, w)
        checked += 1
    assert checked > len(texts) / 2 and any(r["n_runs"] for r in found)
