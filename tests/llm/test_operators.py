"""Every operator against brute force, and on nulls, empty and long texts, ties, repeats and empty tables."""

import base64
import hashlib
import re
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import queries as _  # noqa: F401  registers the queries
from millrace.llm import bpe, exact_dedup, hamming_search, language, near_dedup, packing, quality, substring_dedup, token_files, toxicity
from millrace.llm.registry import ORACLES, QUERIES
from millrace.session import scratch_path, stage
from tests.compare import connect, differences

WORDS = P.path("word_bpe_49k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30000))
# null and empty texts, white space only, repeats, a long text, columns named like internal ones
EDGES = [
    (1, None, "en", None, None), (2, "", None, "a", 0), (3, " \t\n", "en", "a", 3), (4, "One two,  three.", "en", "b", 5),
    (5, "One two, three.", "en", "b", 5), (5, "One two, three.", "en", "b", 5), (6, LONG, "en", "b", 9), (7, "naïve café — 日本語 …", "fr", "c", 2),
]


@pytest.fixture(scope="module")
def edges(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGES, SCHEMA)
    return df.withColumns({c: F.lit(1) for c in ("key", "tie", "_key", "n", "rest", "slot", "id", "label", "row", "_keep", "_sha")})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup(edges, nothing):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_duplicates(edges).collect()}
    groups = {}
    for i, t, *_ in EDGES:
        groups.setdefault(normal(t), []).append(i)
    want = {(i, min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert got == want
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    kept = exact_dedup.drop_exact(edges)
    assert kept.columns == edges.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 6, 7]


def test_chunks_that_share_a_key_are_told_apart(rows):
    found = exact_dedup.verified_ids(rows("key long, digest binary", [(1, b"a"), (1, b"b"), (1, b"a"), (2, b"a")])).collect()
    assert len(found) == 3 and len({tuple(r["chunk_id"]) for r in found}) == 3


def sets_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def brute_components(texts, percent):
    sets = {i: sets_of(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(sorted(texts), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            label[max(x, y)] = min(x, y)
    return {i: root(i) for i in texts}, {i: len(s) for i, s in sets.items()}


def near_texts(n, seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"word{i}" for i in range(400)]
    passage = [f"shared{i}" for i in range(60)]
    texts = {}
    while len(texts) < n:
        base = list(rng.choice(vocabulary, rng.integers(40, 200)))
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.integers(1, 6)):
            copy = list(base)
            for _ in range(rng.integers(0, 5)):
                copy[rng.integers(len(copy))] = f"edit{rng.integers(10**6)}"
            texts[len(texts)] = " ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy)
    return texts


@pytest.mark.parametrize("percent", [80, 85])
def test_near_components(rows, percent):
    texts = near_texts(150, percent)
    want, sizes = brute_components(texts, percent)
    found = near_dedup.near_duplicates(rows("doc_id long, text string", list(texts.items())), percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert {r["doc_id"]: r["n_shingles"] for r in found} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_edges(edges, nothing):
    found = sorted((r["doc_id"], r["component_id"], r["n_shingles"]) for r in near_dedup.near_duplicates(edges).collect())
    n_long = len(sets_of(LONG))
    assert found == [(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (5, 4, 1), (5, 4, 1), (6, 6, n_long), (7, 7, 1)]
    assert near_dedup.near_duplicates(nothing).count() == 0
    assert sorted(r["doc_id"] for r in near_dedup.drop_near(edges).collect()) == [1, 2, 3, 4, 6, 7]


def test_near_copies_that_are_not_linked_rarely_meet(rows, monkeypatch):
    """Own words at the same three places: 134 of 158 shingles in common, just less than 85 %."""
    made = {}

    def counted(df, name):
        out = stage(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(near_dedup, "stage", counted)
    texts = {}
    for i in range(60):
        words = [f"w{k}" for k in range(150)]
        for k in (1, 50, 100):
            words[k] = f"own{i}x{k}"
        texts[i] = " ".join(words)
    long = [f"v{k}" for k in range(104)]  # 85 of 100 shingles: linked
    texts |= {100: " ".join(long), 101: " ".join(long[:89]), 102: " ".join(long[:88])}
    found = near_dedup.near_duplicates(rows("doc_id long, text string", list(texts.items()))).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute_components(texts, 85)[0]
    assert made["across"] <= len(texts)


def word_ids(texts):
    encoded = Tokenizer.from_file(WORDS).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array(e.ids + [2], "<u4") for e in encoded]


def check_packing(found, texts, window):
    ids = dict(zip(texts, word_ids(texts.values())))
    by_doc, by_sequence = {}, {}
    for r in found:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(piece.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == texts.keys()
    for i, pieces in by_doc.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at and length > 0
            at += length
        assert at == len(ids[i])
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)


def test_packing(rows, nothing):
    texts = {i: t for i, t, *_ in EDGES} | {100 + i: t for i, t in near_texts(40, 3).items()}
    df = rows("doc_id long, text string", list(texts.items()))
    check_packing(packing.pack(df, WORDS, window=256, shards=2).collect(), texts, 256)
    check_packing(packing.pack(df, WORDS).collect(), texts, 4096)
    assert packing.pack(nothing, WORDS).count() == 0


def test_neighbours_share_words():
    index = packing.InvertedIndex([np.array(x) for x in ([1, 2, 3], [7, 8, 9], [1, 2, 9], [3, 3, 3], [50, 51, 52])])
    assert index.neighbours(0, np.array([False, True, True, True, True])).tolist()[0] == 2
    assert 4 not in index.neighbours(0, np.ones(5, bool)) and 1 not in index.neighbours(0, np.ones(5, bool))


def test_index_counts_and_orders_like_plain_bm25():
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 30, rng.integers(0, 12)).astype("<u4") for _ in range(50)] + [np.array([2], "<u4")] * 3
    index, n, mean = packing.InvertedIndex(docs), len(docs), np.mean([len(d) for d in docs])
    df = {t: sum(t in d for d in docs) for t in range(30)}

    def score(seed, i):
        norm = packing.K1 * (1 - packing.B + packing.B * len(docs[i]) / mean)
        tf = lambda t: int((docs[i] == t).sum())
        return sum(np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf(t) * (packing.K1 + 1) / (tf(t) + norm) for t in set(docs[seed].tolist()))

    for seed in range(n):
        found = index.neighbours(seed, np.ones(n, bool)).tolist()
        scores = [score(seed, i) for i in range(n)]
        assert sorted(found) == [i for i in range(n) if scores[i] > 0]
        assert all(scores[a] > scores[b] - 1e-4 for a, b in zip(found, found[1:]))
        assert all(a < b for a, b in zip(found, found[1:]) if docs[a].tolist() == docs[b].tolist())


def test_token_files(spark, edges, nothing):
    folder = scratch_path(spark, "tokens")
    found = sorted(map(tuple, token_files.token_table(edges, WORDS, folder=folder).collect()))
    start, want = 0, []
    for (i, *_), ids in zip(EDGES, word_ids([t for _, t, *_ in EDGES])):
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == sorted(want)
    assert token_files.token_table(nothing, WORDS).count() == 0


def test_token_file_frames(tmp_path):
    docs = {i: np.arange(i, i + 5 * i, dtype="<u4").tobytes() for i in range(40)}
    path = tmp_path / "a.tok"
    with open(path, "wb") as f:
        writer = token_files.TokenWriter(f, frame_ids=100)
        for i, ids in docs.items():
            writer.add(i, ids)
        assert writer.close() > 10
    with open(path, "rb") as f:
        reader = token_files.TokenReader(f, path.stat().st_size)
        assert all(reader.find(i) == [ids] for i, ids in docs.items() if ids) and reader.find(99) == []
        assert reader.starts().tolist() == np.cumsum([0] + [len(d) // 4 for d in docs.values()])[:-1].tolist()
    data = bytearray(path.read_bytes())
    data[9] ^= 0xFF
    path.write_bytes(data)
    with open(path, "rb") as f, pytest.raises(Exception):
        token_files.TokenReader(f, len(data)).find(1)


def removed_text(text, spans):
    out, at = [], 0
    for s in spans:
        out.append(text[at : s["start"]])
        at = s["start"] + s["length"]
    return "".join(out) + text[at:]


def test_substring_dedup(rows, edges, nothing):
    rng = np.random.default_rng(5)
    own = lambda n: " ".join(f"u{rng.integers(10**9)}" for _ in range(n))
    passage, line = own(60), "Eight words stand in this line all alone é."
    texts = {1: f"{own(30)} {passage} {own(30)}\n{line}\nshort line", 2: own(80), 3: f"{line}\n{own(20)} {passage} {own(5)}\nshort line", 4: passage}
    found = {r["doc_id"]: r for r in substring_dedup.substring_dedup(rows("doc_id long, text string", list(texts.items()))).collect()}
    for i, r in found.items():
        assert removed_text(texts[i], r["removed"]) == r["text"]
    assert found[1]["text"] == texts[1] and found[2]["text"] == texts[2]
    assert line not in found[3]["text"] and "short line" in found[3]["text"]
    assert found[4]["n_removed"] > 0 and len(found[4]["text"].split()) < 30
    kept = set(zip(*[passage.split()[i:] for i in range(30)]))
    assert not kept & set(zip(*[found[3]["text"].split()[i:] for i in range(30)]))
    same = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(edges).collect()}
    assert same[1] is None and same[2] == "" and same[4] == "One two,  three." and same[5] == EDGES[4][1]
    assert substring_dedup.without_repeats(edges).columns == edges.columns
    assert substring_dedup.substring_dedup(nothing).count() == 0


def test_units_met_in_different_documents_stay(rows):
    small = [f"common{i}" for i in range(24)]
    texts = {i: f"{w}\nalone{i}" for i, w in enumerate(small)} | {100: "\n".join(small), 101: "\n".join(small[::-1])}
    texts |= {102: "x\n" + "\n".join(small) + "\ny", 103: "ha " * 20, 104: ("\n".join(f"v{i}" for i in range(20)) + "\n") * 2}
    found = {r["doc_id"]: r for r in substring_dedup.substring_dedup(rows("doc_id long, text string", list(texts.items()))).collect()}
    assert all(found[i]["text"] == texts[i] for i in texts if i not in (102, 104))
    assert found[102]["text"].split() == ["x", "y"] and found[102]["n_removed"] == 24
    assert found[104]["text"].split() == texts[104].split()[:20]


def test_wrapped_and_repetitive_passages_are_found(rows):
    rng = np.random.default_rng(11)
    texts = {}
    for i in range(300):
        passage = [f"p{rng.integers(10**9)}" for _ in range(51)]
        if i % 3 == 1:
            passage = passage[:2] * 25 + passage[2:3]
        own = [f"o{rng.integers(10**9)}" for _ in range(60)]
        wide = int(rng.integers(5, 24))
        wrapped = "\n".join(" ".join(passage[k : k + wide]) for k in range(0, 51, wide)) if i % 3 else " ".join(passage)
        texts[i] = " ".join(own[:30] + passage + own[30:]), passage
        texts[1000 + i] = " ".join(own[::-1][:30]) + " " + wrapped + " end", passage
    df = rows("doc_id long, text string", [(i, t) for i, (t, _) in texts.items()])
    found = {r["doc_id"]: r["text"] for r in substring_dedup.substring_dedup(df).collect()}
    left = [i for i in range(1000, 1300) if " ".join(texts[i][1]) in " ".join(found[i].split())]
    assert not left
    cuts = np.flatnonzero(substring_dedup.part_ends(np.arange(500, dtype=np.uint64) ** 2 % 7, np.zeros(500, int)))
    assert np.diff(cuts).max() <= 8


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(edges, nothing, tik):
    got = sorted(map(tuple, bpe.round_trip(edges, RANKS, P.PATTERN).collect()))
    want = []
    for i, t, *_ in EDGES:
        ids = np.array(tik.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip(nothing, RANKS, P.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text("aeinst h", max_size=200) | st.integers(1, 9000).map(lambda n: "ab" * n))
def test_bpe_matches_the_merge_rule(tik, text):
    assert bpe.byte_bpe(RANKS, P.PATTERN).encode(text) == np.array(tik.encode_ordinary(text), "<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40) | st.text(max_size=20).map(str.encode), st.lists(st.integers(0, 40), max_size=5))
def test_utf8_machine_in_any_cuts(data, cuts):
    machine, at, out = bpe.Utf8Machine(), 0, []
    for cut in [*sorted(cuts), len(data)]:
        out.append(machine.feed(data[at:cut]))
        at = max(at, cut)
    assert "".join(out) + machine.close() == data.decode("utf-8", "replace")


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(2)
    texts, grades = [], []
    for _ in range(300):
        g = int(rng.integers(0, 4))
        texts.append(" ".join(rng.choice(["good", "fine"] if rng.random() < g / 3 else ["bad", "poor"]) for _ in range(30)))
        grades.append(g)
    import pyarrow as pa

    rows = quality.features(*quality.text_bytes(pa.array(texts)))
    model = quality.OrdinalModel.fit(*rows, np.array(grades))
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    place = model.position(*quality.features(*quality.text_bytes(pa.array(["bad poor " * 15, "bad good " * 15, "good fine " * 15]))))
    assert (np.diff(model.expected(place)) > 0).all() and model.expected(place).min() >= 0 and model.expected(place).max() <= 3
    assert (np.diff(model.at_least(place), axis=1) < 0).all()


def test_quality_edges(spark, edges, nothing):
    ratings = spark.createDataFrame([(4, 1), (6, 0), (None, 1), (7, None)], "doc_id long, grade int")
    got = quality.grade(edges, quality.fit(edges, ratings)).collect()
    assert len(got) == len(EDGES) and all(0 <= r["tail_probability"] <= 1 for r in got)
    assert quality.fit(edges, ratings.where("false")) is None
    assert quality.grade(nothing, None).count() == 0 and quality.grade(edges, None).where("kept is null").count() == len(EDGES)


def test_toxicity_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(4, 1, 1), (6, 0, 2), (7, 0, 3), (2, 0, 4), (None, 1, 1)], "doc_id long, toxic int, fold int")
    for chosen in (labels, labels.where("toxic = 0"), labels.where("false")):
        got = toxicity.score(edges, toxicity.fit(edges, chosen)).collect()
        assert len(got) == len(EDGES) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.score(nothing, toxicity.fit(nothing, labels)).count() == 0


def test_toxicity_on_unseen_documents(spark):
    rng = np.random.default_rng(4)
    plain = [f"{a}{b}" for a in ("lo", "mi", "ta", "re") for b in ("na", "ko", "si", "pu", "de")]
    texts = []
    for i in range(600):
        words = list(rng.choice(plain, 60))
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(int(rng.integers(60)), "grub" + rng.choice(["as", "en", "ix", "oz", "ul"]))
        texts.append((i, " ".join(words), toxic, i % 5))
    df = spark.createDataFrame(texts, "doc_id long, text string, toxic int, fold int")
    model = toxicity.fit(df, df.where("fold > 0").select("doc_id", "toxic", "fold"))
    held = toxicity.score(df.where("fold = 0"), model).join(df, "doc_id")
    assert held.where("predicted <> toxic").count() <= 2


def toxic_recall(spark, make, n=600):
    """Held-out toxic texts found and false alarms, of texts that make(i, toxic, rng) writes."""
    rng = np.random.default_rng(8)
    texts = [(i, make(i, int(i % 4 == 0), rng), int(i % 4 == 0), i % 5) for i in range(n)]
    df = spark.createDataFrame(texts, "doc_id long, text string, toxic int, fold int")
    model = toxicity.fit(df, df.where("fold > 0").select("doc_id", "toxic", "fold"))
    held = toxicity.score(df.where("fold = 0"), model).join(df, "doc_id").select("predicted", "toxic").collect()
    toxic = [r["predicted"] for r in held if r["toxic"]]
    return sum(toxic) / len(toxic), sum(r["predicted"] for r in held if not r["toxic"])


PLAIN = [f"{a}{b}" for a in ("lo", "mi", "ta", "re") for b in ("na", "ko", "si", "pu", "de")]


def test_toxic_expression_of_ordinary_words(spark):
    def make(i, toxic, rng):
        # both words stand in every text, side by side only in toxic ones
        return " ".join([*rng.choice(PLAIN, 30), *(["yy", "gofar", "away", "yy"] if toxic else ["gofar", "yy", "yy", "away"]) * 3])

    recall, alarms = toxic_recall(spark, make)
    assert recall >= 0.9 and alarms <= 3


def test_all_labelled_rows_are_counted(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_LABELLED", 40)
    insults = [f"{a}{b}{a}x" for a in "cfhjqvwz" for b in "aeiou"]
    recall, alarms = toxic_recall(spark, lambda i, t, rng: " ".join([*rng.choice(PLAIN, 20), *rng.choice(insults if t else PLAIN, 3)]))
    assert recall >= 0.9 and alarms <= 3


def test_toxic_parts_inside_long_words(spark):
    def make(i, toxic, rng):
        glued = "lonamikotasirepu" + ("grubas" if toxic else "talona") + "mina"
        signs = "\u4ECA\u65E5\u662F\u597D\u7684\u4EBA" + ("\u6B7B\u72D7" if toxic else "\u5929\u6C14")
        return " ".join(list(rng.choice(PLAIN, 10)) + [glued if i % 3 else signs] * 2)

    recall, alarms = toxic_recall(spark, make)
    assert recall >= 0.9 and alarms <= 3


def test_language(spark, edges, nothing):
    en, fr = "the house and the garden of the man with that dog ", "la maison et le jardin avec les enfants dans une ville "
    texts = [(i, (en if i % 2 else fr) * 4, "en" if i % 2 else "fr") for i in range(40)]
    model = language.fit(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    pages = spark.createDataFrame(
        [(1, "https://a.example.fr/x", f"<html lang='fr'><script>var the = 'the and of'</script><p>{fr}</p></html>"),
         (2, "http://b.example.com", f"<html><p>{en}</p>"), (3, None, None), (4, "nonsense", ""), (5, "http://b.example.com/q", "<p>1234 %% 5678</p>"),
         (6, "http://b.example.com/r", "<html lang=EN-gb>" + "zqx jwv kqz vvx xzq wjq " * 10)],
        "page_id long, url string, html string",
    )
    got = {r["id"]: r for r in language.identify(language.page_rows(pages), model).collect()}
    assert [got[i]["lang"] for i in range(1, 7)] == ["fr", "en", "other", "other", "other", "other"]
    assert [got[i]["accepted"] for i in range(1, 7)] == [True, True, False, False, False, False]
    empty = language.page_rows(pages).where("false")
    assert language.identify(empty, model).count() == 0
    assert language.fit(nothing).languages == ["other"]


def test_host_prior_decides_where_text_does_not(spark):
    en, fr = "the house and the garden of the man ", "la maison et le jardin avec les enfants "
    model = language.fit(spark.createDataFrame([(0, en * 5, "en"), (1, fr * 5, "fr")], "doc_id long, text string, lang string"))
    rows = [(i, fr * 3, None, None, "x.org") for i in range(30)] + [(i, en * 3, None, None, "y.org") for i in range(30, 60)]
    rows += [(100, "ab", None, None, "x.org"), (101, "ab", None, None, "y.org")]
    got = language.identify(spark.createDataFrame(rows, "id long, text string, declared string, suffix string, host string"), model)
    got = {r["id"]: r["lang"] for r in got.where("id >= 100").collect()}
    assert got[100] == "other" or got == {100: "fr", 101: "en"}


def test_hamming_search(spark, rows, sf):
    rng = np.random.default_rng(3)
    codes = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 80)] + [5] * 30 + [4, 7, -1, 0]
    df = rows("id long, code long", [*enumerate(codes), (500, None), (0, codes[0])])
    queries = df.where("id % 9 = 0")
    for width in (8, None):
        got = sorted(map(tuple, hamming_search.hamming_top_k(df, queries, k=7, width=width).collect()))
        want = []
        for q in range(0, len(codes), 9):
            order = sorted((bin((codes[q] ^ c) & (2**64 - 1)).count("1"), i) for i, c in enumerate(codes))[:7]
            want += [(q, n + 1, i, d) for n, (d, i) in enumerate(order)]
        assert got == sorted(want)
    assert hamming_search.hamming_top_k(df.where("false"), queries).count() == 0
    few = hamming_search.hamming_top_k(df.where("id < 3"), df.where("id = 1"), k=7).collect()
    assert len(few) == 3
    vectors = rows("v array<float>, i long", [([1.0, -1.0, None, float("nan"), 2.0], 1), (None, 2), ([], 3)])
    assert sorted(map(tuple, hamming_search.sign_codes(vectors, "v", "i").collect())) == [(1, 17), (3, 0)]


@pytest.mark.parametrize("name", ["op9_exact_dedup", "op10_hamming_search"])
def test_query_against_sql(spark, sf, name):
    n, diff = differences(spark, connect(sf), QUERIES[name], ORACLES[name], sf)
    assert diff is None and n > 0


def test_exact_dedup_is_native(spark, sf):
    plan = QUERIES["op9_exact_dedup"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline(spark, edges):
    docs, counts = edges.select("doc_id", "text", "lang", "source", "n_chars"), []
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, ""), name)
        counts.append(sorted(r["doc_id"] for r in docs.select("doc_id").distinct().collect()))
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert not {1, 2, 3} & set(counts[0]) and 6 in counts[0]
    assert all(set(b) <= set(a) for a, b in zip(counts, counts[1:])) and set(counts[3]) == set(counts[4])
