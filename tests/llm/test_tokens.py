"""Ids put together from remembered words against the tokenizer itself."""

import struct

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import tokens as T

WORDS = P.path("word_bpe_49k.json")
PARTS = ["the", "Cat", "naïve", "İ", "ß", "日本語", "🙂", "x1", "...", ".", ",", "!?", ":", "'s", "don't", "<|endoftext|>", "<|EndOfText|>", "<|", "a.b.", "3,000", " ", "  ", "\n", "\x0b", " ", " ", "\x1c", "İ."]


def expected(texts):
    encoded = Tokenizer.from_file(WORDS).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [struct.pack(f"<{len(e.ids) + 1}I", *e.ids, 2) for e in encoded]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=12).map("".join), st.text(max_size=12)), min_size=1, max_size=5))
def test_equals_the_tokenizer(texts):
    assert T.word_tokens(WORDS).pack([(t or "").encode() for t in texts], 2) == expected(texts)


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 40)
    rng = np.random.default_rng(1)
    encoder = T.WordTokens(WORDS)
    for _ in range(20):
        texts = [" ".join(f"word{rng.integers(60)}." for _ in range(rng.integers(0, 30))) for _ in range(4)]
        assert encoder.pack([t.encode() for t in texts], 2) == expected(texts)
    assert len(encoder._new) + len(encoder._old) < 250


def test_words_are_encoded_together():
    """New words share calls of the tokenizer, also with zero bytes, runs of marks and special tokens among them."""
    texts = [f"word{i}x{i * 7919 % 1000}{m}" for i in range(300) for m in ("", "$$$", "?!", "é.", "\x00", "<|endoftext|>", "'")]
    memory = T.WordTokens(WORDS)
    inner, calls = memory._tokenizer, []

    class Counting:
        def encode_batch_fast(self, given, **options):
            calls.append(len(given))
            return inner.encode_batch_fast(given, **options)

    memory._tokenizer = Counting()
    assert memory.pack([" ".join(texts).encode()], 2) == expected([" ".join(texts)])
    assert sum(calls) < len(texts) / 2


def test_latin_words_skip_the_steps_before_the_model():
    """Words of Latin letters go to the model alone; what looks like them but is not does not."""
    letters = [f"{a}{b}{c}" for a in "abÉßſ" for b in ("", "ÿÀ", "Łx", "Ğı") for c in ("q", "é", "Ž")]
    others = ["İx", "x×y", "µa", "aª", "éa", "Σας", "ab'c", "a.b", "x\x00", "日x", "Ÿ", "aĿ", "aͅ"]
    memory = T.WordTokens(WORDS)
    inner, given = memory._tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return inner.encode_batch_fast(texts, **options)

    memory._tokenizer = Counting()
    text = " ".join(w + end for w in letters for end in ("", ".", "?!", "'"))
    assert memory.pack([text.encode()], 2) == expected([text])
    assert sorted(" ".join(given).replace("\x00", "").split()) == ["'", ".", "?!"]
    mixed = [" ".join(w + end for w in letters[i::4] + others for end in ("", ".", "'s", "'<|")) + " <|endoftext|>" for i in range(4)]
    assert memory.pack([t.encode() for t in mixed], 2) == expected(mixed)


def test_every_letter_is_encoded_as_by_the_tokenizer():
    """All characters of the first blocks, in and at both ends of words."""
    texts = [" ".join(f"{c} a{c} {c}a. A{c}b {c}'s É{c}ÿ" for c in map(chr, range(i, i + 64))) for i in range(1, 0x700, 64)]
    assert T.WordTokens(WORDS).pack([t.encode() for t in texts], 2) == expected(texts)
