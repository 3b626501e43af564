"""Token ids of whole texts, by a public tokenizer file that splits at white space."""

from __future__ import annotations

import codecs
import os
import string
import struct
import threading
from itertools import compress, filterfalse
from operator import add, not_

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from millrace.llm.batches import LOWER

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
#: Distinct words in one generation of the memory of a Python worker; two are kept.
REMEMBERED = 250_000
#: Seconds without a text after which a Python worker, which other steps go on to use, empties that memory.
IDLE_SECONDS = 5.0
#: Words that are encoded together, and what stands between them: a character that is a token of its own.
TOGETHER = 40
MARK = b"\x00"
BETWEEN = b" " + MARK + b" "
#: Marks that, after a letter or digit, are a piece of their own at the end of a word, however many.
END_MARKS = string.punctuation.encode()
#: Words of Latin letters that are encoded together.
LETTERS_TOGETHER = 400
#: Basic Latin, Latin-1 and Latin Extended-A but for the dotted capital I: letters that are their own composed form and
#: have one lower-case letter each.
LATIN = "".join(c for c in map(chr, range(0x180)) if c.isalpha() and c not in "ªµºİ")
#: Lower-case forms of their second bytes by first byte, 0 for what is no such letter or has a lower-case form with another
#: first byte; and what bytes are: an ASCII letter, a first byte of these letters, a mark, a byte after a first byte.
LOWER_SECOND = np.zeros((256, 256), np.uint8)
KIND = np.zeros(256, np.uint8)
LETTER, FIRST, CLOSING, SECOND = 1, 2, 3, 4
for _letter in LATIN:
    _own, _lower = _letter.encode(), _letter.lower().encode()
    KIND[_own[0]] = LETTER if len(_own) == 1 else FIRST
    if len(_own) == 2 and _own[0] == _lower[0]:
        LOWER_SECOND[_own[0], _own[1]] = _lower[1]
KIND[list(END_MARKS)] = CLOSING
KIND[0x80:0xC0] = SECOND


def latin_stems(words: list[bytes]) -> tuple[list[bool], list[bytes]]:
    """Which of the words (without white space) are Latin letters, perhaps with closing marks, and their letters in lower case."""
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.append(0, ends[:-1] + 1)
    kind, lower = KIND[data], LOWER[data]
    second = np.flatnonzero(kind == SECOND)
    lower[second] = LOWER_SECOND[data[second - 1], data[second]]
    kind[second[lower[second] == 0]] = 0
    letter = (kind != 0) & (kind != CLOSING)
    # a letter follows letters, a mark follows anything but the word's start
    wrong = kind == 0
    wrong[1:] |= letter[1:] & (kind[:-1] == CLOSING)
    wrong[starts] |= ~letter[starts]
    wrong[ends] = False
    wrong = np.add.reduceat(wrong, starts, dtype=np.int64) > 0
    kept = letter & ~np.repeat(wrong, ends + 1 - starts)
    return (~wrong).tolist(), np.where(kept, lower, np.uint8(32)).tobytes().split()


def _byte_letters() -> str:
    """The character that stands for each byte in byte-level vocabularies; a space stays a space."""
    own = [b for first, last in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(first, last + 1)]
    others = [b for b in range(256) if b not in own]
    at = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)} | {0x20: " "}
    return "".join(at[b] for b in range(256))


BYTE_LETTERS = _byte_letters()


def _lettered(data: bytes) -> str:
    return codecs.charmap_decode(data, "strict", BYTE_LETTERS)[0]


def latin_tokenizer(tokenizer: Tokenizer) -> Tokenizer | None:
    """A tokenizer with the same model that takes lower-case Latin words as byte letters with spaces between.

    Such words need neither composing nor the search for pieces, which take most of the time. None if the tokenizer's
    own steps make anything else of Latin letters than one lower-case piece.
    """
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None or not tokenizer.model.end_of_word_suffix:
        return None
    lower = tokenizer.normalizer.normalize_str(LATIN)
    pieces = [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(lower)]
    if lower != LATIN.lower() or pieces != [_lettered(lower.encode())]:
        return None
    plain = Tokenizer(tokenizer.model)
    plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return plain


class WordTokens:
    """Packed ids of words; those met lately are remembered.

    The tokenizer's patterns never cross white space and it drops case, so the ids
    of a text are the ids of its lower-cased words in order, and closing marks after
    a letter or digit are a piece of their own. Most words repeat and are encoded once,
    those of Latin letters alone by the model without the steps before it.
    """

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._new: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        mark = self._tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        self._mark = mark[0] if len(mark) == 1 else None
        self._latin = latin_tokenizer(self._tokenizer)
        if self._latin is not None:
            suffix, vocabulary = self._tokenizer.model.end_of_word_suffix, self._latin.get_vocab()
            self._closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self._closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._lock = threading.Lock()
        self._timer: threading.Timer | None = None

    def _encode(self, words: list[bytes]) -> None:
        """Many words are one text for the tokenizer, with a mark that none of them has between them."""
        plain = [w for w in words if MARK not in w and b"<|" not in w] if self._mark is not None else []
        for i in range(0, len(plain), TOGETHER):
            part = plain[i : i + TOGETHER]
            text = BETWEEN.join(part).decode("utf-8", "replace")
            ids = np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.dtype("<u4"))
            ends = np.flatnonzero(ids == self._mark).tolist() + [len(ids)]
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not keep words apart")
            data, at = ids.tobytes(), 0
            for w, end in zip(part, ends):
                self._new[w] = data[4 * at : 4 * end]
                at = end + 1
        rest = [w for w in words if MARK in w or b"<|" in w] if self._mark is not None else words
        texts = [w.decode("utf-8", "replace") for w in rest]
        for w, e in zip(rest, self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = e.ids
            self._new[w] = struct.pack(f"<{len(ids)}I", *ids)

    def _encode_latin(self, words: list[bytes]) -> None:
        """Lower-case words of Latin letters, whose last id says that a word ends."""
        for i in range(0, len(words), LETTERS_TOGETHER):
            part = words[i : i + LETTERS_TOGETHER]
            text = _lettered(b" ".join(part))
            ids = np.array(self._latin.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.dtype("<u4"))
            ends = (4 * np.flatnonzero(self._closes[ids]) + 4).tolist()
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not keep words apart")
            self._new.update(zip(part, map(ids.tobytes().__getitem__, map(slice, [0, *ends], ends))))

    def _unknown(self, words: set[bytes]) -> list[bytes]:
        """Words that are in neither generation; those of the older one move to the newer."""
        new, old = self._new, self._old
        # filters look up each word; a difference of sets would go through all that is remembered
        words = list(filterfalse(new.__contains__, words))
        known = list(filter(old.__contains__, words))
        new.update(zip(known, map(old.__getitem__, known)))
        return list(filterfalse(new.__contains__, words)) if known else words

    def _learn(self, words: set[bytes]) -> None:
        """Encode the words not remembered, most of them many in one call."""
        new = self._new
        others, unknown, marked = self._unknown(words), set(), []
        latin, stems, ends = [], [], []
        if self._latin is not None and others:
            plain, stems = latin_stems(others)
            latin = list(compress(others, plain))
            others = list(compress(others, map(not_, plain)))
            ends = [w[len(stem) :] for w, stem in zip(latin, stems)]
            unknown.update(ends)
            unknown.discard(b"")
        for w in others:
            stem = w.rstrip(END_MARKS)
            if len(stem) < len(w) and stem[-1:].isalnum() and b"<|" not in w:
                marked.append((w, stem, w[len(stem) :]))
                unknown.update(marked[-1][1:])
            else:
                unknown.add(w)
        self._encode_latin(self._unknown(set(stems)))
        self._encode(self._unknown(unknown))
        new.update(zip(latin, map(add, map(new.__getitem__, stems), (new[end] if end else b"" for end in ends))))
        for w, stem, end in marked:
            new[w] = new[stem] + new[end]

    def _forget(self) -> None:
        """Empty the memory, which would otherwise outlive its stage in the Python worker."""
        with self._lock:
            self._new, self._old = {}, {}

    def pack(self, texts: list[bytes], end_id: int) -> list[bytes]:
        """Ids of each text and the end id, as little-endian unsigned 32-bit integers."""
        end = struct.pack("<I", end_id)
        # special tokens are written in angle brackets and bars; their case counts
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        if self._timer is not None:
            self._timer.cancel()
        with self._lock:
            if len(self._new) > REMEMBERED:
                self._old, self._new = self._new, {}
            known = [list(map(self._new.get, row)) for row in split]
            missing = [list(compress(row, map(not_, ids))) for row, ids in zip(split, known)]
            self._learn(set().union(*missing))
            packed = []
            for ids, words in zip(known, missing):
                late = map(self._new.__getitem__, words)
                packed.append(b"".join([i or next(late) for i in ids] if words else ids) + end)
        self._timer = threading.Timer(IDLE_SECONDS, self._forget)
        self._timer.daemon = True
        self._timer.start()
        return packed


_open: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of a path, opened once per Python worker."""
    if path not in _open:
        _open[path] = WordTokens(path)
    return _open[path]
