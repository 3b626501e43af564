"""Memory of a Python worker: what a step takes besides its batch, and what it leaves behind."""

import time
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa

from millrace.llm import near_dedup, packing, tokens


def peak(run) -> int:
    """Most bytes that a call holds at once."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_index_of_a_block_is_built_in_little_memory():
    docs = list(np.random.default_rng(1).integers(3, 49_000, (400, 1_000)).astype("<u4"))
    assert peak(lambda: packing.InvertedIndex(docs)) < 50 * 400_000


def test_index_is_the_same_with_wide_ids():
    docs = list(np.random.default_rng(2).integers(3, 900, (60, 200)).astype("<u4"))
    wide = [np.where(d == 899, 70_000, d).astype("<u4") for d in docs]
    assert list(packing.fill_windows(docs, 512, 0)) == list(packing.fill_windows(wide, 512, 0))


def test_sketches_take_little_more_than_their_batch():
    class Docs:
        schema = {"doc_id": SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))}

        def mapInArrow(self, run, schema):
            return run

    texts = [" ".join(f"w{(i * 7919 + k) % 9973}" for k in range(1500)) for i in range(500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(500)), "text": texts})
    run = near_dedup.sketches(Docs())
    assert peak(lambda: [len(out) for out in run([batch])]) < 40_000_000


def test_words_are_forgotten_by_an_idle_worker(monkeypatch):
    monkeypatch.setattr(tokens, "IDLE_SECONDS", 0.2)
    encoder = tokens.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    first = encoder.pack([b"One two, three."], 2)
    assert encoder._new
    time.sleep(1)
    assert not encoder._new and not encoder._old
    assert encoder.pack([b"One two, three."], 2) == first
