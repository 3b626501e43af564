"""Arrow batches as byte buffers, and word hashes over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
#: For steps that need many times the memory of their slice: arrays that fit in a core's cache.
SMALL_SLICE = 1 << 18
#: ASCII white space: space and the codes 9 to 13.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes of text each, or one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the bounds of its rows; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def byte_rows(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null counts as empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, bounds: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``; a row's end also ends a word.

    ``gaps`` marks the bytes between words, white space if not given.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~gaps[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that do not overlap.

    The spans are processed in blocks, so that one huge text needs no more
    working memory than many small ones.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + SLICE_BYTES, side="right")))
        part = data[lo : ends[j - 1]]
        up, down = _power(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[part] * up[:-1], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word after lower-casing A-Z, and each row's first word."""
    starts, ends = word_spans(data, bounds)
    return span_hashes(LOWER[data], starts, ends), starts, ends, np.searchsorted(starts, bounds)


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words, order counting."""
    count = len(words) - n + 1
    out = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(3) + words[k : k + count] + np.uint64(k))
    return out
