"""Words of a text column, named exactly by the bytes they consist of."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.batches import text_bytes, word_spans


@dataclass(frozen=True)
class Words:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the rows of one column, in order.

    ``codes[i]`` is the place of word i in ``distinct`` (binary), so two words are equal
    exactly if their codes are; no hash decides. ``rows[r]:rows[r+1]`` are the words of row r.
    """

    codes: np.ndarray
    distinct: pa.Array
    rows: np.ndarray

    def joined(self, keep: np.ndarray) -> pa.Array:
        """Text of each row from the words marked in ``keep``, one space between them."""
        chosen = pa.array(self.codes[keep], pa.int32())
        bounds = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))[self.rows]
        texts = self.distinct.cast(pa.large_string()).take(chosen)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), texts), pa.scalar(" ", pa.large_string()))


def words_of(column: pa.Array) -> Words:
    """The words of a string column; null counts as empty."""
    data, bounds = text_bytes(column)
    starts, ends = word_spans(data, bounds)
    marks = np.zeros(len(data) + 1, np.int8)
    marks[starts] = 1
    marks[ends] -= 1  # where a row ends and the next begins with a word, both happen at one byte
    solid = np.cumsum(marks[:-1], dtype=np.int8).astype(bool)
    offsets = np.concatenate(([0], np.cumsum(ends - starts, dtype=np.int64)))
    values = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])]
    ).dictionary_encode()
    codes = np.asarray(values.indices, dtype=np.int32)
    return Words(codes, values.dictionary, np.searchsorted(starts, bounds))
