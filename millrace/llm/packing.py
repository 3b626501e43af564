"""Lexical retrieval packing: windows filled with a seed document and its BM25 neighbours.

Documents are dealt by a hash into shards, whose size does not grow with the
corpus. A shard is one task; it works through blocks of bounded size, each with
an inverted index of its own. Every window starts with what is left of the
document cut last, or the next unused one; the index returns unused neighbours of
that seed, best first, and they fill the window, the last one being cut. Only the
end of a shard is shorter than a window; it is cut at powers of two, which need no
padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.batches import byte_rows, slices
from millrace.llm.tokens import word_tokens

#: Ids of one block: its documents and index fit in some 100 MB.
BLOCK_IDS = 4_000_000
QUERY_TERMS = 24
# Fixed values of BM25.
K1, B = 1.2, 0.75


class InvertedIndex:
    """BM25 postings over the token ids of a block of documents."""

    def __init__(self, docs: list[np.ndarray]):
        sizes = np.array([len(d) for d in docs])
        largest = max((int(d.max()) for d in docs if len(d)), default=0)
        # document and id in one number, of 32 bits where both fit in 16
        kind, bits = (np.uint32, 16) if max(len(docs) - 1, largest) >> 16 == 0 else (np.uint64, 32)
        keys = np.repeat(np.arange(len(docs), dtype=kind) << kind(bits), sizes)
        np.bitwise_or(keys, np.concatenate(docs), out=keys, casting="unsafe")  # signed ids, too: they fit
        keys.sort()
        first = np.ones(len(keys), dtype=bool)
        np.not_equal(keys[1:], keys[:-1], out=first[1:])
        at = np.flatnonzero(first).astype(np.int32 if len(keys) >> 31 == 0 else np.int64)
        tf = np.diff(at, append=at.dtype.type(len(keys))).astype(np.float32)
        keys = keys[at]
        del first, at  # a block is some million ids: what is not needed any more goes
        doc, flat = (keys >> kind(bits)).astype(np.int32), keys & kind((1 << bits) - 1)
        del keys
        self._bounds = np.searchsorted(doc, np.arange(len(docs) + 1))
        used = np.bincount(flat.astype(np.int64))  # ids are places in a vocabulary
        df = used[used > 0]
        self._term = (np.cumsum(used > 0) - 1).astype(np.int32)[flat]
        self._idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5)).astype(np.float32)
        self._df = df
        size = sizes.astype(np.float32)
        norm = K1 * (1 - B + B * size / max(size.mean(), 1))
        weight = self._idf[self._term] * tf * (K1 + 1) / (tf + norm[doc])
        self._gain = weight
        # 16 bits are sorted by their digits
        order = np.argsort(self._term.astype(np.uint16) if len(df) <= 1 << 16 else self._term, kind="stable")
        self._posted, self._weight = doc[order], weight[order]
        self._lists = np.concatenate([[0], np.cumsum(df)])
        self._n = len(docs)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share the seed's weightiest terms, best first."""
        own = slice(self._bounds[seed], self._bounds[seed + 1])
        terms, gain = self._term[own], self._gain[own]
        shared = self._df[terms] > 1
        terms, gain = terms[shared], gain[shared]
        if not len(terms):
            return terms
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argpartition(-gain, QUERY_TERMS)[:QUERY_TERMS]]
        scores = np.zeros(self._n, dtype=np.float32)
        for t in terms:
            at = slice(self._lists[t], self._lists[t + 1])
            scores[self._posted[at]] += self._weight[at]
        found = np.flatnonzero((scores > 0) & unused)
        # scores are positive, so their bits are in order, too; the place decides among equal ones
        keys = (~scores[found].view(np.uint32)).astype(np.uint64) << np.uint64(32) | found.astype(np.uint64)
        keys.sort()
        return (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def fill_windows(docs: list[np.ndarray], window: int, used: int) -> Iterator[tuple[int, int, int]]:
    """Pieces (document, start, length) in the order they fill windows; ``used`` ids are taken in the first."""
    index = InvertedIndex(docs)
    unused = np.ones(len(docs), dtype=bool)
    room, cursor = window - used, 0
    queue: list[int] = []  # neighbours of the window's seed, best last
    for _ in docs:
        is_seed = not queue
        if queue:
            current = queue.pop()
        else:
            while not unused[cursor]:
                cursor += 1
            current = cursor
        unused[current] = False
        at, size = 0, len(docs[current])
        while at < size:
            length = min(room, size - at)
            yield current, at, length
            at += length
            room -= length
            if not room:
                room, queue = window, []
                is_seed = at < size  # what is left of it starts the next window
        if is_seed:
            queue = index.neighbours(current, unused)[::-1].tolist()


def power_cuts(length: int) -> list[int]:
    """A length as descending powers of two."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


class Placer:
    """Gives pieces their sequence and offset, and cuts the end at powers of two."""

    def __init__(self, window: int, first_id: int):
        self._window, self._sequence, self._offset = window, first_id, 0
        self._open: list[tuple] = []

    @property
    def used(self) -> int:
        return self._offset

    def place(self, doc_id, start: int, ids: np.ndarray, total: int) -> Iterator[tuple]:
        self._open.append((doc_id, start, ids, total, self._offset))
        self._offset += len(ids)
        if self._offset == self._window:
            yield from (self._row(*piece) for piece in self._open)
            self._next()

    def close(self) -> Iterator[tuple]:
        """The last, shorter window as sequences whose lengths are powers of two."""
        pieces = [piece[:4] for piece in self._open]
        for size in power_cuts(self._offset):
            self._next()
            while self._offset < size:
                doc_id, start, ids, total = pieces.pop(0)
                take = min(len(ids), size - self._offset)
                yield self._row(doc_id, start, ids[:take], total, self._offset)
                self._offset += take
                if take < len(ids):
                    pieces.insert(0, (doc_id, start + take, ids[take:], total))

    def _next(self) -> None:
        if self._offset:
            self._sequence += 1
        self._open, self._offset = [], 0

    def _row(self, doc_id, start, ids, total, offset) -> tuple:
        return doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self._sequence, offset


FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2, shards: int | None = None,
    text_col: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """Every id of every document in exactly one piece; one row per piece.

    Columns: doc_id, start (the document's ids before the piece), length, ids_crc32,
    doc_tokens (with the end id), sequence_id, offset (of the piece in its sequence).
    A null or empty text is the end id alone. Repeated rows are packed each; a null
    id is kept. Neighbours with equal scores come in the shard's order, so a task
    that runs again gives the same pieces. An empty table gives no rows.
    """
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64("doc_id")
    dealt = wanted.withColumn("_key", key).repartition(shards, "_key").sortWithinPartitions("_key", F.xxhash64("text"))
    id_type = wanted.schema["doc_id"].dataType.simpleString()
    id_arrow = to_arrow_type(wanted.schema["doc_id"].dataType)
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def run(batches):
        from pyspark import TaskContext

        encoder = word_tokens(tokenizer_path)
        placer = Placer(window, TaskContext.get().partitionId() << 40)
        ids_of, names, held = [], [], 0

        def block():
            for i, start, length in fill_windows(ids_of, window, placer.used):
                yield from placer.place(names[i], start, ids_of[i][start : start + length], len(ids_of[i]))

        for batch in batches:
            for rows in slices(batch, "text"):
                packed = encoder.pack(byte_rows(rows.column("text")), end_id)
                names += rows.column("doc_id").to_pylist()
                ids_of += [np.frombuffer(p, "<u4") for p in packed]
                held += sum(map(len, packed)) // 4
                if held >= BLOCK_IDS:
                    yield as_batch(list(block()))
                    ids_of, names, held = [], [], 0
        rest = list(block()) if ids_of else []
        yield as_batch(rest + list(placer.close()))

    def as_batch(rows):
        columns = list(zip(*rows)) if rows else [[] for _ in FIELDS]
        types = [id_arrow] + [pa.int64()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(FIELDS))

    return dealt.select("doc_id", "text").mapInArrow(run, schema)
