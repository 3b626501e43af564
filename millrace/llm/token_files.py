"""Token ids in files of independent zstandard frames with a trailing seek table.

One file holds the documents of one range of ids. Its layout:

- frames, each an independent zstandard frame over the ids (little-endian
  unsigned 32-bit) of whole documents, up to ``FRAME_IDS`` ids together; a longer
  document has a frame of its own;
- a skippable frame with the directory: for every document its id, frame, first
  id in the frame and number of ids;
- a skippable frame with the seek table in the public seekable layout: per frame
  compressed size, plain size and the low 32 bits of XXH64 over the plain bytes,
  then the number of frames, a flag byte and a closing magic number.

A reader takes the tail of the file, finds the frames of the wanted documents,
reads and decompresses only those, and compares their checksums.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.batches import byte_rows, slices
from millrace.llm.tokens import word_tokens
from millrace.session import scratch_path, stage

FRAME_IDS = 1 << 18
# Fixed values of the public formats: skippable frames, seek table and its end.
DIRECTORY_MAGIC = 0x184D2A5D
SEEK_MAGIC = 0x184D2A5E
SEEK_END = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

DIRECTORY = np.dtype([("doc_id", "<i8"), ("frame", "<u4"), ("first", "<u4"), ("count", "<u4")])
SEEK = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("checksum", "<u4")])
NULL_ID = np.iinfo(np.int64).min


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or an address."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class TokenWriter:
    """Writes one file; ``add`` takes documents in their final order."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS):
        self._sink, self._frame_bytes = sink, 4 * frame_ids
        self._codec = zstandard.ZstdCompressor(level=3)
        self._frame, self._size = [], 0
        self._entries: list[tuple[int, int, int, int]] = []
        self._frames: list[tuple[int, int, int]] = []

    def add(self, doc_id: int, packed: bytes) -> None:
        """Append a document's ids to the current frame, or to a new one if they do not fit."""
        if self._size and self._size + len(packed) > self._frame_bytes:
            self._flush()
        self._entries.append((doc_id, len(self._frames), self._size // 4, len(packed) // 4))
        self._frame.append(packed)
        self._size += len(packed)

    def _flush(self) -> None:
        if self._size:
            plain = b"".join(self._frame)
            packed = self._codec.compress(plain)
            self._sink.write(packed)
            self._frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            self._frame, self._size = [], 0

    def close(self) -> int:
        """Write directory and seek table; returns the number of frames."""
        self._flush()
        directory = np.array(self._entries, dtype=DIRECTORY).tobytes()
        body = self._codec.compress(directory)
        self._sink.write(struct.pack("<II", DIRECTORY_MAGIC, len(body)) + body)
        table = np.array(self._frames, dtype=SEEK).tobytes()
        end = struct.pack("<IBI", len(self._frames), CHECKSUM_FLAG, SEEK_END)
        self._sink.write(struct.pack("<II", SEEK_MAGIC, len(table) + len(end)) + table + end)
        return len(self._frames)


class TokenReader:
    """Reads documents of one file; only the frames asked for are decompressed."""

    def __init__(self, source, size: int):
        self._source = source
        count, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_END or flag != CHECKSUM_FLAG:
            raise ValueError("not a token file: its seek table is missing")
        table_at = size - 9 - SEEK.itemsize * count
        self.frames = np.frombuffer(self._at(table_at, SEEK.itemsize * count), dtype=SEEK)
        self._starts = np.concatenate([[0], np.cumsum(self.frames["packed"], dtype=np.int64)])
        magic, length = struct.unpack("<II", self._at(int(self._starts[-1]), 8))
        if magic != DIRECTORY_MAGIC:
            raise ValueError("not a token file: its directory is missing")
        body = self._at(int(self._starts[-1]) + 8, length)
        self.directory = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), dtype=DIRECTORY)

    def _at(self, start: int, length: int) -> bytes:
        self._source.seek(start)
        return self._source.read(length)

    def frame(self, number: int) -> bytes:
        """Plain bytes of one frame, compared with its checksum."""
        packed, size, checksum = (int(x) for x in self.frames[number])
        data = zstandard.ZstdDecompressor().decompress(
            self._at(int(self._starts[number]), packed), max_output_size=max(size, 1)
        )
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} is damaged")
        return data

    def documents(self, number: int) -> Iterator[tuple[int, int, bytes]]:
        """(place in the directory, doc_id, packed ids) of every document in a frame."""
        data = self.frame(number)
        first, last = np.searchsorted(self.directory["frame"], [number, number + 1])
        for place in range(first, last):
            entry = self.directory[place]
            start = 4 * int(entry["first"])
            yield place, int(entry["doc_id"]), data[start : start + 4 * int(entry["count"])]

    def starts(self) -> np.ndarray:
        """Ids in the file before each document."""
        counts = self.directory["count"].astype(np.int64)
        return np.cumsum(counts) - counts

    def find(self, doc_id: int) -> list[bytes]:
        """Packed ids of the documents with this id; other frames are not read."""
        frames = sorted({int(f) for f in self.directory["frame"][self.directory["doc_id"] == doc_id]})
        return [ids for n in frames for _, found, ids in self.documents(n) if found == doc_id]


def write_tokens(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Write the ids of every text to ``folder``; returns one row per file.

    Columns: part (files in ascending doc_id order), file, frames, documents, tokens.
    Each attempt of a task writes a file under a new name, and only the names in the
    returned table, which Spark commits, belong to the result. A null text is the
    empty text, so its document is the end id alone. Null ids come first and are
    read back as null. Rows with equal ids stay apart, ordered by their text's hash.
    """
    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wanted = wanted.withColumn("tie", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = wanted.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, base = open_folder(folder)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok.zst"
        documents = tokens = 0
        writer = sink = None
        encoder = word_tokens(tokenizer_path)
        for batch in batches:
            for rows in slices(batch, "text"):
                if writer is None:
                    system.create_dir(base, recursive=True)
                    sink = system.open_output_stream(f"{base}/{name}", compression=None)
                    writer = TokenWriter(sink)
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encoder.pack(byte_rows(rows.column("text")), end_id)):
                    writer.add(NULL_ID if doc_id is None else doc_id, ids)
                    documents += 1
                    tokens += len(ids) // 4
        if writer is not None:
            frames = writer.close()
            sink.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "file": name, "frames": frames, "documents": documents, "tokens": tokens}]
            )

    schema = "part long, file string, frames long, documents long, tokens long"
    return stage(ordered.select("doc_id", "text").mapInArrow(write, schema), "token-manifest")


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Every document in the files: doc_id, start (ids of all documents before it), ids (binary).

    Work is dealt out by runs of frames, so that one large file is read by many tasks.
    """
    before = F.sum("tokens").over(W.orderBy("part")) - F.col("tokens")  # one row per file
    work = manifest.withColumn("base", before).select(
        "file", "base", F.explode(F.sequence(F.lit(0), F.col("frames") - 1)).alias("frame")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = work.repartition(parts, "file", F.floor(F.col("frame") / 8)).sortWithinPartitions("file", "frame")

    def read(batches):
        system, base = open_folder(folder)
        for batch in batches:
            wanted: dict[tuple[str, int], list[int]] = {}
            for r in batch.to_pylist():
                wanted.setdefault((r["file"], r["base"]), []).append(r["frame"])
            for (name, before), frames in wanted.items():
                with system.open_input_file(f"{base}/{name}") as source:
                    reader = TokenReader(source, source.size())
                    starts = reader.starts() + before
                    for number in frames:
                        found = list(reader.documents(number))
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array([None if d == NULL_ID else d for _, d, _ in found], pa.int64()),
                            "start": pa.array([int(starts[p]) for p, _, _ in found], pa.int64()),
                            "ids": pa.array([i for _, _, i in found], pa.binary()),
                        })

    return work.mapInArrow(read, "doc_id long, start long, ids binary")


def token_table(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None,
    text_col: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """Write the token files, read them back: doc_id, start, n_tokens, ids_crc32.

    An empty table gives no rows and no files.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    manifest = write_tokens(docs, folder, tokenizer_path, end_id, text_col, id_col)
    return read_documents(spark, folder, manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
