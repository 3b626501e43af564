"""Byte-level BPE as a lazily determinised transducer, and its streaming decoder.

A sequence of tokens is the BPE encoding of its bytes exactly if each token
encodes to itself and each neighbouring pair is the encoding of its own bytes.
So encoding is a walk of a non-deterministic machine over bytes: a hypothesis
says which token ended at some position and which bytes, the beginning of a
token, have been read since. Every prefix of the input has one encoding, so one
hypothesis ends at each position, and only those whose open bytes still begin a
token stay alive. A deterministic state is the list of live hypotheses; states and
moves are made when first met and kept. Each move puts out the token that ends
there if the text is cut there. What lies before the oldest live hypothesis can no
longer change and is emitted, so output lags by no more than the longest token.
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import byte_rows, slices

#: Moves, and checked pairs of tokens, kept before the machine starts anew: some 70 MB each.
MAX_MOVES = MAX_PAIRS = 350_000
#: Bytes of one generation of remembered pieces in a worker, and of an entry besides its text; two are kept.
PIECE_BYTES, ENTRY_BYTES = 72 << 20, 250
#: Positions after which settled tokens are emitted.
FLUSH = 4096
NEVER = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank of every token in a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """Encodes byte pieces; ``encode`` returns the ids of one piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self._ranks = ranks
        self._tokens = {rank: token for token, rank in ranks.items()}
        self._length = {rank: len(token) for token, rank in ranks.items()}
        self._halves: dict[int, tuple[bytes, bytes] | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        # the tokens as a tree: node -> {byte: node}, and the token that a node spells
        self._next: list[dict[int, int]] = [{}]
        self._spells: list[int] = [-1]
        self._depth: list[int] = [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                step = self._next[node].get(byte)
                if step is None:
                    step = self._next[node][byte] = len(self._next)
                    self._next.append({})
                    self._spells.append(-1)
                    self._depth.append(self._depth[node] + 1)
                node = step
            if len(token) == 1 or self._split(rank) is not None:
                self._spells[node] = rank
        self._forget()

    def _forget(self) -> None:
        # a state: (node, token before it) of every live hypothesis, the oldest first; -1 at the start of the text
        self._states: list[tuple[tuple[int, int], ...]] = [((0, -1),)]
        self._numbers = {self._states[0]: 0}
        self._moves: dict[int, tuple[int, int]] = {}

    def _merged(self, data: bytes, limit: int) -> list[bytes]:
        """Parts of a few bytes after all merges below a rank: always the leftmost pair of the lowest rank."""
        parts = [data[i : i + 1] for i in range(len(data))]
        get = self._ranks.get
        while len(parts) > 1:
            ranks = [get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            lowest = min(ranks)
            if lowest >= limit:
                break
            i = ranks.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _split(self, rank: int) -> tuple[bytes, bytes] | None:
        """The two parts whose merge makes a token; None if no merge reaches it."""
        if rank not in self._halves:
            parts = self._merged(self._tokens[rank], rank)
            self._halves[rank] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[rank]

    def _follows(self, left: int, right: int) -> bool:
        """No merge across the border of two tokens comes before a merge inside them.

        Time runs backwards from the finished tokens: whichever was made last is
        taken apart, and the parts that touch must not have a merge that was due
        earlier. Of equal merges the leftmost comes first.
        """
        ranks = self._ranks
        a, b = self._tokens[left], self._tokens[right]
        due = NEVER
        while True:
            if ranks.get(a + b, NEVER) < due:
                return False
            rank_a = ranks[a] if len(a) > 1 else -1
            rank_b = ranks[b] if len(b) > 1 else -1
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                due, a = rank_a, self._split(rank_a)[1]
            elif rank_a < rank_b:
                due, b = rank_b + 1, self._split(rank_b)[0]
            else:  # the same token twice: the right one was made last
                due, b = rank_b + 1, self._split(rank_b)[0]

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """The next state, and the token that ends here."""
        alive, closed = [], -1
        pairs, steps, spells = self._pairs, self._next, self._spells
        for node, before in self._states[state]:
            step = steps[node].get(byte)
            if step is None:
                continue
            token = spells[step]
            if token >= 0 and closed < 0:
                if before < 0:
                    closed = token
                else:
                    fits = pairs.get((before, token))
                    if fits is None:
                        fits = pairs[before, token] = self._follows(before, token)
                    if fits:
                        closed = token
            if steps[step]:
                alive.append((step, before))
        alive.append((0, closed))
        target = tuple(alive)
        number = self._numbers.get(target)
        if number is None:
            number = self._numbers[target] = len(self._states)
            self._states.append(target)
        self._moves[state << 8 | byte] = number, closed
        return number, closed

    def _chain(self, closed: list[int], end: int) -> list[int]:
        """The tokens that end at a position, from the token ending at each."""
        out = []
        while end:
            token = closed[end - 1]
            out.append(token)
            end -= self._length[token]
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece; a piece that is itself a token is that token."""
        whole = self._ranks.get(piece)
        if whole is not None:
            return [whole]
        state, ids, closed = 0, [], []
        moves = self._moves
        for byte in piece:
            step = moves.get(state << 8 | byte)
            if step is None:
                if len(moves) >= MAX_MOVES or len(self._pairs) >= MAX_PAIRS:
                    here = self._states[state]
                    self._forget()
                    self._pairs.clear()
                    moves = self._moves
                    state = self._numbers.setdefault(here, len(self._states))
                    if state == len(self._states):
                        self._states.append(here)
                step = self._move(state, byte)
            state, token = step
            closed.append(token)
            if len(closed) >= FLUSH and not len(closed) % 256:
                settled = self._settled(state, closed)
                ids += self._chain(closed, settled)
                del closed[:settled]
        return ids + self._chain(closed, len(closed))

    def _settled(self, state: int, closed: list[int]) -> int:
        """The last border of tokens that all live hypotheses share."""
        shared: set[int] | None = None
        for node, _ in self._states[state]:
            end = len(closed) - self._depth[node]
            borders = {end}
            while end:
                end -= self._length[closed[end - 1]]
                borders.add(end)
            shared = borders if shared is None else shared & borders
        return max(shared)


class PieceTokens:
    """Packed ids of pieces; the pieces met lately are remembered within a bound."""

    def __init__(self, transducer: Transducer):
        self._transducer = transducer
        self.forget()

    def forget(self) -> None:
        """Empty the memory: a worker outlives its task."""
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._held = 0

    def pack(self, pieces: list[str]) -> bytes:
        new = self._new
        try:
            return b"".join(map(new.__getitem__, pieces))
        except KeyError:
            pass
        for piece in pieces:
            if piece not in new:
                packed = self._old.get(piece)
                if packed is None:
                    ids = self._transducer.encode(piece.encode())
                    packed = struct.pack(f"<{len(ids)}I", *ids)
                new[piece] = packed
                self._held += 4 * len(piece) + len(packed) + ENTRY_BYTES
        out = b"".join(map(new.__getitem__, pieces))
        if self._held >= PIECE_BYTES:
            self._old, self._new, self._held = new, {}, 0
        return out


class Utf8Machine:
    """Incremental UTF-8: feed bytes in any cuts, get the text that is complete.

    The state is the open sequence: its bytes, how many are missing, and the range
    the next one must lie in. Ill-formed parts become U+FFFD, one for each maximal
    part that could have begun a character.
    """

    def __init__(self):
        self._open = b""
        self._missing = 0
        self._range = (0x80, 0xBF)

    @staticmethod
    def _begin(byte: int) -> tuple[int, tuple[int, int]]:
        if 0xC2 <= byte <= 0xDF:
            return 1, (0x80, 0xBF)
        if 0xE0 <= byte <= 0xEF:
            return 2, (0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF)
        if 0xF0 <= byte <= 0xF4:
            return 3, (0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF)
        return 0, (0, 0)

    def feed(self, data: bytes) -> str:
        out = []
        i = 0
        while i < len(data):
            if not self._missing:
                # whole characters go through at once; only the last three bytes can be an open one
                end = len(data)
                for back in range(1, min(4, end - i + 1)):
                    need = self._begin(data[end - back])[0]
                    if need:
                        if need >= back:
                            end -= back
                        break
                    if data[end - back] < 0x80:
                        break
                try:
                    out.append(data[i:end].decode("utf-8"))
                    i = end
                except UnicodeDecodeError as e:
                    out.append(data[i : i + e.start].decode("utf-8"))
                    i += e.start
                if i == len(data):
                    break
                self._missing, self._range = self._begin(data[i])
                if self._missing:
                    self._open = data[i : i + 1]
                else:
                    out.append("�" if data[i] >= 0x80 else chr(data[i]))
                i += 1
            elif self._range[0] <= data[i] <= self._range[1]:
                self._open += data[i : i + 1]
                self._missing -= 1
                self._range = (0x80, 0xBF)
                i += 1
                if not self._missing:
                    out.append(self._open.decode("utf-8"))
                    self._open = b""
            else:
                out.append("�")
                self._open, self._missing = b"", 0
        return "".join(out)

    def close(self) -> str:
        """End of input: an open sequence is ill-formed."""
        left = "�" if self._missing else ""
        self._open, self._missing = b"", 0
        return left


class ByteBpe:
    """Encoder and decoder of one rank file and one splitting pattern."""

    def __init__(self, path: str, pattern: str):
        ranks = load_ranks(path)
        self._pattern = regex.compile(pattern)
        self._pieces = PieceTokens(Transducer(ranks))
        self._bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self._pieces.pack(self._pattern.findall(text))

    def forget(self) -> None:
        self._pieces.forget()

    def decode_bytes(self, packed: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(packed, "<u4").tolist()))

    def decode(self, packed: bytes, chunk_ids: int = 1 << 14) -> str:
        """The text of packed ids, decoded as a stream of chunks."""
        step = 4 * chunk_ids
        return "".join(self.decode_stream(packed[i : i + step] for i in range(0, len(packed), step)))

    def decode_stream(self, chunks):
        """Text pieces of packed ids that arrive in chunks; characters are never cut."""
        machine = Utf8Machine()
        for chunk in chunks:
            yield machine.feed(self.decode_bytes(chunk))
        yield machine.close()


_open: dict[tuple[str, str], ByteBpe] = {}


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The encoder of a path and pattern, made once per Python worker."""
    if (path, pattern) not in _open:
        _open[path, pattern] = ByteBpe(path, pattern)
    return _open[path, pattern]


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every row.

    Null and empty texts have no ids; repeated rows stay repeated; a null id is
    kept; bytes that are not UTF-8 count as U+FFFD; other columns are not read.
    """
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = wanted.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        codec = byte_bpe(ranks_path, pattern)
        for batch in batches:
            for rows in slices(batch, "text"):
                ids = [codec.encode(t.decode("utf-8", "replace")) for t in byte_rows(rows.column("text"))]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])
        codec.forget()

    return wanted.mapInArrow(encode, f"doc_id {id_type}, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, chunk_ids: int = 1 << 14) -> DataFrame:
    """doc_id, ids and the text that the ids stand for, decoded as a stream of chunks.

    Null ids decode to the empty text; ids outside the vocabulary raise an error.
    """
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def decode(batches):
        codec = byte_bpe(ranks_path, pattern)
        for batch in batches:
            for rows in slices(batch, "ids", 1 << 22):
                texts = [codec.decode(ids, chunk_ids) for ids in byte_rows(rows.column("ids"))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {id_type}, ids binary, text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encode every text and decode it again: doc_id, n_tokens and digests of ids and of the decoded bytes."""
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = wanted.schema["doc_id"].dataType.simpleString()

    def run(batches):
        # both ways in one worker: one rank table and one machine
        codec = byte_bpe(ranks_path, pattern)
        for batch in batches:
            for rows in slices(batch, "text"):
                ids = [codec.encode(t.decode("utf-8", "replace")) for t in byte_rows(rows.column("text"))]
                columns = [rows.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"])
        codec.forget()

    decoded = wanted.mapInArrow(run, f"doc_id {id_type}, ids binary, text string")
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )
