"""Substring dedup by hashing lines and runs of content-defined parts.

A text is cut twice: into its lines, and, whatever its line breaks, into parts that
end where the hash of two neighbouring words is the lowest of CUT_WINDOW in a row,
hence at the same words wherever a passage stands and after at most CUT_WINDOW words.
What is compared are passages: whole lines of MIN_LINE words and runs of neighbouring
lines or parts that reach MIN_RUN words. So of equal stretches of 39 words, however
they are wrapped, one passage is always found. Their digests
are grouped globally; the occurrence with the lowest (document, place) stays, and
the others are removed. So whatever is removed stands together, word by word, in an
earlier place. Removed ranges keep their offsets in the original text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import LOWER, SMALL_SLICE, _power, mix, slices, span_hashes, text_bytes, word_spans
from millrace.session import stage

MIN_LINE = 8
MIN_RUN = 16
#: Of so many word pairs in a row at least one ends a part.
CUT_WINDOW = 8


def passages(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Units and passages of every row; words are compared after lower-casing A-Z, white space does not count.

    ``start`` and ``end``: bytes of every word; ``word``: each row's first word; ``unit``: first word of every unit.
    Passages are lines of MIN_LINE words and runs of neighbouring units that just reach MIN_RUN words: ``digest``
    of their words in order, first word ``at`` and word ``to`` behind the last, ``first`` passage of each row.
    """
    starts, ends = word_spans(data, bounds)
    rows = np.searchsorted(starts, bounds)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return {"start": none, "end": none, "word": rows, "unit": none,
                "digest": none.view(np.uint64), "at": none, "to": none, "first": np.zeros(len(bounds), np.int64)}
    words = span_hashes(LOWER[data], starts, ends)
    row = np.searchsorted(bounds, starts, side="right") - 1
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, starts)
    new_line = np.ones(len(starts), bool)
    new_line[1:] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
    line_at = np.flatnonzero(new_line)
    line_to = np.append(line_at[1:], len(starts))
    line_words = line_to - line_at
    new_part = np.zeros(len(starts), bool)
    new_part[rows[:-1][rows[:-1] < rows[1:]]] = True
    new_part[1:] |= part_ends(words, row)
    part_at = np.flatnonzero(new_part)
    unit_at = np.flatnonzero(new_part | new_line)
    whole = line_words >= MIN_LINE
    found = [
        runs(part_at, part_at[:0], rows, row), runs(line_at, line_to, rows, row), np.stack([line_at[whole], line_to[whole]], 1),
    ]
    at, to = np.unique(np.concatenate(found), axis=0).T
    up, down = _power(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[:-1], out=sums[1:])
    return {
        "start": starts, "end": ends, "word": rows, "unit": unit_at,
        "digest": mix((sums[to] - sums[at]) * down[at] + (to - at).astype(np.uint64)), "at": at, "to": to,
        "first": np.searchsorted(at, rows),
    }


def part_ends(words: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether a part ends between each word and the next: at the lowest pair of any CUT_WINDOW in a row of a text.

    Of equal pairs the last counts, so that texts of few distinct pairs are cut as well.
    """
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])
    out = np.zeros(len(pairs), bool)
    n = len(pairs) - CUT_WINDOW + 1
    if n < 1:
        return out
    lowest, place = pairs[:n].copy(), np.arange(n)
    for k in range(1, CUT_WINDOW):
        better = pairs[k : k + n] <= lowest
        lowest[better] = pairs[k : k + n][better]
        place[better] = np.flatnonzero(better) + k
    out[place[row[:n] == row[CUT_WINDOW : CUT_WINDOW + n]]] = True
    return out


def runs(unit_at: np.ndarray, last: np.ndarray, rows: np.ndarray, row: np.ndarray) -> np.ndarray:
    """(first word, word behind) of the shortest runs of units of one row with MIN_RUN words.

    One starts at every unit, and one ends at every end in ``last``, so that a
    repeated stretch is covered up to the end of its last line.
    """
    unit_to = np.append(unit_at[1:], rows[-1])
    i = np.searchsorted(unit_to, unit_at + MIN_RUN)
    to = np.append(unit_to, rows[-1] + 1)[i]
    forward = to <= rows[row[unit_at] + 1]
    i = np.searchsorted(unit_at, last - MIN_RUN, side="right") - 1
    at = unit_at[np.maximum(i, 0)]
    backward = (i >= 0) & (at >= rows[row[last - 1]])
    return np.concatenate([np.stack([unit_at[forward], to[forward]], 1), np.stack([at[backward], last[backward]], 1)])


def removed_ranges(found: dict[str, np.ndarray], row: int, repeated: np.ndarray, size: int) -> tuple[list[tuple[int, int]], int, int]:
    """Byte ranges of the text of a row to remove, from the flags of its passages, its units and those removed.

    A range takes the white space after it along, so that no empty line is left.
    """
    a, b = found["word"][row : row + 2]
    mine = slice(found["first"][row], found["first"][row + 1])
    edges = np.zeros(b - a + 1, np.int64)
    np.add.at(edges, found["at"][mine][repeated] - a, 1)
    np.add.at(edges, found["to"][mine][repeated] - a, -1)
    gone = np.concatenate([[False], np.cumsum(edges)[:-1] > 0, [False]])
    turns = np.flatnonzero(gone[1:] != gone[:-1])
    starts = np.append(found["start"][a:b], size)
    own_units = found["unit"][np.searchsorted(found["unit"], a) : np.searchsorted(found["unit"], b)]
    return [(int(starts[s]), int(starts[e])) for s, e in turns.reshape(-1, 2)], len(own_units), int(gone[own_units - a + 1].sum())


def first_in_text(found: dict[str, np.ndarray], row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of the passages of a row, whether each is the first of its digest there, and whether it repeats
    that first one: a passage that overlaps the first is part of it."""
    mine = slice(found["first"][row], found["first"][row + 1])
    digests = found["digest"][mine]
    _, at, which = np.unique(digests, return_index=True, return_inverse=True)
    new = np.zeros(len(digests), bool)
    new[at] = True
    return digests, new, found["at"][mine] >= found["to"][mine][at[which]]


def substring_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, text (without repeats), removed (ranges), n_units, n_removed.

    ``removed`` lists start and length in characters of the original text, in order.
    Occurrences are ranked by doc_id, null ids last, then by place. Rows with equal
    ids are of equal rank: they do not remove units from each other, so repeated rows
    stay alike. Null texts stay null and empty ones empty, without units. Offsets refer
    to the original text; an empty table gives no rows.
    """
    cleaned = _cleaned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(0).alias("rest")))
    return cleaned.drop("rest")


def without_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The table with cleaned texts, all other columns unchanged; see ``substring_dedup``."""
    others = [c for c in docs.columns if c not in (text_col, id_col)]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)
    cleaned = _cleaned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), rest.alias("rest")))
    source = {text_col: "text", id_col: "doc_id"}
    return cleaned.select(*[F.col(source.get(c, f"rest.`{c}`")).alias(c) for c in docs.columns])


def _cleaned(rows: DataFrame) -> DataFrame:
    """doc_id, text, rest (unchanged), removed, n_units, n_removed of (doc_id, text, rest)."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    rest_type = rows.schema["rest"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text", SMALL_SLICE):
                found = passages(*text_bytes(part.column("text")))
                digests = [d[new] for d, new, _ in (first_in_text(found, i) for i in range(len(part)))]
                owner = np.repeat(np.arange(len(part)), [len(d) for d in digests])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(digests).view(np.int64)), part.column("doc_id").take(pa.array(owner))],
                    names=["digest", "doc_id"],
                )

    listed = stage(rows.select("doc_id", "text").mapInArrow(cut, f"digest long, doc_id {id_type}"), "passages")
    firsts = listed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    shared = stage(firsts.where("n > 1").select("digest", "first_id"), "repeated-passages")
    repeats = listed.join(shared, "digest").where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    flags = repeats.groupBy("doc_id").agg(F.collect_set("digest").alias("repeats")).withColumnRenamed("doc_id", "_flag_id")
    marked = rows.join(flags, F.col("doc_id").eqNullSafe(F.col("_flag_id")), "left").select("doc_id", "text", "rest", "repeats")

    def clean(batches):
        for batch in batches:
            for part in slices(batch, "text", SMALL_SLICE):
                data, bounds = text_bytes(part.column("text"))
                found = passages(data, bounds)
                texts = part.column("text").to_pylist()
                out, ranges, n_units, removed = [], [], [], []
                for i, repeats in enumerate(part.column("repeats")):
                    digests, _, flags = first_in_text(found, i)
                    if repeats.is_valid:
                        flags |= np.isin(digests, repeats.values.to_numpy().view(np.uint64))
                    raw = data[bounds[i] : bounds[i + 1]]
                    cut_out, units, gone = removed_ranges(found, i, flags, int(bounds[i + 1]))
                    cut_out = [(s - int(bounds[i]), e - int(bounds[i])) for s, e in cut_out]
                    n_units.append(units)
                    removed.append(gone)
                    if not cut_out:
                        out.append(texts[i])
                        ranges.append([])
                        continue
                    whole, kept, at = raw.tobytes(), [], 0
                    spans, chars, read = [], 0, 0
                    for s, e in cut_out:
                        kept.append(whole[at:s])
                        chars += len(whole[read:s].decode("utf-8", "replace"))
                        length = len(whole[s:e].decode("utf-8", "replace"))
                        spans.append({"start": chars, "length": length})
                        chars, read, at = chars + length, e, e
                    kept.append(whole[at:])
                    out.append(b"".join(kept).decode("utf-8", "replace"))
                    ranges.append(spans)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(out, pa.string()), part.column("rest"),
                        pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                        pa.array(n_units, pa.int64()), pa.array(removed, pa.int64()),
                    ],
                    names=["doc_id", "text", "rest", "removed", "n_units", "n_removed"],
                )

    return marked.mapInArrow(
        clean,
        f"doc_id {id_type}, text string, rest {rest_type}, removed array<struct<start:bigint,length:bigint>>, "
        "n_units long, n_removed long",
    )
