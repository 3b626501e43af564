"""Periodic runs of words by a dictionary of basic factors.

Every factor of 1, 2, 4, ... words gets a name, that of length 2L being the pair of names
of its halves. If a factor of length L is met again d <= L words later, so that both
occurrences lie within 2L words, the words from the first to the end of the second have
period d. Neighbouring positions whose next occurrence is equally far form one stretch; it
is extended as far as the period goes and proposed with period d.

A run of period q and at least 4q words is always found, at the level with L/2 < q <= L:
all its positions but the last q + L repeat q words on, and none earlier, because the
rotations of a word that is no power differ. For the same reason no proposal of four
periods or more has a smaller period.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import slices
from millrace.llm.words import Words, words_of

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _order(keys: np.ndarray) -> np.ndarray:
    """Positions by key, then position."""
    n = len(keys)
    if n and int(keys.max()) * n < 1 << 62:  # sorting numbers is several times faster than sorting by them
        return np.sort(keys * n + np.arange(n)) % n
    return np.argsort(keys, kind="stable")


def _factors(at: np.ndarray, keys: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Names of the factors at ``at`` (rising positions) with equal keys, and what they propose.

    Returns the positions of factors that are met more than once, their names, and first
    word, end and period of every stretch.
    """
    order = _order(keys)
    sorted_keys = keys[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    group = np.concatenate(([0], np.cumsum(~same)))
    names = np.empty(len(at), np.int64)
    names[order] = group
    repeated = np.zeros(len(at), bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    here, there = at[order[:-1][same]], at[order[1:][same]]
    close = there - here <= length
    first, gap = here[close], (there - here)[close]
    order = _order(first)
    first, gap = first[order], gap[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1] + 1) | (gap[1:] != gap[:-1])
    begins = np.flatnonzero(new)
    last = np.append(begins[1:], len(first)) - 1 if len(begins) else begins
    return at[repeated], names[repeated], first[begins], first[last] + length + gap[begins], gap[begins]


def _extended(codes: np.ndarray, low: np.ndarray, high: np.ndarray, start, end, period) -> tuple[np.ndarray, np.ndarray]:
    """Each stretch as far as its period goes between ``low`` and ``high``, its row's bounds."""
    start, end = start.copy(), end.copy()
    open_ = np.arange(len(start))
    while len(open_):
        s = start[open_]
        open_ = open_[s > low[open_]]
        s = start[open_] - 1
        open_ = open_[codes[s] == codes[s + period[open_]]]
        start[open_] -= 1
    open_ = np.arange(len(start))
    while len(open_):
        open_ = open_[end[open_] < high[open_]]
        e = end[open_]
        open_ = open_[codes[e] == codes[e - period[open_]]]
        end[open_] += 1
    return start, end


def runs_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start (word of the batch), length and period of all runs, by row, start and period."""
    codes, rows = words.codes, words.rows
    sizes = np.diff(rows)
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    ends = rows[1:][row_of]
    room = sizes[row_of]
    at = np.flatnonzero(room >= LEAST_WORDS)
    keys = row_of[at].astype(np.int64) * (len(words.distinct) + 1) + codes[at]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    length = 1
    while len(at):
        at, names, start, end, period = _factors(at, keys, length)
        row = row_of[start]
        start, end = _extended(codes, rows[row], rows[row + 1], start, end, period)
        long_enough = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append((start[long_enough], end[long_enough], period[long_enough]))
        # the next level has factors of 2 * length, whose periods are above length
        place = np.full(len(codes), -1, np.int64)
        place[at] = names
        inside = (at + 2 * length <= ends[at]) & (room[at] >= LEAST_PERIODS * (length + 1))
        at, first = at[inside], names[inside]
        second = place[at + length]
        both = second >= 0
        at, keys = at[both], first[both] * (int(place.max(initial=0)) + 1) + second[both]
        length *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, end, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    once = np.ones(len(start), bool)  # several levels find the runs of small periods
    once[1:] = (start[1:] != start[:-1]) | (period[1:] != period[:-1])
    start, end, period = start[once], end[once], period[once]
    return row_of[start], start, end - start, period


def repeated_words(words: Words, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Marks the words that some run contains after its first period."""
    steps = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:-1]) > 0


def periodic_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (array of start, length, period), collapsed text.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of consecutive
    words with smallest period q and at least max(6, 4q) words that neither neighbour
    extends; runs are ordered by start, then period. ``collapsed`` has the words that no run
    contains after its first period, joined by one space.

    A null or empty text, or one of white space, has no words, no runs and an empty
    ``collapsed``. Ids are only carried along: null and repeated ids, and repeated rows, give
    one row each. There are no ties. An empty table gives no rows; other columns, whatever
    their names, are not read. A very long text is worked on whole, in one task, with some
    60 bytes of memory a word; texts share nothing, so nothing is shuffled.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                row, start, length, period = runs_of(words)
                collapsed = words.joined(~repeated_words(words, start, length, period))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(x, pa.int64()) for x in (start - words.rows[row], length, period)], fields=list(RUN)
                    ),
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(words.rows), pa.int64()), lists, collapsed.cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = wanted.schema["doc_id"].dataType.simpleString()
    return wanted.mapInArrow(
        run, f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )


def run_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent, and digests, from the rows of ``periodic_runs``.

    The greatest length / period is found by exact products; of equal ones the smallest
    start, then the smallest period, comes first, which is the order the runs have.
    """
    better = lambda x, best: x["length"] * best["period"] > best["length"] * x["period"]
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda best, x: F.when(better(x, best), x).otherwise(best),
    )
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    picked = found.select("*", best.alias("_best"))
    return picked.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
