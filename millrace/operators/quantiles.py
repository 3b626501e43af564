"""Exact order statistics and quantiles by radix selection.

Numbers become 64-bit keys in the same order. One pass counts the rows of each leading 16
bits; the cell that holds the wanted rank is known from the counts, and the next pass counts
the following bits of that cell's rows alone. A cell that has only one value left is done,
so at most four passes settle every rank, whatever the values and however often they repeat.

Counts are combined before the shuffle: a value or a group with a third of the rows is one
count per task. No task ever sorts more than 65,536 cells for a rank.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.functions.columns import missing
from millrace.session import stage

DIGIT = 16  # bits that one pass counts
CELLS = 1 << DIGIT  # cells that one task may sort for one rank

RankOf = Callable[[Column, int], Column]


def with_order_key(df: DataFrame, number: str, key: str) -> DataFrame:
    """Add a bigint that is ordered like the numbers and different for different ones.

    For whole numbers it is the number; for doubles the exponent and the fraction of the
    absolute value as one integer, with the sign of the number. Not defined for NaN.
    """
    if isinstance(df.schema[number].dataType, T.IntegralType):
        return df.withColumn(key, F.col(number).cast("bigint"))
    size, power, fraction, bits = (f"_{key}_{s}" for s in ("size", "power", "fraction", "bits"))
    df = df.withColumn(size, F.abs(F.col(number).cast("double")))
    # the logarithm may be off by a rounding at powers of two; the fraction then leaves [1, 2)
    df = df.withColumn(power, F.least(F.floor(F.log2(size)), F.lit(1023)).cast("int"))
    df = df.withColumn(fraction, F.col(size) / F.pow(F.lit(2.0), F.col(power)))
    small, large = F.col(fraction) < 1, F.col(fraction) >= 2
    exponent = F.when(small, F.col(power) - 1).when(large, F.col(power) + 1).otherwise(F.col(power))
    proper = F.when(small, F.col(fraction) * 2).when(large, F.col(fraction) / 2).otherwise(F.col(fraction))
    normal = (exponent + 1023).cast("bigint") * F.lit(1 << 52) + ((proper - 1) * F.lit(2.0**52)).cast("bigint")
    below_normal = (F.col(size) * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")
    magnitude = (
        F.when(F.col(size) == 0, F.lit(0).cast("bigint"))
        .when(F.col(size) < F.lit(2.0**-1022), below_normal)
        .when(F.col(size) == F.lit(float("inf")), F.lit(2047 << 52))
        .otherwise(normal)
    )
    df = df.withColumn(bits, magnitude)
    df = df.withColumn(key, F.when(F.col(number) < 0, -F.col(bits)).otherwise(F.col(bits)))
    return df.drop(size, power, fraction, bits)


def order_key(number: int | float) -> int:
    """The same key of one number on the driver."""
    if isinstance(number, int):
        return number
    bits = struct.unpack("<q", struct.pack("<d", abs(number)))[0]
    return -bits if number < 0 else bits


def _counted(rows: DataFrame, by: Sequence[str], digit: Column) -> DataFrame:
    """Cells (by, _d) with their rows, smallest and greatest value."""
    return rows.groupBy(*by, digit.alias("_d")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )


def _skipped(rows: int, low: int, high: int) -> int:
    """Low bits that the next pass leaves out: none in a cell of few rows, which is counted value by value."""
    return 0 if rows <= CELLS else max(0, (high - low).bit_length() - DIGIT)


def _values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``by`` and the present values as ``_v``: whole numbers as they are, others as doubles."""
    v = F.col(value)
    if not isinstance(df.schema[value].dataType, T.IntegralType):
        v = v.cast("double")
    return df.where(~missing(df, value)).select(*by, v.alias("_v"))


_LEADING = 64 - DIGIT


@dataclass
class _Target:
    """A rank within a cell of rows that have values from ``low`` to ``high``."""

    rank: int
    below: int
    rows: int
    low: int | float
    high: int | float


def _settle(cells: dict[str, np.ndarray], chosen: np.ndarray, target: _Target) -> None:
    """Narrow a target down to the one of the ``chosen`` cells, ordered by digit, that holds its rank."""
    ends = np.cumsum(cells["_c"][chosen])
    i = int(np.searchsorted(ends, target.rank, side="right"))
    at, start = chosen[i], int(ends[i - 1]) if i else 0
    target.rank, target.below, target.rows = target.rank - start, target.below + start, int(cells["_c"][at])
    target.low, target.high = cells["_lo"][at].item(), cells["_hi"][at].item()


def _arrays(cells: DataFrame, order: list[str]) -> dict[str, np.ndarray]:
    """A bounded number of cells on the driver, sorted."""
    table = cells.toArrow().sort_by([(c, "ascending") for c in order])
    return {c: table.column(c).to_numpy() for c in table.column_names}


def _select(data: DataFrame, ranks_of: Callable[[int], list[int]]) -> tuple[int, list[_Target]]:
    """Number of values, and the targets of the ranks wanted, each narrowed to one value.

    At most 65,536 cells per target come to the driver in a pass. The bounds of cells go
    back as literals, which reach the file scan.
    """
    kind = data.schema["_v"].dataType
    cells = _arrays(_counted(with_order_key(data, "_v", "_k"), [], F.shiftright("_k", _LEADING)), ["_d"])
    n = int(cells["_c"].sum())
    targets = [_Target(r, 0, 0, 0, 0) for r in ranks_of(n)]
    for target in targets if n else ():
        _settle(cells, np.arange(len(cells["_c"])), target)
    while n:
        opened = {t.low: t for t in targets if t.low < t.high}
        if not opened:
            break
        low = {k: F.lit(t.low).cast(kind) for k, t in opened.items()}
        within = {k: F.col("_v").between(low[k], F.lit(t.high).cast(kind)) for k, t in opened.items()}
        first = {k: order_key(t.low) for k, t in opened.items()}
        digit = {
            k: F.shiftrightunsigned(F.col("_k") - F.lit(first[k]).cast("bigint"), _skipped(t.rows, first[k], order_key(t.high)))
            for k, t in opened.items()
        }
        # a row lies in one cell at most
        pick = lambda of: F.coalesce(*[F.when(within[k], of[k]) for k in opened])
        rows = with_order_key(data.where(reduce(lambda a, b: a | b, within.values())), "_v", "_k")
        cells = _arrays(_counted(rows.withColumn("_from", pick(low)), ["_from"], pick(digit)), ["_from", "_d"])
        for target in targets:
            if target.low < target.high:
                _settle(cells, np.flatnonzero(cells["_from"] == target.low), target)
    return n, targets


def _ended(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cells with the rows up to their end in the order of their digits."""
    upto = Window.partitionBy(*by).orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumn("_end", F.sum("_c").over(upto))


def _settled(cells: DataFrame, by: Sequence[str], below: Column) -> DataFrame:
    """The cell of each target: its rank in the cell, the rows below the cell, and how its next digit is taken."""
    start = F.col("_end") - F.col("_c")
    found = cells.where((F.col("_rank") >= start) & (F.col("_rank") < F.col("_end"))).select(
        *by, "_t", "_n", (F.col("_rank") - start).alias("_rank"), (below + start).alias("_below"), "_c", "_lo", "_hi"
    )
    found = with_order_key(with_order_key(found, "_lo", "_first"), "_hi", "_last")
    width = F.length(F.bin(F.col("_last") - F.col("_first")))
    skip = F.when(F.col("_c") <= CELLS, 0).otherwise(F.greatest(width - DIGIT, F.lit(0)))
    return found.withColumn("_skip", skip).drop("_last")


def _select_by(data: DataFrame, by: list[str], slots: int, rank_of: RankOf) -> DataFrame:
    """(by, _t, _n, _below, _c, _lo) of the two ranks of each slot in each group, narrowed to one value.

    All is done on executors: the targets of all groups are a staged table, joined back to the
    rows by group and range of values.
    """
    cells = _ended(_counted(with_order_key(data, "_v", "_k"), by, F.shiftright("_k", _LEADING)), by)
    cells = cells.withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
    ranks = [rank_of(F.col("_n"), i).cast("bigint") for i in range(slots)]
    wanted = [r for rank in ranks for r in (rank, F.least(rank + 1, F.col("_n") - 1))]
    targets = _settled(cells.select("*", F.posexplode(F.array(*wanted)).alias("_t", "_rank")), by, F.lit(0).cast("bigint"))
    done: list[DataFrame] = []
    renamed = [F.col(b).alias(f"_k_{b}") for b in by]
    while True:
        targets = stage(targets, "targets")
        done.append(targets.where("_lo = _hi"))
        held = targets.where("_lo < _hi")
        if held.isEmpty():
            return reduce(DataFrame.unionByName, done)
        open_cells = held.select(*renamed, F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), "_first", "_skip").distinct()
        on = reduce(lambda a, c: a & c, [data[b].eqNullSafe(open_cells[f"_k_{b}"]) for b in by])
        rows = data.join(open_cells, on & F.col("_v").between(F.col("_from"), F.col("_to"))).select(*by, "_v", "_from", "_first", "_skip")
        digit = F.call_function("shiftrightunsigned", F.col("_k") - F.col("_first"), F.col("_skip"))
        cells = _ended(_counted(with_order_key(rows, "_v", "_k"), [*by, "_from"], digit), [*by, "_from"])
        held = held.select(*renamed, "_t", "_n", "_rank", "_below", F.col("_lo").alias("_cell"))
        on = reduce(lambda a, c: a & c, [cells[b].eqNullSafe(held[f"_k_{b}"]) for b in by], cells["_from"] == held["_cell"])
        targets = _settled(cells.join(held, on), by, F.col("_below"))


def order_statistics(df: DataFrame, value: str, slots: int, rank_of: RankOf, by: Sequence[str]) -> DataFrame:
    """Values at given ranks, per group.

    ``rank_of(n, i)`` gives the 0-based rank of slot ``i`` among the ``n`` non-missing
    values. The result has the keys, ``n``, and for each slot the value ``at{i}``, the value
    one rank up ``next{i}`` (the same at the top end), and the numbers of rows ``below{i}`` and
    ``equal{i}`` to the value. Null keys form a group of their own; a group without values has no
    row. Without keys there is one row, of ``n`` 0 and nulls where there are no values.
    """
    by = list(by)
    group = _values(df, value, by)
    found = _select_by(group if by else group.withColumn("_all", F.lit(0)), by or ["_all"], slots, rank_of)
    pick = lambda t, c: F.max(F.when(F.col("_t") == t, F.col(c)))
    outs = []
    for i in range(slots):
        outs += [
            pick(2 * i, "_lo").alias(f"at{i}"), pick(2 * i + 1, "_lo").alias(f"next{i}"),
            pick(2 * i, "_below").alias(f"below{i}"), pick(2 * i, "_c").alias(f"equal{i}"),
        ]
    return found.groupBy(*by).agg(F.coalesce(F.max("_n"), F.lit(0).cast("bigint")).alias("n"), *outs)


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles, one column per name in ``probs``, and ``n``.

    Without groups there is one row, of ``n`` 0 and nulls where there are no values; its
    passes run at once, since their bounds are literals of the next one.
    """
    ps = list(probs.values())
    if not by:
        return _one_row(df, value, probs)
    stats = order_statistics(df, value, len(ps), lambda n, i: F.floor((n - 1) * F.lit(float(ps[i]))), by)
    cols = []
    for i, name in enumerate(probs):
        pos = (F.col("n") - 1) * F.lit(float(ps[i]))
        frac = pos - F.floor(pos)
        at, nxt = F.col(f"at{i}").cast("double"), F.col(f"next{i}").cast("double")
        # equal neighbours need no arithmetic, which infinite ones do not allow
        cols.append(F.when(at == nxt, at).otherwise(at * (1 - frac) + nxt * frac).alias(name))
    return stats.select(*by, "n", *cols)


def _one_row(df: DataFrame, value: str, probs: dict[str, float]) -> DataFrame:
    ps = list(probs.values())

    def ranks(n: int) -> list[int]:
        return [r for p in ps for r in (math.floor((n - 1) * p), min(math.floor((n - 1) * p) + 1, n - 1))]

    n, targets = _select(_values(df, value), ranks)
    cols = []
    for i, (name, p) in enumerate(probs.items()):
        at, after = (float(t.low) for t in targets[2 * i : 2 * i + 2])
        part = (n - 1) * p - math.floor((n - 1) * p)
        found = at if at == after else at * (1 - part) + after * part
        cols.append(F.lit(found if n else None).cast("double").alias(name))
    return df.sparkSession.range(0, 1, 1, 1).select(F.lit(n).cast("bigint").alias("n"), *cols)
