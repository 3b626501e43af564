"""Column builders shared by the operators."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the number texts a lenient float field accepts.
NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def quoted(name: str) -> str:
    """A column name as an SQL identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def missing(df: DataFrame, name: str) -> Column:
    """True for null and, in floating columns, NaN."""
    c = quoted(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.expr(f"{c} is null or isnan({c})")
    return F.expr(f"{c} is null")


def complete(df: DataFrame, names: list[str]) -> Column:
    """True where none of the columns is missing."""
    return reduce(lambda a, b: a & b, [~missing(df, n) for n in names], F.lit(True))


def month_key(df: DataFrame, name: str) -> Column:
    """``yyyy-MM`` of a date, timestamp or ISO date text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.substring(F.col(name), 1, 7)
    return F.date_format(F.col(name), "yyyy-MM")


def month_start(df: DataFrame, name: str) -> Column:
    """What to group by for months: the first day of the month, which costs no text
    formatting per row. Date text is cut to its month instead."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return month_key(df, name)
    return F.trunc(F.col(name), "MM")


DECIMALS = 6  # decimals up to which sums are exact unless told otherwise
PART_BITS = 21  # three parts of 21, 21 and 22 bits: their sums stay bigints for 2e12 rows per group


def present(c: Column) -> Column:
    """The number, or null where it is NaN."""
    return F.nanvl(c, F.lit(None).cast("double"))


def fixed_parts(c: Column, scale: int) -> list[Column]:
    """A number as fixed-point units of ``scale`` decimals, split in three integers, lowest
    first. Sums of the parts are exact in any order, cannot overflow, and stay in primitive buffers,
    which makes them several times faster than decimal sums. See ``fits`` for numbers that
    the units cannot hold."""
    units = F.rint(present(c) * F.lit(10.0**scale)).try_cast("bigint")
    part = F.lit((1 << PART_BITS) - 1).cast("bigint")
    return [units.bitwiseAND(part), F.shiftright(units, PART_BITS).bitwiseAND(part), F.shiftright(units, 2 * PART_BITS)]


def fits(c: Column, scale: int) -> Column:
    """True where a number of ``scale`` decimals is held in units without loss."""
    units = F.rint(present(c) * F.lit(10.0**scale)).try_cast("bigint")
    return F.coalesce(units.cast("double") / F.lit(10.0**scale) == c, present(c).isNull())


def fixed_total(sums: list[Column], scale: int) -> Column:
    """The double nearest to the exact total of summed parts."""
    weighted = [s.cast("decimal(20,0)") * F.lit(Decimal(1 << (PART_BITS * i))) for i, s in enumerate(sums)]
    units = reduce(lambda a, b: a + b, [w.cast("decimal(38,0)") for w in weighted])
    return (units * F.lit(Decimal(1).scaleb(-scale))).cast("double")


def total(c: Column, scale: int | None = DECIMALS) -> Column:
    """Sum of the present values as double.

    With a ``scale``, a group whose values all fit in units of so many decimals is summed
    exactly, and the sum does not depend on the order in which partitions are merged. A
    group with other values (more decimals, very large, infinite) gets the plain sum:
    nothing is rounded or refused.
    """
    if scale is None:
        return F.sum(present(c))
    exact = F.coalesce(F.bool_and(fits(c, scale)), F.lit(True))
    sums = [F.sum(p) for p in fixed_parts(c, scale)]
    return F.when(exact, fixed_total(sums, scale)).otherwise(F.sum(present(c)))


def mean(c: Column, scale: int | None = DECIMALS) -> Column:
    """Mean of the present values, from the same exact sum."""
    return F.try_divide(total(c, scale), F.count(present(c)).cast("double"))


def percent(part: Column, whole: Column, digits: int = 3) -> Column:
    """``part`` in percent of ``whole``; null when ``whole`` is zero."""
    return F.round(F.try_divide(part * 100.0, whole.cast("double")), digits)


def lenient_double(text: Column) -> Column:
    """Number from text with surrounding blanks; null where the text is no number.

    The pattern comes first because a cast alone also takes suffixes such as ``1d``.
    """
    return F.when(
        text.rlike(NUMBER_TEXT), F.trim(F.regexp_replace(text, "_", "")).try_cast("double")
    )


def beyond_tolerance(a: Column, b: Column, tolerance: float) -> Column:
    """True where ``a`` and ``b`` differ by more than ``tolerance``."""
    return F.abs(a - b) > F.lit(tolerance)
