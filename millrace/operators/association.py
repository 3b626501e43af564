"""Association of categorical columns: contingency counts of all pairs from one scan.

Each row is laid out once per pair and counted by pair and values, which combines before the
shuffle. (Grouping sets count the same, but carry all columns in every key, and took forty
times as long for ten columns.) The counts are staged; margins, expected counts and statistics
of all pairs are grouped from there, so the table is read once for any number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

PAIR = ["x", "y"]


def pair_counts(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Contingency counts of column pairs in long form: ``x, y`` (column names), ``a, b`` (values as text), ``n``.

    Rows with a null in either column of a pair are left out of that pair. The columns may
    have any names.
    """
    text = lambda c: F.col(_quoted(c)).cast("string")
    both = [F.struct(F.lit(i).alias("pair"), text(x).alias("a"), text(y).alias("b")) for i, (x, y) in enumerate(pairs)]
    cells = df.select(F.inline(F.array(*both))).where("a is not null and b is not null")
    cells = cells.groupBy("pair", "a", "b").agg(F.count("*").alias("n"))
    named = [F.element_at(F.array(*[F.lit(p[side]) for p in pairs]), F.col("pair") + 1) for side in (0, 1)]
    return cells.select(named[0].alias("x"), named[1].alias("y"), "a", "b", "n")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def chi2_of_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Chi-square of independence per pair: ``x, y, chi2, dof, n, n_rows, n_cols``; no row for a pair without rows.

    Only cells that occur are read. An empty cell adds exactly its expected count, and the
    expected counts of a pair add up to ``n``, so no full row-by-column grid is built. At one
    degree of freedom the continuity correction is applied.
    """
    cells = stage(pair_counts(df, pairs), "pair-counts")
    rows = cells.groupBy(*PAIR, "a").agg(F.sum("n").alias("row_n"))
    cols = cells.groupBy(*PAIR, "b").agg(F.sum("n").alias("col_n"))
    sizes = rows.groupBy(*PAIR).agg(
        F.sum("row_n").alias("n"), F.count("*").alias("n_rows"), F.sum(1.0 / F.col("row_n")).alias("inv_rows")
    )
    sizes = sizes.join(cols.groupBy(*PAIR).agg(F.count("*").alias("n_cols"), F.sum(1.0 / F.col("col_n")).alias("inv_cols")), PAIR)
    o = F.col("o").cast("double")
    e = F.col("row_n").cast("double") * F.col("col_n") / F.col("n")
    met = cells.withColumnRenamed("n", "o").join(rows, [*PAIR, "a"]).join(cols, [*PAIR, "b"]).join(sizes, PAIR)
    seen = met.groupBy(*PAIR).agg(
        F.count("*").alias("n_cells"), F.sum((o - e) * (o - e) / e).alias("chi2_seen"), F.sum(e).alias("e_seen"),
        F.max(F.abs(o - e)).alias("shift"),
    )
    full = seen.join(sizes, PAIR)
    dof = (F.col("n_rows") - 1) * (F.col("n_cols") - 1)
    unseen = F.when(F.col("n_cells") < F.col("n_rows") * F.col("n_cols"), F.col("n") - F.col("e_seen")).otherwise(0.0)
    # In a 2 x 2 table all four cells are off by the same amount; the continuity
    # correction takes up to 0.5 of it, and sum(1/e) factors into the margins.
    reduced = F.col("shift") - F.least(F.lit(0.5), F.col("shift"))
    corrected = reduced * reduced * F.col("n") * F.col("inv_rows") * F.col("inv_cols")
    chi2 = F.when(dof == 0, 0.0).when(dof == 1, corrected).otherwise(F.col("chi2_seen") + unseen)
    return full.select(*PAIR, chi2.alias("chi2"), dof.alias("dof"), "n", "n_rows", "n_cols")


def v_of(chi2: Column) -> Column:
    """Cramer's V, between 0 and 1 (no bias correction); null where a column has one value."""
    least = F.least(F.col("n_rows"), F.col("n_cols")) - 1
    return F.sqrt(F.try_divide(chi2, (F.col("n") * least).cast("double")))


def cramers_v_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``x, y, chi2, dof, n, cramers_v`` of every pair of columns, x before y in the order given."""
    found = chi2_of_pairs(df, list(combinations(columns, 2)))
    return found.select(*PAIR, "chi2", "dof", "n", v_of(F.col("chi2")).alias("cramers_v"))
