"""Hypothesis tests. The table is reduced to counts and moments on the executors; the
last formula runs on one summary row."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import missing
from millrace.functions.distributions import chi2_upper, t_two_sided
from millrace.operators.association import chi2_of_pairs, cramers_v_matrix

ALPHA = 0.05

TTEST_SCHEMA = (
    "group_a string, group_b string, n_a bigint, n_b bigint, mean_a double, mean_b double, "
    "t_stat double, dof bigint, p_value double"
)
CHI2_SCHEMA = "chi2 double, p_value double, dof bigint, n bigint, n_rows bigint, n_cols bigint"


def group_moments(df: DataFrame, group: str, a: str, b: str, value: str) -> DataFrame:
    """Count, mean and sample variance of the two groups: at most two rows."""
    return (
        df.where(F.col(group).isin(a, b) & ~missing(df, value))
        .groupBy(group)
        .agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))
    )


def ttest(df: DataFrame, group: str, a: str, b: str, value: str) -> DataFrame:
    """Two-sample t-test with pooled variance, two-sided."""
    found = {r[group]: r for r in group_moments(df, group, a, b, value).collect()}
    for name in (a, b):
        if name not in found:
            raise ValueError(f"no rows with {group} = {name!r}")
    ra, rb = found[a], found[b]
    dof = ra["n"] + rb["n"] - 2
    t = p = None
    if dof > 0:
        pooled = sum((r["n"] - 1) * (r["var"] or 0.0) for r in (ra, rb)) / dof
        spread = math.sqrt(pooled * (1 / ra["n"] + 1 / rb["n"]))
        if spread > 0:
            t = (ra["mean"] - rb["mean"]) / spread
            p = t_two_sided(t, dof)
        elif ra["mean"] != rb["mean"]:  # constant groups that differ
            t, p = math.copysign(math.inf, ra["mean"] - rb["mean"]), 0.0
    row = (a, b, ra["n"], rb["n"], ra["mean"], rb["mean"], t, dof, p)
    return df.sparkSession.createDataFrame([row], TTEST_SCHEMA)


def chi2_statistic(df: DataFrame, a: str, b: str) -> DataFrame:
    """At most one row: chi-square statistic of independence, ``dof, n, n_rows, n_cols``."""
    return chi2_of_pairs(df, [(a, b)]).drop("x", "y")


def chi2_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """The statistic together with its p-value."""
    r = chi2_statistic(df, a, b).first()
    if r is None:
        raise ValueError(f"no rows with both {a} and {b}")
    row = (r["chi2"], chi2_upper(r["chi2"], r["dof"]), r["dof"], r["n"], r["n_rows"], r["n_cols"])
    return df.sparkSession.createDataFrame([row], CHI2_SCHEMA)


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: association of two categorical columns between 0 and 1 (no correction); none without rows."""
    return cramers_v_matrix(df, [a, b]).select("x", "y", "chi2", "cramers_v")


def verdict(p: Column, significant: str, not_significant: str, alpha: float = ALPHA) -> Column:
    """Text for a p-value; significant only when strictly below alpha."""
    return (
        F.when(p < alpha, F.lit(f"p < {alpha}: {significant}"))
        .when(p.isNotNull(), F.lit(f"p >= {alpha}: {not_significant}"))
    )
