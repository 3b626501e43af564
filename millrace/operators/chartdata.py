"""Reduced series behind charts: only these small results need to leave the cluster."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import DECIMALS, missing
from millrace.operators.aggregates import named_agg
from millrace.operators.quantiles import exact_quantiles
from millrace.session import stage

BOXES = 32  # boxes per bandwidth in a density
TERMS = 7  # moments kept of each box: distances are at most 1/64, and what follows is below 1e-13 of the kernel
REACH = 8.2  # bandwidths after which a kernel is below 1e-14 of its height


@dataclass(frozen=True)
class Bins:
    low: float
    high: float
    count: int

    @property
    def width(self) -> float:
        return (self.high - self.low) / self.count


def auto_bins(df: DataFrame, value: str) -> Bins:
    """Equal bins of the smaller of the Freedman-Diaconis and Sturges widths, where the
    former is at least half the square-root width (so never more than 2 sqrt(n) bins)."""
    q = exact_quantiles(df, value, {"low": 0.0, "q1": 0.25, "q3": 0.75, "high": 1.0}).first()
    lo, hi = q["low"], q["high"]
    if lo is None:
        raise ValueError(f"no values in column {value}")
    if lo == hi:
        return Bins(lo - 0.5, hi + 0.5, 1)
    sturges = (hi - lo) / (math.log2(q["n"]) + 1.0)
    robust = 2.0 * (q["q3"] - q["q1"]) * q["n"] ** (-1.0 / 3.0)
    robust = max(robust, (hi - lo) / math.sqrt(q["n"]) / 2.0)
    return Bins(lo, hi, math.ceil((hi - lo) / min(robust, sturges)))


def histogram(df: DataFrame, value: str, bins: Bins | None = None) -> DataFrame:
    """``bin, left_edge, right_edge, n``; empty bins included, last bin closed."""
    bins = bins or auto_bins(df, value)
    v = F.col(value).cast("double")
    span = bins.high - bins.low
    index = F.least(
        F.floor((v - F.lit(bins.low)) / F.lit(span) * F.lit(float(bins.count))), F.lit(bins.count - 1)
    )
    counts = (
        df.where(~missing(df, value) & v.between(bins.low, bins.high))
        .groupBy(index.alias("_bin"))
        .agg(F.count("*").alias("_n"))
    )
    edges = df.sparkSession.range(bins.count).withColumnRenamed("id", "bin")
    return (
        edges.join(counts, F.col("bin") == F.col("_bin"), "left")
        .select(
            "bin",
            (F.lit(bins.low) + F.col("bin") * F.lit(bins.width)).alias("left_edge"),
            (F.lit(bins.low) + (F.col("bin") + 1) * F.lit(bins.width)).alias("right_edge"),
            F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"),
        )
        .orderBy("bin")
    )


def density(df: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Gaussian density curve: ``point, x, density`` between the minimum and maximum.

    A fast Gauss sum: rows are reduced to boxes of 1/32 bandwidth that keep the moments of
    the distances from their middle, and a box adds its Hermite expansion to the grid points
    within reach of its kernel. The expansion is exact to some 1e-13 of the kernel, and beyond
    the reach the kernel is below that. The work is rows + boxes x points in reach: a long
    empty tail has no boxes, and a far point meets none but its own.
    """
    present = df.where(~missing(df, value)).select(F.col(value).cast("double").alias("_v"))
    s = present.agg(
        F.count("*").alias("n"), F.stddev_samp("_v").alias("sd"), F.min("_v").alias("lo"), F.max("_v").alias("hi")
    ).first()
    if not s["sd"]:
        raise ValueError(f"column {value} has no spread")
    h = s["sd"] * s["n"] ** -0.2
    scaled = (F.col("_v") - F.lit(s["lo"])) / F.lit(h)
    box = F.floor(scaled * F.lit(float(BOXES)))
    away = scaled - (F.col("_b") + 0.5) / F.lit(float(BOXES))
    powers = [F.lit(1.0)]
    for _ in range(1, TERMS):
        powers.append(powers[-1] * F.col("_d"))
    boxes = present.select(box.alias("_b"), "_v").withColumn("_d", away).groupBy("_b").agg(
        *[F.sum(p).alias(f"_m{k}") for k, p in enumerate(powers)]
    )
    step = (s["hi"] - s["lo"]) / (points - 1)
    middle = (F.col("_b") + 0.5) * F.lit(h / BOXES)  # from the minimum
    reach = REACH * h
    first = F.greatest(F.ceil((middle - reach) / F.lit(step)), F.lit(0))
    last = F.least(F.floor((middle + reach) / F.lit(step)), F.lit(points - 1))
    near = boxes.where(first <= last).select("*", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("point"))
    near = near.withColumn("_t", (F.col("point") * F.lit(step) - middle) / F.lit(h))
    # phi(t - d) = phi(t) * sum of He_k(t) d^k / k!, with He_{k+1} = t He_k - k He_{k-1}
    t = F.col("_t")
    hermite = [F.lit(1.0), t]
    for k in range(1, TERMS - 1):
        hermite.append(t * hermite[k] - F.lit(float(k)) * hermite[k - 1])
    terms = [F.col(f"_m{k}") * hermite[k] / F.lit(float(math.factorial(k))) for k in range(TERMS)]
    kernel = F.exp(-t * t / 2) * reduce(lambda a, b: a + b, terms)
    # points that no box reaches have the density 0
    grid = df.sparkSession.range(0, points, 1, 1).select(F.col("id").cast("int").alias("point"), F.lit(0.0).alias("_k"))
    sums = near.select("point", kernel.alias("_k")).unionByName(grid).groupBy("point").agg(F.sum("_k").alias("_k"))
    height = F.lit(s["n"] * h * math.sqrt(2.0 * math.pi))
    return sums.select(
        "point", (F.lit(s["lo"]) + F.col("point") * F.lit(step)).alias("x"), (F.col("_k") / height).alias("density")
    ).orderBy("point")


def box_summary(df: DataFrame, group: str, value: str, k: float = 1.5) -> DataFrame:
    """Per group: quartiles, whiskers (furthest value within the fence), outlier count."""
    quartiles = stage(
        exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[group]).select(
            F.col(group).alias("_g"), "n", "q1", "median", "q3"
        ),
        "quartiles",
    )
    v = F.col(value).cast("double")
    reach = k * (F.col("q3") - F.col("q1"))
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    # The staged quartiles are one row per group with a known size: Spark broadcasts them
    # when they are small and repartitions otherwise.
    return (
        df.where(~missing(df, value))
        .join(quartiles, F.col(group).eqNullSafe(F.col("_g")))
        .groupBy(group)
        .agg(
            F.any_value("n").alias("n"),
            F.any_value("q1").alias("q1"),
            F.any_value("median").alias("median"),
            F.any_value("q3").alias("q3"),
            F.min(F.when(inside, v)).alias("_lo"),
            F.max(F.when(inside, v)).alias("_hi"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(
            group,
            "n",
            "q1",
            "median",
            "q3",
            F.least("_lo", "q1").alias("whisker_low"),
            F.greatest("_hi", "q3").alias("whisker_high"),
            "outliers",
        )
        .orderBy(group)
    )


def grouped_bars(df: DataFrame, x: str, color: str, value: str, scale: int | None = DECIMALS) -> DataFrame:
    """Total per pair, in chart order: one series per color, x ascending within it."""
    return named_agg(df, [x, color], value, scale, order=False).orderBy(color, x)


def grouped_bars_wide(
    df: DataFrame, x: str, color: str, value: str, colors: list | None = None, scale: int | None = DECIMALS
) -> DataFrame:
    """One row per x, one column of totals per color."""
    pairs = named_agg(df, [x, color], value, scale, order=False)
    return pairs.groupBy(x).pivot(color, colors).agg(F.first(f"total_{value}")).orderBy(x)
