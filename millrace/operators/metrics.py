"""Scores of predictions. Each metric reads the predictions once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def accuracy(df: DataFrame, label: str, prediction: str, count: str | None = None) -> DataFrame:
    """Share of rows predicted right; ``count`` names how many rows a row stands for."""
    n = F.lit(1) if count is None else F.col(count)
    right = F.coalesce(F.sum(F.when(F.col(label) == F.col(prediction), n)), F.lit(0))
    return df.agg(F.try_divide(right, F.sum(n)).alias("accuracy"))


def positive_ratio(df: DataFrame, label: str) -> DataFrame:
    """Share of ones in a 0/1 column."""
    return df.agg(F.try_divide(F.sum(label), F.count(label)).alias("positive_ratio"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 when the metric is undefined."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_report(counts: DataFrame, label: str, prediction: str) -> DataFrame:
    """``class, precision, recall, f1, support`` from confusion counts, followed by the
    rows ``accuracy`` (in the f1 column), ``macro avg`` and ``weighted avg``."""
    y, p, n = F.col(label), F.col(prediction), F.col("n")
    sides = F.array(
        F.struct(y.cast("string").alias("class"), n.alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(y == p, n).otherwise(0).alias("hit")),
        F.struct(p.cast("string").alias("class"), F.lit(0).cast("bigint").alias("support"), n.alias("predicted"),
                 F.lit(0).cast("bigint").alias("hit")),
    )
    per_class = stage(  # the predictions behind the counts are scored only once
        counts.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
        .select(
            "class",
            "hit",
            _ratio(F.col("hit"), F.col("predicted")).alias("precision"),
            _ratio(F.col("hit"), F.col("support")).alias("recall"),
            _ratio(2 * F.col("hit"), F.col("support") + F.col("predicted")).alias("f1"),
            "support",
        ),
        "class-report",
    )
    scores = ("precision", "recall", "f1")
    w = F.sum("support")

    def row(name: str, values: list[Column]) -> Column:
        parts = [v.cast("double").alias(s) for s, v in zip(scores, values)]
        return F.struct(F.lit(name).alias("class"), *parts, w.alias("support"))

    overall = per_class.agg(
        F.array(
            row("accuracy", [F.lit(None), F.lit(None), _ratio(F.sum("hit"), w)]),
            row("macro avg", [F.avg(s) for s in scores]),
            row("weighted avg", [_ratio(F.sum(F.col(s) * F.col("support")), w) for s in scores]),
        ).alias("rows")
    ).select(F.inline("rows"))
    return per_class.select("class", *scores, "support").orderBy("class").unionByName(overall)


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always predicting the most frequent class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg(F.try_divide(F.max("n"), F.sum("n")).alias("accuracy"))


def rule_baseline(df: DataFrame, label: str, rule: Column) -> DataFrame:
    """Accuracy of predicting 1 exactly where the rule holds."""
    return accuracy(df.withColumn("_rule", rule.cast("int")), label, "_rule")


def f1_score(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """F1 of class 1 in a 0/1 problem, 0 when undefined."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(_ratio(2 * F.count_if(y & p), F.count_if(y) + F.count_if(p)).alias("f1"))


def r_squared(df: DataFrame, target: str, prediction: str) -> DataFrame:
    """1 - residual variance / variance around the mean."""
    y, p = F.col(target), F.col(prediction)
    return df.agg((1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))).alias("r2"))
