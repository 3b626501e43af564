"""Reconciliation by a hash tree against plain multiset differences."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import hashtree as H
from millrace.operators.reconcile import column_agreement


def differences(left, right):
    a, b = (Counter(map(tuple, df.collect())) for df in (left, right))
    return sorted(((*row, a[row], b[row]) for row in a.keys() | b.keys() if a[row] != b[row]), key=repr)


def found(left, right, keys):
    return sorted(map(tuple, H.row_differences(left, right, keys).collect()), key=repr)


@pytest.fixture
def narrow(monkeypatch):
    """Few rows go on to the next level, so that several levels are used."""
    monkeypatch.setattr(H, "BITS", 3)
    monkeypatch.setattr(H, "FEW_ROWS", 10)


def table(spark, n=3000):
    return spark.range(n).select(
        F.when(F.col("id") % 50 != 7, F.col("id")).alias("k"), (F.col("id") * 3).cast("double").alias("v"), F.col("id").cast("string").alias("a b")
    )


def test_changed_missing_repeated_and_null_rows(spark, narrow):
    left = table(spark)
    right = left.where("k is null or k <> 11").withColumn("v", F.when(F.col("a b") == "57", None).otherwise(F.col("v")))
    right = right.unionByName(left.where("k = 20")).repartition(3)
    assert found(left, right, ["k"]) == differences(left, right) and len(found(left, right, ["k"])) == 4
    levels = [H.touched_buckets(left, right, ["k"], left.columns)[1]]
    assert levels[0] > 1


def test_equal_tables_in_another_order(spark, narrow):
    left = table(spark)
    right = left.orderBy(F.xxhash64("v")).repartition(5)
    assert H.touched_buckets(left, right, ["k"], left.columns)[0] is None and found(left, right, ["k"]) == []
    assert H.tables_agree(left, right, ["k"]).first()["agrees"]
    empty = left.limit(0)
    assert found(empty, empty, ["k"]) == [] and H.tables_agree(empty, empty, ["k"]).first()["agrees"]


def test_only_touched_buckets_are_compared(spark):
    left = table(spark, 200_000)
    right = left.withColumn("v", F.when(F.col("k").isin(5, 6, 70_000, 123_456, 199_999), -1.0).otherwise(F.col("v")))
    buckets, level = H.touched_buckets(left, right, ["k"], left.columns)
    held = buckets.agg(F.sum("held")).first()[0]
    assert buckets.count() == 5 and held < 1000
    row = H.tables_agree(left, right, ["k"]).first()
    assert (row["left_rows"], row["right_rows"], row["left_only"], row["right_only"], row["agrees"]) == (200_000, 200_000, 5, 5, False)


def test_nothing_in_common_and_one_empty_side(spark, narrow):
    left, right = table(spark, 40), table(spark, 40).withColumn("v", -F.col("v") - 1)
    assert len(found(left, right, ["k"])) == 80 and found(left, left.limit(0), ["k"]) == differences(left, left.limit(0))


def test_a_value_that_moves_between_columns_or_to_null(spark):
    left = spark.createDataFrame([(1, "a", None), (2, "b", "c")], "k int, x string, y string")
    right = spark.createDataFrame([(1, None, "a"), (2, "c", "b")], "k int, x string, y string")
    assert found(left, right, ["k"]) == differences(left, right)


def test_columns_that_disagree_are_named(spark):
    left = spark.createDataFrame([("1", "x"), ("2", None)], "a string, `b c` string")
    right = spark.createDataFrame([("2", None), ("1", "y")], "a string, `b c` string")
    got = [tuple(r) for r in column_agreement(left, right).orderBy("column_name").collect()]
    assert got == [("a", 2, 2, True), ("b c", 1, 1, False)]
