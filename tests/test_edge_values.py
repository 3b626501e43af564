"""Sums outside the usual range, splits by row, CSV text, and constant groups."""

import math

import pytest

from millrace.operators.aggregates import named_agg
from millrace.operators.splits import stratified_split
from millrace.operators.statistics import ttest
from millrace.session import scratch_path
from millrace.sources.readers import read_csv
from millrace.sources.sinks import markdown_table, write_csv


@pytest.mark.parametrize("values, total", [
    ([1e-7] * 1000, 1e-4), ([1e13] * 3, 3e13), ([1.0, math.inf], math.inf), ([0.1] * 10, 1.0), ([None, float("nan"), 2.5], 2.5),
])
def test_sums_are_not_rounded_or_refused(rows, values, total):
    got = named_agg(rows("k string, amount double", [("a", v) for v in values]), ["k"]).first()
    assert got["total_amount"] == pytest.approx(total, rel=1e-12)


def test_sum_of_whole_numbers_is_exact(rows):
    got = named_agg(rows("k string, amount bigint", [("a", 2**53 + 1), ("a", 2**53 + 1), ("a", None)]), ["k"]).first()
    assert (got["total_amount"], got["item_count"]) == (float(2**54 + 2), 2)


def test_split_spreads_equal_rows(spark):
    df = spark.range(12000).selectExpr("id", "cast(id % 6 as string) as c", "cast(id % 2 as int) as y")
    for key in ((), ("id",)):
        _, test = stratified_split(df if key else df.drop("id"), "y", key=key)
        assert "id" not in test.columns
        counts = {r["c"]: r["count"] for r in test.groupBy("c").count().collect()}
        assert len(counts) == 6 and all(330 < n < 470 for n in counts.values())


def test_split_of_many_classes(spark):
    df = spark.range(20000).selectExpr("id", "id % 2000 as y")
    train, test = stratified_split(df, "y", key=["id"])
    assert (train.count(), test.count()) == (16000, 4000)
    assert test.groupBy("y").count().where("count <> 2").isEmpty()


def test_csv_keeps_text(spark, rows):
    data = [(1, " padded "), (2, 'say "hi", then'), (3, "two\nlines"), (4, None), (5, "plain")]
    path = scratch_path(spark, "csv-text")
    write_csv(rows("id int, t string", data), path)
    assert sorted(tuple(r) for r in read_csv(spark, path, "id int, t string", multi_line=True).collect()) == data


def test_null_markers_before_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,x,t\n1,NA,a\n2,2.5,NA\n-,3,b\n")
    df = read_csv(spark, str(tmp_path), null_values=["NA", "-"])
    assert [t for _, t in df.dtypes] == ["int", "double", "string"]
    assert [tuple(r) for r in df.collect()] == [(1, None, "a"), (2, 2.5, None), (None, 3.0, "b")]


def test_long_report(spark):
    assert markdown_table(spark.range(1001)).count("\n") == 1002


def test_constant_groups_that_differ(rows):
    df = rows("g string, v double", [("a", 1.0), ("a", 1.0), ("b", 2.0), ("b", 2.0)])
    r = ttest(df, "g", "a", "b", "v").first()
    assert (r["t_stat"], r["p_value"]) == (-math.inf, 0.0)


def test_column_agreement_sums_whole_numbers(spark):
    """Copies and order do not matter, a value in place of its copy does; sums need no decimals, which took most of the time."""
    from millrace.operators.reconcile import column_agreement

    left = spark.createDataFrame([("x", None), ("x", "y"), ("z", "y")], "a string, b string")
    right = spark.createDataFrame([("z", "y"), ("x", "y"), ("z", None)], "a string, b string")
    got = {r["column_name"]: (r["left_rows"], r["right_rows"], r["agrees"]) for r in column_agreement(left, right).collect()}
    assert got == {"a": (3, 3, False), "b": (2, 2, True)}
    assert "decimal" not in column_agreement(left, right)._jdf.queryExecution().optimizedPlan().toString().lower()
    empty = column_agreement(left.where("false"), right.where("false")).collect()
    assert [tuple(r) for r in empty] == [("a", 0, 0, True), ("b", 0, 0, True)]
