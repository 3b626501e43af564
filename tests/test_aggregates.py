import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import reconcile as R
from millrace.operators.duplicates import drop_duplicates


@pytest.fixture
def sales(rows):
    return rows(
        "region string, category string, order_date string, amount double",
        [("a", "x", "2024-01-05", 1.1), ("a", "x", "2024-01-20", 2.2), ("b", "x", "2024-02-01", None),
         (None, "y", "2024-02-11", 5.0), ("b", "y", "2024-02-11", 3.3)],
    )


def test_null_keys_form_a_group_and_totals_lead(sales):
    got = [tuple(r) for r in A.named_agg(sales, ["region"]).collect()]
    assert got == [(None, 5.0, 5.0, 1), ("a", 3.3, 1.65, 2), ("b", 3.3, 3.3, 1)]


def test_group_without_values(sales):
    row = A.named_agg(sales.where("amount is null"), ["region"]).first()
    assert (row["total_amount"], row["avg_amount"], row["item_count"]) == (None, None, 0)


def test_sum_does_not_depend_on_partitions(spark):
    df = spark.range(20000).select((F.col("id") % 1000 / 100.0).alias("amount"), F.lit("g").alias("g"))
    totals = {A.named_agg(df.repartition(n), ["g"]).first()["total_amount"] for n in (1, 3, 7)}
    assert totals == {99900.0}


def test_exact_totals(rows):
    cents = [99999999999999, -1, -250, 7, 2**40, -(2**45), 0]
    df = rows("v double, g int", [(c / 100, 1) for c in cents] + [(float("nan"), 1), (None, 1)])
    row = A.named_agg(df, ["g"], "v", scale=2).first()
    assert row["total_v"] == sum(cents) / 100 and row["item_count"] == len(cents)
    plain = A.named_agg(df, ["g"], "v", scale=None).first()
    assert plain["total_v"] == pytest.approx(row["total_v"]) and plain["avg_v"] == pytest.approx(row["avg_v"])


def test_decimals_beyond_cents_count(rows):
    df = rows("v double, g int", [(0.000001, 1), (1.234567, 1), (-3.5, 1)])
    assert A.named_agg(df, ["g"], "v").first()["total_v"] == -2.265432


def test_very_large_numbers_are_summed(rows):
    assert A.named_agg(rows("v double, g int", [(1e300, 1), (1e300, 1)]), ["g"], "v").first()["total_v"] == 2e300


def test_month_of_text_and_date(sales):
    text = [tuple(r) for r in A.monthly_trend(sales).collect()]
    dates = sales.withColumn("order_date", F.to_date("order_date"))
    assert text == [tuple(r) for r in A.monthly_trend(dates).collect()]
    assert [r[0] for r in text] == ["2024-01", "2024-02"]
    assert [tuple(r) for r in A.monthly_total(sales).collect()] == [("2024-01", 3.3), ("2024-02", 8.3)]


def test_crosstab(sales):
    assert {tuple(r) for r in A.crosstab(sales, "region", "category").collect()} == {("a", "x", 2), ("b", "x", 1), ("b", "y", 1)}
    assert [tuple(r) for r in A.crosstab_wide(sales, "region", "category").collect()] == [("a", 2, 0), ("b", 1, 1)]


def test_compare_groups(sales):
    got = {r["category"]: (r["n"], r["mean"], r["median"]) for r in A.compare_groups(sales, "category", "amount").collect()}
    assert got == {"x": (2, 1.65, pytest.approx(1.65)), "y": (2, 4.15, pytest.approx(4.15))}


def test_top_plan_and_least(sales):
    top = A.top(A.named_agg(sales, ["region"], order=False), 1, "total_amount", ["region"])
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().toString()
    assert top.first()["region"] is None
    least = A.row_with_least(A.named_agg(sales.dropna(), ["region"], order=False), "region", "total_amount")
    assert tuple(least.first()) == ("a", 3.3)


def test_frequency(sales):
    assert [tuple(r) for r in A.frequency(sales, ["category"]).collect()] == [("x", 3), ("y", 2)]


def test_reconcile(rows):
    left = rows("k string, v double", [("a", 1.0), ("b", 2.0), (None, 3.0), ("n", None)])
    right = rows("k string, v double", [("a", 1.005), ("b", 2.5), (None, 3.0), ("c", 1.0), ("n", None)])
    got = {r["k"]: r["status"] for r in R.by_key(left, right, ["k"], "v").collect()}
    assert got == {"a": "match", "b": "differs", None: "match", "c": "right_only", "n": "match"}
    swapped = {r["k"]: r["status"] for r in R.by_key(right, left, ["k"], "v").collect()}
    assert swapped["c"] == "left_only"
    totals = R.grand_totals(left, right, "v").first()
    assert not totals["agrees"] and totals["abs_diff"] == pytest.approx(1.505)


def test_duplicates(rows):
    df = rows("k bigint, t bigint, v string", [(1, 2, "b"), (1, 1, "a"), (1, 1, "a"), (2, 5, None)])
    assert drop_duplicates(df).count() == 3
    assert sorted(map(tuple, drop_duplicates(df, ["k"], ["t"]).collect())) == [(1, 1, "a"), (2, 5, None)]
    assert drop_duplicates(df, ["k", "t", "v"]).count() == 3
