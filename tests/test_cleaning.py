import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import cleaning as C
from millrace.operators import profile as P

NAN = float("nan")


@pytest.fixture
def sales(rows):
    return rows(
        "region string, category string, amount double",
        [("a", "x", 1.0), ("a", None, 2.0), (None, "x", 3.0), ("b", "y", NAN), ("b", "y", None), ("b", "y", 4.0)],
    )


REQ = ["region", "category", "amount"]


def test_missing_covers_null_and_nan(sales):
    assert {r["amount"] for r in C.drop_missing(sales, REQ).collect()} == {1.0, 4.0}


def test_cleaning_report(sales):
    assert C.cleaning_report(sales, REQ).first().asDict() == {
        "rows_before": 6, "rows_after": 2, "rows_dropped": 4,
        "missing_region": 1, "missing_category": 1, "missing_amount": 2,
    }


def test_fence_arithmetic():
    # Published quartiles and the fence that belongs to them.
    f = C.Fence.from_quartiles(757318.5, 3928969.0)
    assert round(f.lower, 1) == -4000157.2 and round(f.upper, 1) == 8686444.8


def test_fence_is_inclusive(rows):
    df = rows("v double", [(float(x),) for x in (0, 1, 2, 3, 4, 8, 9, NAN)])
    kept = C.within_fence(df, "v", C.Fence(1, 3, 1.0, 8.0))
    assert sorted(r["v"] for r in kept.collect()) == [1, 2, 3, 4, 8]


def test_clean_and_report(rows):
    df = rows("region string, category string, amount double", [("a", "x", float(v)) for v in [*range(20), 1000]])
    kept, fence = C.clean(df, REQ, "amount")
    assert kept.count() == 20 and fence.q1 == 5.0
    report = C.fence_report(df, "amount", fence).first()
    assert (report["rows_before"], report["rows_after"], report["rows_removed"]) == (21, 20, 1)


def test_empty_column_has_no_fence(rows):
    with pytest.raises(ValueError):
        C.iqr_fence(rows("v double", [(None,)]), "v")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_fixed_fence_is_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    fence = C.iqr_fence(df, "v")
    once = C.within_fence(df, "v", fence)
    assert C.within_fence(once, "v", fence).count() == once.count() <= len(values)
    assert fence.lower <= fence.q1 <= fence.q3 <= fence.upper


def test_missing_report(sales):
    got = [tuple(r) for r in P.missing_report(sales).collect()]
    assert got == [("amount", 2, 33.333), ("category", 1, 16.667), ("region", 1, 16.667)]
    assert P.missing_report(sales.dropna()).count() == 0
    assert P.missing_report(sales.dropna(), only_missing=False).count() == 3
    empty = P.missing_report(sales.limit(0), only_missing=False).collect()
    assert {r["missing_pct"] for r in empty} == {None}


def test_report_on_odd_column_names(rows):
    df = rows("`a b` string, `c.d` double, n bigint", [(None, NAN, 1)])
    assert {r["column_name"]: r["missing_count"] for r in P.missing_report(df).collect()} == {"a b": 1, "c.d": 1}


def test_schema_profile(sales):
    got = [(r["position"], r["column_name"], r["data_type"], r["non_null"], r["row_count"]) for r in P.schema_profile(sales).collect()]
    assert got == [(0, "region", "string", 5, 6), (1, "category", "string", 5, 6), (2, "amount", "double", 4, 6)]


def test_consistency(rows):
    df = rows("a double, q bigint, p bigint", [(6.0, 2, 3), (7.0, 2, 3), (7.01, 2, 3), (None, 2, 3), (NAN, 1, 1)])
    assert tuple(P.consistency_report(df, "a", ("q", "p")).first()) == (3, 1, 33.333)
    assert P.consistency_report(df.limit(0), "a", ("q", "p")).first()["mismatch_pct"] is None
