"""Every registered query against its SQL, and the shape of the plans."""

import pytest

import __spark_entry__ as entry_points
from millrace.operators.profile import missing_report
from millrace.plans.sales import REQUIRED, cleaned_sales, sales, summaries, table
from tests.compare import connect, differences

QUERIES = entry_points.QUERIES
ORACLES = entry_points.ORACLES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf, name):
    n, diff = differences(spark, duck, QUERIES[name], ORACLES.get(name), sf)
    assert diff is None and n > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5


def test_known_row_flow(spark, sf):
    raw = sales(spark, sf)
    kept = cleaned_sales(spark, sf)
    assert (raw.count(), raw.dropna(subset=REQUIRED).count(), kept.count()) == (6000, 5846, 5710)
    parts, _ = summaries(raw)
    assert parts["region_category"].count() == 150
    assert sum(r["total_amount"] for r in parts["monthly_trend"].collect()) == pytest.approx(131710644.90)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_no_python_in_plans(spark, sf):
    for name in ("agg4_region_category", "dq1_valid_rows", "dq2_json_types", "src8_parallel_arrays", "ch3_box_summary"):
        text = plan(QUERIES[name](spark, sf))
        assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text, name


def test_fence_reaches_the_scan(spark, sf):
    text = plan(cleaned_sales(spark, sf).select("amount"))
    assert "GreaterThanOrEqual(amount" in text and "ReadSchema: struct<region:string,category:string,amount:double>" in text


def test_missing_report_scans_once(spark, sf):
    text = missing_report(table(spark, sf, "lineitem"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


def test_narrow_projection_reads_few_columns(spark, sf):
    text = plan(sales(spark, sf).select("quantity"))
    assert "l_extendedprice" not in text.split("== Physical Plan ==")[1]
