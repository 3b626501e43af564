"""Stored states of landings, and Parquet clustered by a column."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.operators import summary_states as S
from millrace.operators.aggregates import named_agg
from millrace.plans.sales import summaries
from millrace.sources import clustered as C


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def amounts(spark, n=3000):
    v = F.when(F.col("id") % 11 != 3, (F.xxhash64("id") % 100_000_000) / 1000.0)
    return spark.range(n).select("id", F.when(F.col("id") % 7 != 5, F.col("id") % 3).alias("g"), (F.col("id") % 2).alias("h"), v.alias("v"))


def test_two_landings_equal_one_run_bit_for_bit(spark, tmp_path):
    df = amounts(spark)
    path = str(tmp_path / "states")
    for name, part in (("a", df.where("id < 1234")), ("b", df.where("id >= 1234").repartition(5))):
        S.store(S.summary_state(part, ["g", "h"], "v"), path, name)
    assert rows_of(S.finish(S.stored(spark, path), ["g", "h"], "v")) == rows_of(named_agg(df, ["g", "h"], "v"))
    assert rows_of(S.finish(S.stored(spark, path), ["g"], "v")) == rows_of(named_agg(df, ["g"], "v"))


def test_a_landing_stored_again_replaces_itself(spark, tmp_path):
    df = amounts(spark, 300)
    path = str(tmp_path / "states")
    for name, part in (("a", df.where("id < 200")), ("b", df.where("id >= 200")), ("a", df.where("id < 100"))):
        S.store(S.summary_state(part, ["g"], "v"), path, name)
    assert rows_of(S.finish(S.stored(spark, path), ["g"], "v")) == rows_of(named_agg(df.where("id < 100 or id >= 200"), ["g"], "v"))


def test_missing_counts_merge(spark, tmp_path):
    df = amounts(spark, 500)
    path = str(tmp_path / "missing")
    for i in (0, 1):
        S.store(S.missing_state(df.where(F.col("id") % 2 == i), ["g", "v", "id"]), path, f"l{i}")
    got = {r["column_name"]: (r["missing_count"], r["missing_pct"]) for r in S.merged_missing(S.stored(spark, path)).collect()}
    n = {c: df.where(f"{c} is null").count() for c in ("g", "v", "id")}
    assert got == {c: (k, round(k / 5, 3)) for c, k in n.items()}


@pytest.mark.parametrize("value, count", [(0.004, 10), (1e18, 10), (9.2e12, 40), (1e-9, 10), (float("inf"), 2)])
def test_values_beyond_the_units_get_plain_sums(spark, value, count):
    """Small, large and infinite amounts are neither rounded nor dropped."""
    df = spark.range(count).select(F.lit("g").alias("g"), F.lit(value).alias("v"))
    for found in (S.finish(S.summary_state(df, ["g"], "v", 2), ["g"], "v", 2).first(), named_agg(df, ["g"], "v").first()):
        assert found["total_v"] == pytest.approx(value * count, rel=1e-12) and found["item_count"] == count


def test_a_total_beyond_bigint_units(spark):
    """1.2 million rows of 9.2e12 overflowed the sum of the high parts."""
    df = spark.range(1_200_000).select(F.lit("g").alias("g"), F.lit(9.2e12).alias("v"))
    assert named_agg(df, ["g"], "v").first()["total_v"] == 1_200_000 * 9.2e12
    signed = spark.range(1000).select(F.lit(1).alias("g"), F.when(F.col("id") % 2 == 0, -0.1).otherwise(0.3).alias("v"))
    assert named_agg(signed, ["g"], "v").first()["total_v"] == 100.0


def test_sales_summaries_keep_small_and_large_amounts(spark):
    def sold(value):
        return spark.range(10).select(
            F.lit("r").alias("region"), F.lit("c").alias("category"), F.lit("p").alias("payment_method"),
            F.lit("2024-01-05").cast("date").alias("order_date"), F.lit(value).alias("amount"),
        )

    for value in (0.004, 1e18):
        for part in summaries(sold(value))[0].values():
            r = part.first()
            assert r["total_amount"] == pytest.approx(10 * value) and r["item_count"] == 10


def test_clustered_files_hold_ranges(spark, tmp_path):
    path = str(tmp_path / "t")
    df = amounts(spark, 4000)
    C.write_clustered(df, path, "v", rows_per_file=200)
    held = sorted((r for r in C.manifest(spark, path).collect() if r["low"] is not None), key=lambda r: (r["low"], r["high"]))
    assert len(held) > 10 and all(a["high"] <= b["low"] for a, b in zip(held, held[1:])) and sum(r["n_rows"] for r in held) >= 3600
    assert sum(r["n_missing"] for r in C.manifest(spark, path).collect()) == df.where("v is null").count()
    low, high = 1000.0, 9000.0
    near = C.read_clustered(spark, path, "v", low, high)
    assert rows_of(near) == rows_of(df.where(F.col("v").between(low, high)))
    assert 0 < len(near.inputFiles()) <= len(spark.read.parquet(path).inputFiles()) / 3
    assert C.read_clustered(spark, path, "v", 1e12, 2e12).count() == 0
    assert rows_of(spark.read.parquet(path)) == rows_of(df)


def test_a_frequent_value_spans_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    C.write_clustered(df, path, "v", rows_per_file=250)
    assert max(r["n_rows"] for r in C.manifest(spark, path).collect()) <= 500
    assert C.read_clustered(spark, path, "v", 5.0, 5.0).count() == 1001 and math.isclose(C.read_clustered(spark, path, "v", 0, 1e9).count(), 3000)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    C.write_clustered(amounts(spark, 0), path, "v")
    assert C.read_clustered(spark, path, "v", 0.0, 1.0).count() == 0
    state = S.summary_state(amounts(spark, 0), ["g"], "v")
    assert S.finish(state, ["g"], "v").count() == 0
