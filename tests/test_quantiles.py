import math
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import quantiles as Q
from millrace.session import stage

NAN = float("nan")


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)


@pytest.fixture
def tight(monkeypatch):
    """Cells so small that a few thousand rows take every pass."""
    monkeypatch.setattr(Q, "CELLS", 4)


PROBS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}


@pytest.mark.parametrize("shape", ["normal", "ties", "heavy", "powers", "close"])
def test_equals_sorted_values(spark, tight, shape):
    rng = np.random.default_rng(1)
    v = {
        "normal": rng.normal(size=3000),
        "ties": rng.integers(0, 7, 3000),
        "heavy": np.where(rng.random(3000) < 0.4, 3.25, rng.normal(size=3000)),
        "powers": 10.0 ** rng.uniform(-8, 8, 3000),
        "close": 1 + rng.integers(0, 1 << 40, 3000) * 2.0**-52,
    }[shape]
    got = Q.exact_quantiles(frame(spark, v), "v", PROBS).first()
    assert got["n"] == 3000
    for name, p in PROBS.items():
        assert math.isclose(got[name], np.quantile(v, p), rel_tol=1e-12, abs_tol=1e-12)


def test_groups_of_different_size_and_null_key(spark, tight):
    rng = np.random.default_rng(2)
    data = [("big", float(x)) for x in rng.normal(size=2000)] + [("small", 5.0), ("small", 7.0)]
    data += [(None, float(x)) for x in rng.normal(size=900)] + [("gap", NAN), ("gap", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(3)
    got = {r["g"]: r for r in Q.exact_quantiles(df, "v", {"q": 0.3}, by=["g"]).collect()}
    assert set(got) == {"big", "small", None}
    for g in got:
        want = np.quantile([v for k, v in data if k == g], 0.3)
        assert math.isclose(got[g]["q"], want, rel_tol=1e-12)


def test_large_integers_with_one_frequent_value(spark, tight):
    """A value that holds most rows, between numbers that doubles cannot tell apart."""
    often = 2**62 + 12345
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(often)).otherwise(F.xxhash64("id")).alias("v")
    )
    values = sorted(r[0] for r in df.collect())
    got = Q.order_statistics(df, "v", 2, lambda n, i: F.floor(n * F.lit([0.2, 0.7][i])), []).first()
    assert (got["at0"], got["at1"]) == (values[600], values[2100])
    assert got["below1"] == values.index(values[2100]) and got["equal1"] == values.count(values[2100])


def test_extremes_of_bigint(spark, tight):
    df = spark.createDataFrame([(x,) for x in [-(2**63), 2**63 - 1] * 300], "v bigint")
    got = Q.order_statistics(df, "v", 2, lambda n, i: F.floor(n * F.lit([0.25, 0.75][i])), []).first()
    assert (got["at0"], got["at1"]) == (-(2**63), 2**63 - 1)


def test_keys_are_ordered_like_doubles(spark):
    rng = np.random.default_rng(3)
    edge = [x for e in range(-1074, 1024) for x in (2.0**e, np.nextafter(2.0**e, 0), np.nextafter(2.0**e, np.inf), -(2.0**e))]
    edge += [0.0, -0.0, 1.7976931348623157e308, math.inf, -math.inf, *np.frombuffer(rng.bytes(8 * 4000))]
    numbers = [float(v) for v in edge if not math.isnan(v)]
    found = Q.with_order_key(spark.createDataFrame([(v,) for v in numbers], "v double"), "v", "k").collect()
    bits = lambda v: struct.unpack("<q", struct.pack("<d", v))[0]
    assert all(r["k"] == (-bits(-r["v"]) if r["v"] < 0 else bits(abs(r["v"]))) for r in found)


def passes(spark, df, by=(), monkeypatch=None):
    """Passes over the rows, and the largest number of cells that one of them sorts for one cell before."""
    sizes, counted = [], Q._counted

    def spy(rows, keys, digit):
        cells = counted(rows, keys, digit)
        sizes.append(cells.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return cells

    monkeypatch.setattr(Q, "_counted", spy)
    return Q.exact_quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.9}, by=by).collect(), sizes


def test_four_passes_and_bounded_cells_whatever_the_values(spark, monkeypatch):
    """40 % ties, whole numbers around 1e15 and three slots by group."""
    n = 400_000
    value = F.when(F.col("id") % 5 < 2, F.lit(10**15)).otherwise(F.lit(10**15) + F.abs(F.xxhash64("id")) % F.lit(10**15))
    df = stage(spark.range(n).select((F.col("id") % 3).alias("g"), value.alias("v")), "ties")
    rows, sizes = passes(spark, df, ["g"], monkeypatch)
    assert len(sizes) <= 4 and max(sizes) <= 1 << 16
    held = df.toPandas()
    for r in rows:
        want = np.quantile(held[held.g == r["g"]].v, [0.1, 0.5, 0.9])
        assert np.allclose([r["a"], r["b"], r["c"]], want, rtol=1e-15)


def test_a_range_too_wide_for_one_pass(spark, monkeypatch):
    df = spark.range(200_000).select((F.xxhash64("id") % F.lit(1 << 40)).cast("double").alias("v"))
    (row,), sizes = passes(spark, stage(df, "wide"), (), monkeypatch)
    assert len(sizes) <= 4 and max(sizes) <= 1 << 16
    assert np.allclose([row["a"], row["b"], row["c"]], np.quantile(df.toPandas().v, [0.1, 0.5, 0.9]), rtol=1e-15)


def test_infinite_and_signed_zero(spark):
    df = spark.createDataFrame([(v,) for v in [-math.inf, -0.0, 0.0, 0.0, math.inf, math.inf]], "v double")
    row = Q.exact_quantiles(df, "v", {"a": 0.0, "m": 0.5, "z": 1.0}).first()
    assert (row["a"], row["m"], row["z"]) == (-math.inf, 0.0, math.inf)


def test_missing_and_empty(spark):
    df = spark.createDataFrame([(NAN,), (None,), (1.0,), (2.0,)], "v double")
    row = Q.exact_quantiles(df, "v", {"m": 0.5}).first()
    assert (row["n"], row["m"]) == (2, 1.5)
    none = Q.exact_quantiles(df.where("v > 100 and not isnan(v)"), "v", {"m": 0.5}).first()
    assert none["m"] is None
    assert Q.exact_quantiles(df, "v", {"m": 0.5}).count() == 1


def test_decimal_column(spark):
    df = spark.sql("select cast(id as decimal(20,4)) as v from range(11)")
    assert Q.exact_quantiles(df, "v", {"m": 0.5}).first()["m"] == 5.0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=40), st.floats(0, 1))
def test_any_list(spark, values, p):
    got = Q.exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), "v", {"q": p}).first()["q"]
    assert math.isclose(got, np.quantile(values, p), rel_tol=1e-9, abs_tol=1e-6)
