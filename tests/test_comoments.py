"""Co-moments, regressions on subsets and pair counts against plain computations."""

import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import association as A
from millrace.operators import correlation as C
from millrace.operators import subsets as S
from millrace.operators.aggregates import crosstab
from millrace.operators.comoments import Comoments, comoments


def pairwise(x):
    """Pearson r of each pair over the rows where both are there."""
    k = x.shape[1]
    r = np.full((k, k), np.nan)
    for i in range(k):
        for j in range(k):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            if len(a) and np.ptp(a) > 0 and np.ptp(b) > 0:
                r[i, j] = np.corrcoef(a, b)[0, 1]
    return r


def frame(spark, x, parts=5):
    rows = [[None if np.isnan(v) else float(v) for v in row] for row in x]
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(x.shape[1]))).repartition(parts)


def test_every_pattern_of_missing_values(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 6)) * [1, 1e-6, 1e6, 1, 1, 1] + [0, 0, 1e9, -5, 0, 0]  # far means, small spreads
    x[:, 3] += x[:, 0]
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 4] = np.where(np.isnan(x[:, 4]), np.nan, 0.1)  # constant
    x[:, 5] = np.where(np.arange(700) < 3, x[:, 5], np.nan)  # hardly there
    got = comoments(frame(spark, x), [f"c{i}" for i in range(6)]).correlation()
    want = pairwise(x)
    assert np.array_equal(np.isnan(got), np.isnan(want)) and np.nanmax(np.abs(got - want)) < 1e-9


def test_states_merge_to_the_state_of_all_rows():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, 4)) + 100
    x[rng.random(x.shape) < 0.4] = np.nan
    whole, parts = Comoments.of(x), Comoments.of(x[:0])
    for a in range(0, 90, 13):
        parts = Comoments.unpacked(parts.merged(Comoments.of(x[a : a + 13])).packed())
    for name in ("n", "mean", "square", "cross"):
        assert np.allclose(getattr(parts, name), getattr(whole, name), rtol=1e-9, atol=1e-9), name


def test_infinite_values_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, float("inf"), 5.0), (3.0, 4.0, 9.0)], "c0 double, c1 double, c2 double")
    r = comoments(df, ["c0", "c1", "c2"]).correlation()
    assert np.isnan(r[0, 1]) and np.isnan(r[1, 1]) and r[0, 2] == pytest.approx(np.corrcoef([1, 2, 3], [3, 5, 9])[0, 1])
    none = comoments(df.limit(0), ["c0", "c1"])
    assert none.n.sum() == 0 and np.isnan(none.correlation()).all()


def test_survey_width_in_one_scan(spark):
    """114 columns: 6,441 pairs, a plan that does not grow with them, seconds."""
    names = [f"c{i}" for i in range(114)]
    df = spark.range(20000).select(*[
        F.when(F.xxhash64("id", F.lit(i)) % 7 != 0, (F.xxhash64("id", F.lit(-i)) % 1000 + F.col("id") % (i + 2)).cast("double")).alias(n)
        for i, n in enumerate(names)
    ])
    start = time.time()
    rows = C.correlation_long(df, names).collect()
    assert time.time() - start < 60 and len(rows) == 114 * 114
    got = np.array([np.nan if r["r"] is None else r["r"] for r in rows]).reshape(114, 114)
    x = df.toPandas().to_numpy(float)
    some = [0, 1, 17, 63, 113]
    assert np.abs(got[np.ix_(some, some)] - pairwise(x[:, some])).max() < 1e-9


def least_squares(x, y):
    design = np.column_stack([np.ones(len(y)), *x])
    fit = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    return 1 - ((y - fit) ** 2).sum() / ((y - y.mean()) ** 2).sum()


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(3)
    n = 600
    a, b, c = rng.normal(size=n) * 3 + 50, rng.normal(size=n), rng.normal(size=n) * 1e4
    g = rng.choice(["u", "v", "w"], n)
    y = 2 * a - b + (g == "v") * 5 + rng.normal(size=n)
    rows = [(*map(float, r[:3]), str(r[3]), float(r[4])) for r in zip(a, b, c, g, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, g string, y double"), (a, b, c, g, y)


def test_all_subsets_equal_least_squares(sample):
    df, (a, b, c, g, y) = sample
    found = {r["feature_set"]: r["r2"] for r in S.all_subsets(df, "y", ["a", "b", "c"], ["g"]).collect()}
    assert len(found) == 7
    for size in (1, 2, 3):
        for names in combinations("abc", size):
            x = [{"a": a, "b": b, "c": c}[n] for n in names] + [g == "v", g == "w"]
            assert found["+".join(names)] == pytest.approx(least_squares(x, y), abs=1e-10)


def test_dependent_features_add_nothing(sample):
    df, _ = sample
    more = df.withColumn("twice", 2 * F.col("a") + 1).withColumn("k", F.lit(3.0))
    found = {r["feature_set"]: r["r2"] for r in S.all_subsets(more, "y", ["a", "twice", "k", "b"]).collect()}
    assert found["a+twice"] == pytest.approx(found["a"]) and found["a+twice+k+b"] == pytest.approx(found["a+b"])
    assert found["twice"] == pytest.approx(found["a"]) and found["k"] == pytest.approx(0.0, abs=1e-9)
    flat = df.withColumn("y", F.lit(1.0))
    assert {r["r2"] for r in S.all_subsets(flat, "y", ["a", "b"]).collect()} == {None}


def test_errors_on_other_rows_follow_from_their_moments(sample):
    df, (a, b, c, g, y) = sample
    design = S.Design.of(df, "y", ["a", "b"], ["g"])
    train, test = design.moments(df.where("c < 0")), design.moments(df.where("c >= 0"))
    got = S.r_squared_on(train, test, [k for p in design.parts.values() for k in p])
    x = np.column_stack([np.ones(len(y)), a, b, g == "v", g == "w"])
    coefficients = np.linalg.lstsq(x[c < 0], y[c < 0], rcond=None)[0]
    rest = y[c >= 0]
    assert got == pytest.approx(1 - ((rest - x[c >= 0] @ coefficients) ** 2).sum() / ((rest - rest.mean()) ** 2).sum(), abs=1e-10)


def test_sweeping_twice_is_nothing():
    m = np.cov(np.random.default_rng(5).normal(size=(4, 30)))
    swept = m.copy()
    for k in (1, 3, 1, 3):
        S.sweep(swept, k)
    assert np.allclose(swept, m)


def test_pairs_of_columns_with_any_names(spark):
    data = [("x", 1, True), ("x", 2, None), ("y", 1, False), (None, 1, True), ("x", 1, True)]
    df = spark.createDataFrame(data, "n string, `a b` int, x boolean")
    names = ["n", "a b", "x"]
    got = {(r["x"], r["y"], r["a"], r["b"]): r["n"] for r in A.pair_counts(df, list(combinations(names, 2))).collect()}
    assert got == {
        ("n", "a b", "x", "1"): 2, ("n", "a b", "x", "2"): 1, ("n", "a b", "y", "1"): 1, ("n", "x", "x", "true"): 2,
        ("n", "x", "y", "false"): 1, ("a b", "x", "1", "true"): 3, ("a b", "x", "1", "false"): 1,
    }
    matrix = {(r["x"], r["y"]): r for r in A.cramers_v_matrix(df, names).collect()}
    assert set(matrix) == {("n", "a b"), ("n", "x"), ("a b", "x")} and matrix["a b", "x"]["cramers_v"] is None
    with pytest.raises(ValueError):
        crosstab(df, "n", "x")


def test_one_scan_for_all_pairs(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    plan = A.pair_counts(df, [("o_orderstatus", "o_orderpriority"), ("o_orderstatus", "o_custkey")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
